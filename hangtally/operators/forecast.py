"""Demand features and models on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def encoder(categorical: Sequence[str], numeric: Sequence[str], unseen: bool = False) -> Pipeline:
    """One-hot columns, then the numeric columns. The level left out is the alphabetically first or, with ``unseen``,
    one of its own for all levels the fitted rows don't have."""
    indexed = [f"{c}_index" for c in categorical]
    coded = [f"{c}_code" for c in categorical]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categorical), outputCols=indexed, stringOrderType="alphabetDesc", handleInvalid="keep" if unseen else "error"),
        OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=True),
        VectorAssembler(inputCols=[*coded, *numeric], outputCol="features"),
    ])


def feature_names(fitted, categorical: Sequence[str], numeric: Sequence[str]) -> list[str]:
    """Names in vector order; their number is the number of category levels, not of rows."""
    names: list[str] = []
    for c, labels in zip(categorical, fitted.stages[0].labelsArray):
        names += [f"{c}={v}" for v in list(labels)[:-1]]
    return names + list(numeric)


def with_features(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """``_f``: the non-zero features of a row as an array of (feature, value): one per category column unless it holds the
    alphabetically first level, and the numbers that are not 0. Never longer than the columns, however many levels there are."""
    df = df.withColumn("_least", df.agg(F.struct(*[F.min(c).alias(c) for c in categorical])).scalar())
    cells = [F.when(F.col(c) != F.col("_least")[c], F.struct(F.concat(F.lit(f"{c}="), F.col(c)).alias("feature"), F.lit(1.0).alias("value")))
             for c in categorical]
    cells += [F.when(F.col(c) != 0, F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))) for c in numeric]
    return df.withColumn("_f", F.filter(F.array(*cells), lambda x: x.isNotNull())).drop("_least")


def demand_features(df: DataFrame, keys: Sequence[str], categorical: Sequence[str],
                    numeric: Sequence[str]) -> DataFrame:
    """Non-zero features per row in long form (keys, feature, value)."""
    return with_features(df, categorical, numeric).select(*keys, F.inline("_f"))


def normal_equations(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str) -> DataFrame:
    """Sums of products over all rows, in one pass: feature, other, product.

    Both run over the features, ``intercept`` (1 in each row) and the label as ``label``; pairs stand once, in the order of their names,
    and pairs that never meet are left out. A row gives pairs of its non-zero features only. Products are kept to 4 decimals.
    """
    extra = F.array(F.struct(F.lit("intercept").alias("feature"), F.lit(1.0).alias("value")),
                    F.struct(F.lit("label").alias("feature"), F.col(label).cast("double").alias("value")))
    rows = with_features(df, categorical, numeric).select(F.concat("_f", extra).alias("_f"))
    pairs = rows.select("_f", F.inline("_f")).select(F.col("feature").alias("_a"), F.col("value").alias("_x"), F.inline("_f"))
    product = F.round(F.col("_x") * F.col("value"), 4).cast("decimal(30,4)")
    return (pairs.where("_a <= feature").groupBy(F.col("_a").alias("feature"), F.col("feature").alias("other"))
            .agg(F.sum(product).cast("double").alias("product")))


def linear_coefficients(spark: SparkSession, df: DataFrame, categorical: Sequence[str],
                        numeric: Sequence[str], label: str) -> DataFrame:
    fitted = encoder(categorical, numeric).fit(df)
    train = fitted.transform(df).select("features", F.col(label).cast("double").alias("label")).persist()
    model = LinearRegression(solver="auto", standardization=False).fit(train)
    train.unpersist()
    names = feature_names(fitted, categorical, numeric)
    rows = [(n, float(w)) for n, w in zip(names, model.coefficients)] + [("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def boosted_forecast(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str,
                     year: str, train_year: int, rounds: int = 20) -> tuple[DataFrame, float]:
    """Train on one year, predict the next; the predictions and their mean absolute error.

    The encoder knows the training year's levels only; others are *unseen* to the model."""
    fitted = encoder(categorical, numeric, unseen=True).fit(df.where(F.col(year) == train_year))
    ready = fitted.transform(df.where(F.col(year).isin(train_year, train_year + 1))).withColumn("label", F.col(label).cast("double"))
    train = ready.where(F.col(year) == train_year).select("features", "label").persist()
    model = GBTRegressor(maxIter=rounds, maxDepth=5, seed=42, featuresCol="features",
                         labelCol="label").fit(train)
    train.unpersist()
    test = model.transform(ready.where(F.col(year) == train_year + 1))
    mae = RegressionEvaluator(metricName="mae", labelCol="label", predictionCol="prediction").evaluate(test)
    return test.drop("features", *[f"{c}_index" for c in categorical], *[f"{c}_code" for c in categorical]), mae


def forecast_rows(df: DataFrame, keys: Sequence[str], categorical: Sequence[str], label: str, year: str, train_year: int) -> DataFrame:
    """What a forecast is about, without a model: the rows of the year to predict with their actual value, the training rows and
    mean, the error of predicting that mean, and how many of the row's levels the training year does not have."""
    train = df.where(F.col(year) == train_year)
    facts = train.agg(F.struct(F.count("*").alias("rows"), F.avg(label).alias("mean"), *[F.collect_set(c).alias(c) for c in categorical])).scalar()
    rows = df.where(F.col(year) == train_year + 1).withColumn("_t", facts)
    unseen = F.lit(0)
    for c in categorical:
        unseen = unseen + F.when(F.array_contains(F.col("_t")[c], F.col(c)), 0).otherwise(1)
    mean = F.col("_t")["mean"]
    return rows.select(*keys, label, F.col("_t")["rows"].alias("train_rows"), mean.alias("train_mean"), F.abs(F.col(label) - mean).alias("mean_error"),
                       unseen.cast("int").alias("unseen_levels"))
