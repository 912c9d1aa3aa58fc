"""Group-wise reductions.  Every one combines on the map side, so hot keys stay cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grouping drops rows with a null key."""
    return df.dropna(subset=list(keys))


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
             columns: Sequence[str]) -> DataFrame:
    """One row per key: the one whose order tuple is greatest.

    An aggregate of a struct, not a ranking window: no task has to hold a whole group.
    """
    rank = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    best = F.max(F.struct(*rank, *[F.col(c) for c in columns])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns])


def least_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
              columns: Sequence[str]) -> DataFrame:
    rank = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    best = F.min(F.struct(*rank, *[F.col(c) for c in columns])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns])


def first_value(column: str, order: Sequence[Column]) -> Column:
    """First non-null value of the column in the given order."""
    key = F.struct(*order)
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), key))


def sum_first(df: DataFrame, keys: Sequence[str], sums: Sequence[str], firsts: Sequence[str],
              order: Sequence[Column], carried: Sequence[str] = ()) -> DataFrame:
    """Sum some columns, take the first non-null of others, per key.

    ``carried`` columns are never null; they all come from the first row at once.
    """
    aggs = [F.sum(c).alias(c) for c in sums]
    aggs += [first_value(c, order).alias(c) for c in firsts]
    if carried:
        rank = [o.alias(f"_o{i}") for i, o in enumerate(order)]
        aggs.append(F.min(F.struct(*rank, *[F.col(c) for c in carried])).alias("_row"))
    out = not_null_keys(df, keys).groupBy(*keys).agg(*aggs)
    return out.withColumns({c: F.col(f"_row.{c}") for c in carried}).drop("_row") if carried else out


def modal_value(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Most frequent value per key, the smallest on ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    best = F.max(F.struct(F.col("_n"), (-F.col(value)).alias("_nv"))).alias("_b")
    return counts.groupBy(*keys).agg(best).select(*keys, (-F.col("_b._nv")).alias(out))


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value."""
    return value_frequency(df, column).orderBy(F.desc("n"), F.asc(column)).limit(n)


def numeric_totals(df: DataFrame, exact: Sequence[str] = ()) -> DataFrame:
    """Sum of every numeric column in long form (column_name, total)."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    aggs = [(F.sum(F.col(c).cast("decimal(18,2)")) if c in exact else F.sum(c)).cast("double").alias(c)
            for c in names]
    return df.agg(*aggs).unpivot([], names, "column_name", "total")


def share_of_total(df: DataFrame, value: str, out: str, total: Column) -> DataFrame:
    """Add value / total * 100; ``total`` is a scalar, so no single-partition window is needed."""
    from hangtally.functions.expressions import percent
    return df.withColumn(out, percent(F.col(value), total))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or not unique, with their row count."""
    is_null = F.lit(False)
    for k in keys:
        is_null = is_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count("*").alias("n"))
            .withColumn("problem", F.when(is_null, "null key").when(F.col("n") > 1, "duplicate"))
            .where("problem is not null"))


def orphans(facts: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Fact keys that the dimension does not know, with their row count."""
    return (facts.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n"))
            .join(dim.select(on), on, "left_anti"))
