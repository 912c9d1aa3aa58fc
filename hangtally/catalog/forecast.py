"""Demand features and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from hangtally.catalog.registry import query
from hangtally.operators import forecast as FC

KEYS = ["year", "month", "category", "size", "brand"]
CATEGORICAL = ["season", "category", "size", "brand"]
NUMERIC = ["month", "price", "promo", "holiday"]


def demand(s):
    """Monthly quantity by article attributes."""
    month = F.col("month")
    rows = s.sales_line.join(s.article.where("size is not null"), "sku").groupBy(
        F.year("sales_date").alias("year"), F.month("sales_date").alias("month"), "category", "size", "brand").agg(
        F.sum("qty").alias("qty"), F.max("price").alias("price"), F.max((F.col("disc_rate") > 0.085).cast("int")).alias("promo"))
    return rows.withColumns({
        "season": F.when(month.isin(11, 12, 1, 2, 3), "Rainy").when(month.isin(6, 7), "Holiday").otherwise("Dry"),
        "holiday": month.isin(6, 7, 12).cast("int")})


DEMAND = """
    demand AS (SELECT *, CASE WHEN month IN (11, 12, 1, 2, 3) THEN 'Rainy' WHEN month IN (6, 7) THEN 'Holiday' ELSE 'Dry' END AS season,
                      CASE WHEN month IN (6, 7, 12) THEN 1 ELSE 0 END AS holiday FROM (
        SELECT CAST(YEAR(sales_date) AS INTEGER) AS year, CAST(MONTH(sales_date) AS INTEGER) AS month, category, size, brand, SUM(qty) AS qty,
               MAX(price) AS price, MAX(CASE WHEN disc_rate > 0.085 THEN 1 ELSE 0 END) AS promo
        FROM sales_line JOIN article USING (sku) WHERE size IS NOT NULL GROUP BY ALL) AS x)"""
CODED = " UNION ALL ".join(
    f"SELECT {', '.join(KEYS)}, '{c}=' || {c} AS feature, 1e0 AS value FROM demand WHERE {c} <> (SELECT MIN({c}) FROM demand)" for c in CATEGORICAL)
PLAIN = " UNION ALL ".join(
    f"SELECT {', '.join(KEYS)}, '{c}', CAST({c} AS DOUBLE) FROM demand WHERE {c} <> 0" for c in NUMERIC)


@query("demand_features", f"WITH {DEMAND} {CODED} UNION ALL {PLAIN}")
def _(s):
    return FC.demand_features(demand(s), KEYS, CATEGORICAL, NUMERIC)


LONG = f"""long AS (SELECT * FROM (
    {CODED} UNION ALL {PLAIN} UNION ALL SELECT {', '.join(KEYS)}, 'intercept', 1e0 FROM demand UNION ALL SELECT {', '.join(KEYS)}, 'label', CAST(qty AS DOUBLE) FROM demand) AS y)"""


@query("demand_normal_equations", f"""
    WITH {DEMAND}, {LONG}
    SELECT a.feature, b.feature AS other, CAST(SUM(CAST(ROUND(a.value * b.value, 4) AS DECIMAL(30, 4))) AS DOUBLE) AS product
    FROM long a JOIN long b USING ({', '.join(KEYS)}) WHERE a.feature <= b.feature GROUP BY ALL""")
def _(s):
    return FC.normal_equations(demand(s), CATEGORICAL, NUMERIC, "qty")


@query("demand_forecast_rows", f"""
    WITH {DEMAND}, train AS (SELECT * FROM demand WHERE year = 1999), t AS (SELECT COUNT(*) AS train_rows, AVG(qty) AS train_mean FROM train)
    SELECT {', '.join(KEYS)}, qty, train_rows, train_mean, ABS(qty - train_mean) AS mean_error,
           CAST({' + '.join(f"CASE WHEN {c} IN (SELECT {c} FROM train) THEN 0 ELSE 1 END" for c in CATEGORICAL)} AS INTEGER) AS unseen_levels
    FROM demand, t WHERE year = 2000""")
def _(s):
    return FC.forecast_rows(demand(s), KEYS, CATEGORICAL, "qty", "year", 1999)


@query("demand_linear_coefficients")
def _(s):
    return FC.linear_coefficients(s.spark, demand(s), CATEGORICAL, NUMERIC, "qty")


@query("demand_forecast")
def _(s):
    predicted, mae = FC.boosted_forecast(demand(s), CATEGORICAL, NUMERIC, "qty", "year", 1999)
    return predicted.select(*KEYS, "qty", "prediction", F.lit(mae).alias("mae"))
