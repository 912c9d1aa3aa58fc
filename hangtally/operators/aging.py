"""Ages of stock since its receipt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangtally.functions import day, months_between_labels
from hangtally.operators.aggregates import best_row


def aging_min_max(receipts: DataFrame, keys: Sequence[str], asof: str) -> DataFrame:
    """Least and greatest age in days and calendar months."""
    days = F.datediff(day(asof), "move_date")
    months = months_between_labels(day(asof), "move_date")
    return receipts.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.min(days).alias("days_min"), F.max(days).alias("days_max"),
        F.min(months).alias("months_min"), F.max(months).alias("months_max"))


def receipt_aging(receipts: DataFrame, keys: Sequence[str], asof: str) -> DataFrame:
    """First and last receipt, quantity received on the first day, days since the last."""
    daily = (receipts.where(F.col("move_date") <= day(asof)).dropna(subset=list(keys))
             .groupBy(*keys, "move_date").agg(F.sum("qty").alias("qty")))
    return (daily.groupBy(*keys).agg(
        F.min("move_date").alias("first_receipt"), F.max("move_date").alias("last_receipt"),
        F.min_by("qty", "move_date").alias("first_qty"))
        .withColumn("aging", F.datediff(day(asof), "last_receipt")))


def latest_main_receipt(receipts: DataFrame, articles: DataFrame, asof: str) -> DataFrame:
    """Per order and article the largest receipt, then per article its latest arrival.

    Articles that never arrived get fixed defaults."""
    order = [F.col("qty"), F.col("arrival_date"), F.col("doc_id")]
    main = best_row(receipts, ["order_no", "article"], order, ["arrival_date", "qty", "doc_id"])
    last = best_row(main, ["article"], [F.col("arrival_date"), F.col("qty"), F.col("order_no")],
                    ["order_no", "arrival_date", "qty", "doc_id"])
    out = last.join(articles.select("article").distinct(), "article", "right").withColumns({
        "qty": F.coalesce("qty", F.lit(0.0)),
        "arrival_date": F.coalesce("arrival_date", day("2023-01-01")),
    })
    return out.withColumns({"days": F.datediff(day(asof), "arrival_date"),
                            "months": months_between_labels(day(asof), "arrival_date")})
