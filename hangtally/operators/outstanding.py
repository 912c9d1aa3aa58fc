"""Deliveries that were shipped and not yet received, and their incremental refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally.functions import surrogate_key
from hangtally.operators.upsert import merge_upsert


def outstanding(deliveries: DataFrame, lines: DataFrame, received: DataFrame,
                keys: Sequence[str], out: str, orders: DataFrame | None = None) -> DataFrame:
    """Quantity of open deliveries without a receiving document, summed by the keys.

    With ``orders`` (order_no, cust_id) the customer is the order's, and deliveries without an order drop out.
    """
    still_open = (deliveries.where(F.col("status") == K.VOID)
                  .join(received.select("doc_id"), "doc_id", "left_anti"))
    if orders is not None:
        still_open = still_open.drop("cust_id").join(orders, "order_no")
    return lines.join(still_open, "doc_id").groupBy(*keys).agg(F.sum("qty").alias(out))


def order_delivery_sum(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ordered and delivered quantity; the dates shown are the latest ones."""
    return rows.groupBy(*keys).agg(
        F.max("order_date").alias("order_date"), F.sum("ordered_qty").alias("ordered_qty"),
        F.max("delivery_date").alias("delivery_date"), F.sum("delivered_qty").alias("delivered_qty"))


def pending_returns(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pre-returns: the verified quantity where final, the sent quantity where only sent."""
    qty = F.when(F.col("status") == K.FINAL, F.col("verified_qty")).otherwise(F.col("sent_qty"))
    return (rows.where(F.col("status").isin("T", K.FINAL))
            .groupBy(*keys).agg(F.sum(qty).alias("pending_qty")))


def subtract_pending(stock: DataFrame, pending: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (stock.join(pending, list(keys), "left")
            .withColumn("stocks", F.col("stocks") - F.coalesce("pending_qty", F.lit(0.0)))
            .drop("pending_qty"))


def transfer_trace(transfers: DataFrame, transfer_lines: DataFrame, deliveries: DataFrame,
                   receipts: DataFrame, receipt_lines: DataFrame) -> DataFrame:
    """Transfer -> delivery -> receipt -> line, distinct; the line meets its receipt on
    document and SKU."""
    return (transfers
            .join(deliveries, "transfer_id")
            .join(transfer_lines, "transfer_id", "left")
            .join(receipts, "delivery_id", "left")
            .join(receipt_lines, ["receipt_id", "sku"], "left")
            .distinct())


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_input"), F.min(column).alias("min_input"))


def newer_than_mark(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows entered at or after the newest row of the target (all rows if it is empty).

    The mark may be a day on which more was entered after the last run, so rows on the mark come
    again; the upsert that follows writes them once.
    """
    mark = target.agg(F.max(column).alias("m")).scalar()
    return source.where((F.col(column) >= mark) | mark.isNull())


def stale_keys(source: DataFrame, target: DataFrame, key: str, column: str) -> DataFrame:
    """Target keys inside the target's own mark range that the source no longer has."""
    marks = target.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = marks.select("lo").scalar(), marks.select("hi").scalar()
    live = source.where(F.col(column).between(lo, hi)).select(key)
    return target.select(key).join(live, key, "left_anti")


def refresh_outstanding(source: DataFrame, target: DataFrame, key: str, column: str) -> DataFrame:
    """New rows in, vanished rows out.  Running it twice gives the same table."""
    gone = stale_keys(source, target, key, column)
    kept = target.join(gone, key, "left_anti")
    return merge_upsert(kept, newer_than_mark(source, target, column), [key])


def with_delivery_key(df: DataFrame) -> DataFrame:
    return df.withColumn("pk_id", surrogate_key("doc_id", "sku"))
