"""Extracts of the central warehouses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally.functions import day
from hangtally.operators.ledger import union_rows


def active_types(types: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Warehouse types in use with their warehouses in use."""
    return (types.where("type_hold = 'F'")
            .join(warehouses.where("wh_hold = 'F'"), "wh_id")
            .select("type_id", "wh_id", "type_name", "wh_name"))


def balance(stock: DataFrame, warehouses: DataFrame, types: DataFrame, articles: DataFrame) -> DataFrame:
    """Current stock and bookings; names only of warehouses and types in use."""
    return (stock
            .join(warehouses.where("wh_hold = 'F'").select("wh_id", "wh_name"), "wh_id", "left")
            .join(types.where("type_hold = 'F'").select("type_id", "type_name"), "type_id", "left")
            .join(articles.select("sku", "article"), "sku", "left")
            .select("article", "sku", "wh_name", "type_name", "stock", "booked"))


def stock_by_sku(balances: DataFrame, type_names: Sequence[str] = tuple(K.WAREHOUSE_TYPES_FOR_STOCK)) -> DataFrame:
    return (balances.where(F.col("type_name").isin(list(type_names)) & F.col("article").isNotNull())
            .groupBy("sku").agg(F.sum("stock").alias("stock")))


def named(rows: DataFrame, warehouses: DataFrame, types: DataFrame) -> DataFrame:
    return rows.join(warehouses.select("wh_id", "wh_name"), "wh_id").join(types.select("type_id", "type_name"), "type_id")


def dated_extract(rows: DataFrame, warehouses: DataFrame, types: DataFrame, since: str,
                  tag: str | None = None, keep: Column | None = None,
                  columns: Sequence[str] = ("wh_name", "type_name", "sku", "qty", "move_date")) -> DataFrame:
    """Rows after a date with warehouse names, optionally tagged and filtered."""
    out = rows.where(F.col("move_date") > day(since))
    if keep is not None:
        out = out.where(keep)
    out = named(out, warehouses, types).select(*columns)
    return out if tag is None else out.withColumn("stat", F.lit(tag))


def ledger(receipts: DataFrame, stock_in: DataFrame, stock_out: DataFrame, deliveries: DataFrame,
           warehouses: DataFrame, types: DataFrame, since: str) -> DataFrame:
    """Goods receipt and stock in (+), stock out and deliveries of stores (-)."""
    def part(rows: DataFrame, tag: str, sign: int) -> DataFrame:
        return (rows.where(F.col("move_date") > day(since))
                .select("wh_id", "type_id", "sku", (F.col("qty") * sign).alias("qty"), "move_date",
                        F.lit(tag).alias("stat")))
    rows = union_rows([
        part(receipts, "Stock GR", 1),
        part(stock_in, "Stock In Gudang", 1),
        part(stock_out, "Stock Out Gudang", -1),
        part(deliveries.where(F.col("doc_no").startswith("DO/") & (F.col("qty") != 0)), "Stock DO", -1),
    ])
    return named(rows, warehouses, types).select("wh_name", "type_name", "sku", "qty", "move_date", "stat")
