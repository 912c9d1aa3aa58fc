"""Sell-through and article-size reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangtally.functions import surrogate_key
from hangtally.operators import sizerun as G
from hangtally.operators import stock as ST
from hangtally.sources.versions import written


def article_count_flags(stock: DataFrame, articles: DataFrame) -> DataFrame:
    """Per store and article, whether more than one piece was there at each month start and
    at the end."""
    months = [f"stock_{m:02d}" for m in range(1, 13)]
    sums = (stock.join(articles.select("sku", "article"), "sku").groupBy("store_id", "article")
            .agg(*[F.sum(c).alias(c) for c in [*months, "stock_13"]]))
    return sums.select("store_id", "article",
                       *[(F.col(c) > 1).cast("int").alias(c.replace("stock", "art")) for c in months],
                       (F.col("stock_13") > 1).alias("art_at"))


def report_by_store(table: DataFrame, articles: DataFrame, stores: DataFrame, year: int) -> DataFrame:
    """Sell-through of every store and SKU with the size-run status of its article."""
    rows = (table.join(articles.select("sku", "article", "size_class"), "sku")
            .join(stores.select("store_id", "store_code", "store_name"), "store_id", "left"))
    rows = written(rows, "report-rows")   # read for the status and for the report
    status = G.run_status(G.size_pivot(rows, ["store_id", "article"], "stock_at", articles=articles)).select("store_id", "article", "status")
    out = (rows.join(status, ["store_id", "article"], "left")
           .withColumn("pk_id", surrogate_key("store_id", "sku"))
           .withColumnsRenamed({"size_class": "bot/top"}))
    return out.withColumnsRenamed({**ST.month_labels(year), **ST.REPORT_LABELS}).drop("store_id")


def total_by_sku(table: DataFrame, year: int) -> DataFrame:
    """All stores together."""
    measures = [c for c in table.columns if c not in ("store_id", "sku", "size")]
    sums = table.groupBy("sku").agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in measures])
    return sums.withColumnsRenamed(ST.month_labels(year))


def report_total(last: DataFrame, this: DataFrame, warehouse: DataFrame, articles: DataFrame,
                 last_year: int, this_year: int) -> DataFrame:
    """Two years side by side by SKU, with the stock of the central warehouses and the
    size-run status of the article; the stock on hand is this year's."""
    old = total_by_sku(last, last_year).withColumnsRenamed(
        {"qty_retur": f"retur {last_year}", "total_sales_qty": "_sales_old"}).drop("stock_at", "ts_all")
    new = total_by_sku(this, this_year).withColumnsRenamed(
        {"qty_retur": f"retur {this_year}", "total_sales_qty": "_sales_new", "stock_at": "stock akhir"}).drop("ts_all")
    both = old.join(new, "sku", "full").join(warehouse.withColumnRenamed("stock", "stock gudang"), "sku", "full")
    both = both.fillna(0.0)
    both = both.withColumn("total sales qty", F.col("_sales_old") + F.col("_sales_new")).drop("_sales_old", "_sales_new")
    both = both.withColumn("total stock", F.col("total sales qty") + F.col("stock akhir"))
    rows = written(both.join(articles.select("sku", "article", "size", "size_class"), "sku"), "report-rows")
    status = G.run_status(G.size_pivot(rows, ["article"], "stock akhir", articles=articles)).select("article", "status")
    return rows.join(status, "article", "left").withColumnsRenamed({"article": "artikel", "size_class": "bot/top"})


def status_with_sales(rows: DataFrame, articles: DataFrame | None = None) -> DataFrame:
    """Stock by size, sales beside it and the status in which the free size counts; articles
    without stock (of any size) and sales are left out.  Sales ride along in the pivot's own shuffle."""
    from hangtally import constants as K
    sold = F.when(F.col("stat") == K.SALE, -F.col("qty")).otherwise(F.lit(0.0))
    keys = ["store_id", "article"]
    wide = G.size_pivot(rows, keys, "qty", extra=[F.sum(sold).alias("sales_qty")], every_size=True, articles=articles)
    out = G.run_status(wide, top=K.TOP_RUN_WITH_FREE, top_min=K.TOP_RUN_MIN_WITH_FREE)
    return out.where("sum_qty <> 0 or sales_qty <> 0").select(*keys, "sum_qty", "sales_qty", "status")


def stock_sales_dashboard(status: DataFrame, info: DataFrame, follow_up: DataFrame, stores: DataFrame,
                          ages: DataFrame) -> DataFrame:
    """Status with article details (the follow-up list first, the master where it is silent),
    store and age."""
    return (status.join(info, "article", "left").join(follow_up, "article", "left")
            .withColumn("category", F.coalesce("md_category", "category")).drop("md_category")
            .join(stores, "store_id", "left").join(ages, ["store_id", "article"], "left"))
