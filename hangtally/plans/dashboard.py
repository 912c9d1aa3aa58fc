"""Stock dashboards per store and article (or SKU).

All measures of a dashboard are stacked into one long frame and summed in one shuffle,
instead of one aggregate and one join per measure.  A row that only one source knows
comes out by itself, as in a chain of outer joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally.functions import code_label, count_where, percent, sum_where
from hangtally.operators import sizerun as G
from hangtally.operators.aging import receipt_aging
from hangtally.operators.ledger import union_rows

KEYS = ["store_id", "article"]


@dataclass(frozen=True)
class Movements:
    """SKU-level inputs, all with store_id, sku and qty (not yet summed)."""
    on_hand: DataFrame          # stocks instead of qty
    receipts: DataFrame         # with move_date
    sales: DataFrame
    moved: DataFrame            # with stat
    deliveries: DataFrame       # delivery_cells


DELIVERY = "store_id bigint, ordered_qty double, order_date date, delivered_qty double, delivery_date date, open_orders double, open_transfers double"


def delivery_cells(deliveries: DataFrame, lines: DataFrame, received: DataFrame) -> DataFrame:
    """All measures of deliveries from one pass over their lines.

    A line gives its store what was ordered and sent and, where the document has not arrived, what is open; an open transfer
    (flag R) gives the store it goes to, the next one, a cell of its own. Whether a document has arrived is one flag.
    """
    arrived = received.select("doc_id").distinct().withColumn("_arrived", F.lit(True))
    rows = lines.join(deliveries, "doc_id").join(arrived, "doc_id", "left")
    sent, waits = F.col("status") != K.VOID, (F.col("status") == K.VOID) & F.col("_arrived").isNull()
    qty, none = F.col("qty").cast("double"), F.lit(None)
    own = F.struct("store_id", qty, "delivery_date", F.when(sent, qty).otherwise(0.0), F.when(sent, F.col("input_date")), F.when(waits, qty), none)
    there = F.when(waits & (F.col("flag") == "R"), F.struct(F.col("store_id") + 1, none, none, none, none, none, qty))
    cell = f"struct<{DELIVERY.replace(' ', ':').replace(',:', ',')}>"
    cells = F.array(own.cast(cell), there.cast(cell))
    return rows.select("sku", F.inline(F.filter(cells, lambda c: c.isNotNull())))


def _measures(m: Movements) -> list[DataFrame]:
    kind = lambda stat, qty, name: F.when(F.col("stat") == stat, qty).cast("double").alias(name)
    return [
        m.on_hand.select("store_id", "sku", "stocks", F.lit(1).alias("has_stock")),
        m.sales.select("store_id", "sku", F.col("qty").cast("double").alias("sales")),
        m.moved.where(F.col("stat").isin(K.RETURN, K.TRANSFER)).select(
            "store_id", "sku", kind(K.RETURN, -F.col("qty"), "returned"), kind(K.TRANSFER, F.col("qty"), "transferred")),
        m.deliveries,
    ]


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0)).alias(c)


SUMS = ["sales", "returned", "transferred", "open_orders", "open_transfers", "ordered_qty", "delivered_qty"]


def article_measures(m: Movements, articles: DataFrame, asof: str) -> DataFrame:
    """One row per store and article: sizes, sums, dates, receipt ages."""
    classes = G.class_list(articles)
    attrs = articles.select("sku", "article", "size", G.class_code(F.col("size_class"), classes).alias("_class"))
    rows = union_rows(_measures(m), allow_missing=True).join(attrs, "sku")
    ages = receipt_aging(m.receipts.join(attrs.select("sku", "article"), "sku"), KEYS, asof)
    cells = G.size_cells("stocks")
    table = union_rows([rows, ages], allow_missing=True).groupBy(*KEYS).agg(
        *cells, *[F.sum(c).alias(c) for c in SUMS],
        F.max("_class").alias("_class"), F.max("has_stock").alias("has_stock"),
        F.max("order_date").alias("order_date"), F.max("delivery_date").alias("delivery_date"),
        *[F.max(c).alias(c) for c in ("first_receipt", "last_receipt", "first_qty", "aging")])
    table = table.where("has_stock is not null or open_orders is not null or open_transfers is not null")
    table = table.withColumns({c: _zero(c) for c in [*SUMS, "first_qty"]})
    table = G.run_status(table.withColumn("size_class", G.class_name(F.col("_class"), classes)).drop("_class")).withColumns({
        "status": F.when(F.col("has_stock").isNotNull(), F.col("status")),
        "aging": F.coalesce("aging", F.lit(0)),
        "stock_start": F.col("sum_qty") + F.col("sales"),
    })
    table = table.withColumn("stock_future", F.col("sum_qty") + F.col("open_orders") + F.col("open_transfers"))
    return table.withColumn("sell_thru", percent("sales", "stock_start"))


def article_info(articles: DataFrame) -> DataFrame:
    """One row per article; attributes that differ between its SKUs show the least."""
    return articles.groupBy("article").agg(*[F.min(c).alias(c) for c in ("category", "brand", "price")])


def store_labels(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "store_code", code_label("store_code", "store_name").alias("store_label"))


def stock_detail(m: Movements, articles: DataFrame, stores: DataFrame, classes: DataFrame, asof: str) -> DataFrame:
    """The detail dashboard: measures, price class of the article, store and article labels."""
    return (article_measures(m, articles, asof)
            .join(classes, "article", "left")
            .join(article_info(articles), "article", "left")
            .join(store_labels(stores), "store_id", "left")
            .drop("has_stock"))


RETURN_COLUMNS = ["store_label", "article", "size_class", "aging", *K.ALL_SIZES, "status", "sum_qty", "sales", "store_code",
                  "returned", "transferred", "stock_start", "sell_thru", "category"]


def return_candidates(detail: DataFrame) -> DataFrame:
    return detail.select(*[f"`{c}`" for c in RETURN_COLUMNS])


def stock_future(on_hand: DataFrame, deliveries: DataFrame) -> DataFrame:
    """SKU level: stock on hand and on its way; SKUs that are only on their way show too."""
    coming = deliveries.where("open_orders is not null or open_transfers is not null")
    rows = union_rows([
        on_hand.select("store_id", "sku", F.col("stocks").alias("sum_qty")),
        coming.select("store_id", "sku", "open_orders", "open_transfers"),
    ], allow_missing=True)
    measures = ["sum_qty", "open_orders", "open_transfers"]
    sums = rows.groupBy("store_id", "sku").agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in measures])
    return sums.withColumn("stock_future", F.col("sum_qty") + F.col("open_orders") + F.col("open_transfers"))


def stock_mobile(on_hand: DataFrame, deliveries: DataFrame, articles: DataFrame) -> DataFrame:
    """Future stock with the SKU's article."""
    return stock_future(on_hand, deliveries).join(articles.select("sku", "article", "size", "brand", "price"), "sku", "left")


def category_summary(measures: DataFrame, info: DataFrame, old_days: int = K.OLD_STOCK_DAYS) -> DataFrame:
    """Per category: sums, complete and broken size runs, old articles, share and sell-through.

    Both statuses always have their columns.  The share's total runs over one row per
    category.
    """
    from pyspark.sql.window import Window
    rows = measures.where("status is not null").join(info.select("article", "category"), "article")
    broken, whole = F.col("status") == K.BROKEN, F.col("status") == K.COMPLETE
    out = rows.groupBy("category").agg(
        F.sum("stock_start").alias("stock_start"), F.sum("sales").alias("sales"),
        F.sum("sum_qty").cast("double").alias("sum_qty"),
        count_where(broken).alias("broken"), count_where(whole).alias("complete"), F.count("*").alias("cart"),
        sum_where(broken, F.col("sum_qty").cast("double")).alias("broken_pcs"),
        sum_where(whole, F.col("sum_qty").cast("double")).alias("complete_pcs"),
        count_where(F.col("aging") > old_days).alias("aging_gt_12"))
    return out.withColumns({
        "sell_thru": percent("sales", "stock_start"),
        "sales_contrib": percent(F.col("sales"), F.sum("sales").over(Window.partitionBy(F.lit(1)))),
        "total_pcs": F.col("sum_qty"),
    }).orderBy(F.desc("sales_contrib"))
