"""Sales marts and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangtally.functions import money, surrogate_key
from hangtally.operators import sales as S
from hangtally.operators.aggregates import sum_first

UNIT_PARTS = ["unit_cut", "unit_service_fee", "unit_premium", "unit_affiliate", "unit_voucher"]
MART_KEYS = ["doc_id", "store_id", "sku", "sales_date"]


def sales_mart(headers: DataFrame, lines: DataFrame, discounts: DataFrame, marks: DataFrame, allocation: DataFrame,
               rates: DataFrame, bands: DataFrame, period: Column | None = None) -> DataFrame:
    """Lines of a period -> clean -> document discounts -> one row per document, store and
    SKU -> margin -> keys and net amounts, in one plan and without a stored margin table."""
    rows = S.clean_sales(S.sales_lines(headers, lines, discounts, marks, period=period))
    rows = S.add_second_discount(rows, allocation.select("doc_id", *UNIT_PARTS), UNIT_PARTS)
    rows = rows.withColumns({"total_disc2": money("total_disc2"), "gross": money("gross")})
    order = [F.col(c).alias(f"k{i}") for i, c in enumerate(["line_no", "gross", "qty", "disc_id", "article_status", "mark_id"])]
    mart = sum_first(rows, MART_KEYS, ["qty", "gross", "total_disc2"],
                     ["article_status", "event"], order, carried=["line_no", "cust_id", "mark_id", "category_id", "month_no", "year"])
    mart = mart.withColumns({"gross": F.col("gross").cast("double"), "total_disc2": F.col("total_disc2").cast("double"),
                             "event": F.coalesce("event", "article_status")})
    mart = S.resolve_margin(mart, rates, bands)
    mart = mart.withColumns({
        "margin": F.coalesce(F.col("margin").cast("double"), F.lit(0.0)),
        "pk_id": surrogate_key("store_id", F.date_format("sales_date", "yyMMdd"), "sku"),
    })
    return S.add_net_amounts(mart, "gross", "total_disc2", "margin", "margin_status")


def consignment_export(mart: DataFrame, articles: DataFrame, stores: DataFrame) -> DataFrame:
    """Mart rows with article and store columns under their report names."""
    labels = {"sales_date": "Sales Date", "store_code": "Code Store", "store_name": "Store", "article": "Code Articel",
              "category": "Kategori", "brand": "Brand", "size": "Size", "event": "Status Article", "price": "HET",
              "gross": "Total Nett Kassa", "net_amount": "Nett Amount", "qty": "Qty"}
    return (mart.join(articles, "sku", "left").join(stores.select("store_id", "store_code", "store_name"), "store_id", "left")
            .select(*labels).withColumnsRenamed(labels))
