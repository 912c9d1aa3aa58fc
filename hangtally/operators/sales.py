"""Sales lines, discounts, margins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally.functions import (before_tax, clean_sku, event_price_and_discount, in_year, money,
                                 money_sum, net_amount, ratio, round_even, simulated_amount)
from hangtally.operators.aggregates import best_row, modal_value
from hangtally.operators.joins import asof_join, interval_join


def sales_lines(headers: DataFrame, lines: DataFrame, discounts: DataFrame, marks: DataFrame,
                prefix: str = "PJ", period: Column | None = None) -> DataFrame:
    """Valid lines of valid documents, with the event of their discount."""
    valid_headers = headers.where(F.col("doc_no").startswith(prefix) & (F.col("status") != K.VOID))
    if period is not None:
        valid_headers = valid_headers.where(period)
    events = discounts.join(marks, "mark_id").select("disc_id", F.col("mark_name").alias("event"))
    return (lines.where(F.col("line_status") != K.VOID)
            .join(valid_headers.drop("status"), "doc_id")
            .join(events, "disc_id", "left"))


def clean_sales(df: DataFrame) -> DataFrame:
    """Calendar columns, clean code, article status from the event where it is missing."""
    return df.withColumns({
        "month_no": F.month("sales_date"),
        "month_name": F.date_format("sales_date", "MMMM"),
        "year": F.year("sales_date"),
        "sku_code": clean_sku("sku_code"),
        "article_status": F.coalesce("article_status", "event"),
    })


def add_second_discount(lines: DataFrame, allocation: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Attach per-unit document discounts; lines without any get 0."""
    out = lines.join(allocation, "doc_id", "left").fillna(0.0, subset=list(parts))
    return out.withColumn("total_disc2", F.col(parts[0]) * F.col("qty"))


def units_of(lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Quantity of the given documents; lines of others are dropped before they are summed."""
    return lines.join(documents.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.sum("qty").alias("doc_qty"))


def discount_allocation(cuts: DataFrame, charges: DataFrame, lines: DataFrame) -> DataFrame:
    """Per-unit share of document-level cuts and online charges, keyed by document.

    Two decimals, voucher unrounded; documents without quantity give 0.
    """
    parts = ["cut", "service_fee", "premium", "affiliate", "voucher"]
    both = cuts.unionByName(charges, allowMissingColumns=True)
    summed = both.groupBy("doc_id").agg(*[F.coalesce(F.sum(money(p)).cast("double"), F.lit(0.0)).alias(p)
                                          for p in parts])
    units = units_of(lines, summed)
    out = summed.join(units, "doc_id", "left").fillna(0.0, subset=["doc_qty"])
    per_unit = {f"unit_{p}": round_even(ratio(p, "doc_qty"), 2) for p in parts[:-1]}
    per_unit["unit_voucher"] = ratio("voucher", "doc_qty")
    return out.withColumns(per_unit)


def unit_cut_up(cuts: DataFrame, lines: DataFrame, cut: str, out: str) -> DataFrame:
    """Document cut per unit, rounded up; 0 where the document has no quantity."""
    cuts = cuts.where(F.col(cut) != 0)
    return (cuts.join(units_of(lines, cuts), "doc_id", "left")
            .withColumn(out, F.ceil(ratio(cut, "doc_qty")).cast("double")))


def invoice_discount(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Invoice header discount per unit where it differs from its lines' total, except where
    the lines exceed it by more than 1."""
    by_line = lines.join(headers.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(money_sum("line_disc").alias("lines_disc"))
    return (headers.join(by_line, "doc_id")
            .where((F.col("total_disc") != F.col("lines_disc"))
                   & ~((F.col("lines_disc") - F.col("total_disc")) > 1))
            .select("doc_id", F.ceil(ratio("total_disc", "total_qty")).cast("double").alias("unit_disc")))


def invoice_sales(lines: DataFrame, discount: DataFrame) -> DataFrame:
    return (lines.join(discount, "doc_id", "left").fillna(0.0, subset=["unit_disc"])
            .withColumn("final_dpp", F.col("dpp") - F.col("unit_disc"))
            .withColumn("total_amount", F.col("final_dpp") * F.col("qty")))


def store_modal_margin(rates: DataFrame, store: str = "cust_id") -> DataFrame:
    """Per store the most frequent of the current margins of its marks."""
    current = best_row(rates, [store, "mark_id"], [F.col("effective_date"), -F.col("margin")], ["margin"])
    return modal_value(current, [store], "margin", "modal_margin")


def marks_from_articles(lines: DataFrame, articles: DataFrame) -> DataFrame:
    """Category of each line from its article, and the article's mark where the line has none.

    ``articles`` has one row per SKU with mark_id and category_id.
    """
    own = articles.select("sku", F.col("mark_id").alias("_mark"), "category_id")
    return (lines.drop("category_id").join(own, "sku", "left")
            .withColumn("mark_id", F.coalesce("mark_id", "_mark")).drop("_mark"))


def with_usual_margin(df: DataFrame, rates: DataFrame, store: str = "cust_id") -> DataFrame:
    """The store's usual margin beside each row; documents are fewer than lines, so it is best put on them."""
    return df.join(store_modal_margin(rates, store), store, "left")


def resolve_margin(lines: DataFrame, rates: DataFrame, bands: DataFrame, store: str = "cust_id") -> DataFrame:
    """Margin by dated band, else by effective date, else the store's usual margin.

    Status tells whether a margin was found before the fallback.  Lines that bring ``modal_margin`` keep it.
    """
    if "modal_margin" not in lines.columns:
        lines = with_usual_margin(lines, rates, store)
    out = interval_join(lines, bands, [store, "category_id", "mark_id"], "sales_date",
                        "begin_date", "end_date", "margin", "_band")
    out = asof_join(out, rates, [store, "mark_id"], "sales_date", "effective_date", "margin", "_asof")
    found = F.coalesce("_band", "_asof", F.lit(0))
    out = out.withColumn("_found", found).drop("_band", "_asof")
    return (out.withColumn("margin_status", F.when(F.col("_found") == 0, K.NO_MARGIN).otherwise(K.WITH_MARGIN))
            .withColumn("margin", F.when(F.col("_found") == 0, F.col("modal_margin")).otherwise(F.col("_found")))
            .drop("_found", "modal_margin"))


def add_net_amounts(df: DataFrame, gross: str, disc2: str, margin: str, status: str) -> DataFrame:
    out = df.withColumn("net_amount", net_amount(gross, disc2, margin))
    out = out.withColumn("sim_amount", simulated_amount(status, gross, "net_amount"))
    return out.withColumns({"dpp": before_tax("net_amount"), "dpp2": before_tax("sim_amount")})


def documented_lines(headers: DataFrame, lines: DataFrame, prefix: str = "PJ") -> DataFrame:
    """Lines without void ones, of documents of the prefix that are not void, dated by the document."""
    valid = headers.where(F.col("doc_no").startswith(prefix) & (F.col("status") != K.VOID)).select("doc_id", "sales_date")
    return lines.where(F.col("line_status") != K.VOID).drop("sales_date").join(valid, "doc_id")


def monthly_sales_wide(lines: DataFrame, year: int) -> DataFrame:
    """Quantity per store and SKU in each month, one scan for all months."""
    cells = [F.expr(f"coalesce(sum(case when month(sales_date) = {m} then qty end), 0D) as qty_{m:02d}")
             for m in range(1, 13)]
    return lines.where(in_year("sales_date", year)).groupBy("store_id", "sku").agg(*cells)


def consignment_amounts(df: DataFrame) -> DataFrame:
    """Gross, discounts, margin, net and taxes of a line; the online group has its own net.

    Expects event, bonus, mark_amount, list_price, price, disc, qty, total_disc2, margin,
    group_id and the unit charges.
    """
    price, disc = event_price_and_discount("event", "bonus", "mark_amount", "list_price", "price", "disc")
    special = F.coalesce(F.col("event").rlike("SP|NP"), F.lit(False))
    online = F.coalesce(F.col("group_id") == K.ONLINE_GROUP, F.lit(False))
    out = df.withColumns({"final_price": price, "final_disc": disc})
    out = out.withColumns({
        "gross_total": F.when(special, F.col("mark_amount") * F.col("qty"))
                        .otherwise(F.col("final_price") * F.col("qty")),
        "disc_total": F.col("final_disc") * F.col("qty"),
        "service_fee": F.col("unit_service_fee") * F.col("qty"),
        "premium": F.col("unit_premium") * F.col("qty"),
        "affiliate": F.col("unit_affiliate") * F.col("qty"),
    })
    out = out.withColumn("net_cash", F.col("gross_total") - F.col("disc_total") - F.col("total_disc2"))
    out = out.withColumn("margin_amount", F.rint(F.col("net_cash") * F.col("margin") / 100))
    plain_net = F.col("net_cash") - F.col("margin_amount")
    out = out.withColumn("online_base", F.when(online, F.col("net_cash") - F.col("voucher"))
                         .otherwise(F.lit(0.0)))
    out = out.withColumns({
        "dpp": F.when(online, F.lit(0.0)).otherwise(round_even(plain_net / K.TAX_DIVISOR, 2)),
        "vat": F.when(online, F.lit(0.0)).otherwise(round_even(plain_net / K.TAX_DIVISOR * K.TAX_RATE, 2)),
        "online_dpp": round_even(F.col("online_base") / K.TAX_DIVISOR, 2),
        "online_vat": round_even(F.col("online_base") / K.TAX_DIVISOR * K.TAX_RATE, 2),
        "net_amount": F.when(online, F.col("online_base") - F.col("margin_amount") - F.col("service_fee")
                             - F.col("premium") - F.col("affiliate")).otherwise(plain_net),
    })
    return out
