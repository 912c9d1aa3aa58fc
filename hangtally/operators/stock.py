"""Stock on a date from counts, opening balances and the movement ledger.

Stores and month ends are columns, not loops: all of them are worked out in one plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hangtally import constants as K
from hangtally.functions import day
from hangtally.operators.aggregates import best_row
from hangtally.operators.joins import spread_join
from hangtally.operators.ledger import union_rows


def month_ends(asof: str, months: int) -> list[str]:
    """Month-end dates of the month of ``asof`` and the months before it, oldest first."""
    import datetime as dt
    d = dt.date.fromisoformat(asof)
    out = []
    for back in range(months - 1, -1, -1):
        m = d.year * 12 + d.month - 1 - back + 1          # the month after the wanted one
        out.append((dt.date(m // 12, m % 12 + 1, 1) - dt.timedelta(days=1)).isoformat())
    return out


def last_count_dates(counts: DataFrame, openings: DataFrame, stores: DataFrame,
                     today: str, ends: Sequence[str]) -> DataFrame:
    """Where the reconstruction of each store starts, for every end date.

    The latest count up to the end date, else the latest opening balance.  A closed store
    whose latest date (as of today) lies before the end date is left out.  If the end date
    is still ahead, a start from an open count moves back one day.
    """
    now = day(today)
    # date and "count is finished" as one number: a hash aggregate can keep its maximum
    stamp = F.unix_date("count_date") * 2 + F.when(F.col("status") == K.CLOSED, 0).otherwise(1)
    counted = counts.groupBy("store_id").agg(
        F.max(F.when(F.col("count_date") <= now, F.col("count_date"))).alias("count_now"),
        *[F.max(F.when(F.col("count_date") <= day(e), stamp)).alias(f"count_{i}") for i, e in enumerate(ends)])
    opened = openings.groupBy("store_id").agg(
        F.max(F.when(F.col("inject_date") <= now, F.col("inject_date"))).alias("open_now"),
        *[F.max(F.when(F.col("inject_date") <= day(e), F.col("inject_date"))).alias(f"open_{i}")
          for i, e in enumerate(ends)])
    both = stores.select("store_id", "hold").join(counted, "store_id", "left").join(opened, "store_id", "left")
    rows = []
    for i, e in enumerate(ends):
        found = F.date_from_unix_date(F.floor(F.col(f"count_{i}") / 2).cast("int"))
        if e > today:
            found = F.when(F.col(f"count_{i}") % 2 == 0, F.date_sub(found, 1)).otherwise(found)
        start = F.coalesce(found, F.col(f"open_{i}"))
        shut = (F.col("hold") == K.CLOSED) & (F.coalesce("count_now", "open_now") < day(e))
        rows.append(F.struct(day(e).alias("end_date"), start.alias("start_date"),
                             F.coalesce(shut, F.lit(False)).alias("shut"),
                             F.when(F.col(f"count_{i}").isNotNull(), "count").otherwise("opening").alias("origin")))
    return (both.select("store_id", F.inline(F.array(*rows)))
            .where("start_date is not null and not shut").drop("shut"))


def opening_stock(counts: DataFrame, openings: DataFrame, starts: DataFrame) -> DataFrame:
    """Counted stock from the start to the end date; stores that counted nothing in total
    take their opening balances up to the end date instead."""
    keys = ["store_id", "end_date"]
    counted = (counts.select("store_id", "sku", "count_date", "qty")
               .join(starts.select("store_id", "start_date", "end_date"), "store_id")
               .where("count_date between start_date and end_date"))
    opened = (openings.select("store_id", "sku", "inject_date", "qty")
              .join(starts.select("store_id", "end_date"), "store_id")
              .where("inject_date <= end_date"))
    sums = (union_rows([counted.select(*keys, "sku", F.col("qty").alias("counted")),
                        opened.select(*keys, "sku", F.col("qty").alias("opened"))], allow_missing=True)
            .groupBy(*keys, "sku").agg(F.sum("counted").alias("counted"), F.sum("opened").alias("opened")))
    totals = counted.groupBy(*keys).agg(F.sum("qty").alias("_total"))
    choice = F.when(F.coalesce("_total", F.lit(0)) != 0, F.col("counted")).otherwise(F.col("opened"))
    return (sums.join(totals, keys, "left").withColumn("qty", choice)
            .where("qty is not null").select(*keys, "sku", "qty"))


def ledger_in_windows(movements: DataFrame, starts: DataFrame) -> DataFrame:
    """Movement sum per store and SKU inside each store's own date window.

    Movements meet the per-store windows, those of a store with very many of them piece by piece, so
    it is worked on by many tasks; the sum after the join uses the same partitioning.
    """
    windows = starts.select("store_id", "start_date", "end_date")
    hits, piece = spread_join(in_months(movements, starts), windows, "store_id", "sku")
    return (hits.where("move_date between start_date and end_date")
            .groupBy("store_id", piece, "sku", "end_date").agg(F.sum("qty").alias("qty"))
            .drop(piece))


def months_of(windows: DataFrame) -> DataFrame:
    """The months (``yyyy-MM``) that any window of ``windows`` touches."""
    first, last = F.trunc("start_date", "MM"), F.trunc("end_date", "MM")
    return (windows.where("start_date <= end_date").select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("_d"))
            .select(F.date_format("_d", "yyyy-MM").alias("month")).distinct())


def in_months(movements: DataFrame, windows: DataFrame) -> DataFrame:
    """Movements of the months that the windows touch. Where the ledger is partitioned by its column ``month``, folders of
    other months are not read: the few months are known at run time and prune the scan."""
    if "month" not in movements.columns:
        return movements
    return movements.join(months_of(windows), "month", "left_semi")


def ledger_at_ends(movements: DataFrame, starts: DataFrame, ends: Sequence[str]) -> DataFrame:
    """Movement sum per store, SKU and end date, from each store's start for that end, in one pass for all ends.

    A store's starts for all ends stand in one row, so a movement is met once and not once per end.
    """
    windows = starts.groupBy("store_id").agg(*[F.max(F.when(F.col("end_date") == day(e), F.col("start_date"))).alias(f"_s{i}")
                                               for i, e in enumerate(ends)])
    hits, piece = spread_join(in_months(movements, starts), windows, "store_id", "sku")
    inside = [F.when(F.col("move_date").between(F.col(f"_s{i}"), day(e)), F.col("qty")) for i, e in enumerate(ends)]
    sums = hits.groupBy("store_id", piece, "sku").agg(*[F.sum(c).alias(f"_q{i}") for i, c in enumerate(inside)])
    cells = F.array(*[F.struct(day(e).alias("end_date"), F.col(f"_q{i}").alias("qty")) for i, e in enumerate(ends)])
    return sums.select("store_id", "sku", F.inline(F.filter(cells, lambda c: c["qty"].isNotNull())))


def stock_at(counts: DataFrame, openings: DataFrame, movements: DataFrame, stores: DataFrame,
             today: str, ends: Sequence[str],
             drop_zero_stores: Sequence[int] = tuple(K.ZERO_DROP_STORES), starts: DataFrame | None = None) -> DataFrame:
    """Stock per store, SKU and month end, labelled with the month it opens."""
    if starts is None:
        starts = last_count_dates(counts, openings, stores, today, ends)
    total = (union_rows([opening_stock(counts, openings, starts), ledger_at_ends(movements, starts, ends)])
             .groupBy("store_id", "sku", "end_date").agg(F.sum("qty").alias("qty")))
    opens = F.when(F.col("end_date") == F.last_day("end_date"), F.date_add("end_date", 1)).otherwise(F.col("end_date"))
    return (total.where(~(F.col("store_id").isin(list(drop_zero_stores)) & (F.col("qty") == 0)))
            .withColumn("label", F.lower(F.date_format(opens, "MMM_yy"))))


def count_or_system(counts: DataFrame, posting: DataFrame) -> DataFrame:
    """Counted quantity, else the system quantity of the posting line."""
    counted = counts.groupBy("store_id", "sku").agg(F.max("qty").alias("counted"))
    return (posting.groupBy("store_id", "sku").agg(F.sum("qty").alias("system_qty"))
            .join(counted, ["store_id", "sku"], "left")
            .withColumn("qty", F.coalesce("counted", "system_qty")))


def stock_on_date(opening: DataFrame, movements: DataFrame, today_rows: DataFrame,
                  variances: DataFrame, asof: str) -> DataFrame:
    """Month opening + movements of the month up to the date + today's ledger + variances."""
    since = F.trunc(day(asof), "MM")
    inside = lambda c: F.col(c).between(since, day(asof))
    parts = [
        opening.select("store_id", "sku", "qty"),
        movements.where(inside("move_date")).select("store_id", "sku", "qty"),
        today_rows.select("store_id", "sku", "qty"),
        variances.where(inside("move_date")).select("store_id", "sku", "qty"),
    ]
    return union_rows(parts).groupBy("store_id", "sku").agg(F.sum("qty").alias("stocks"))


def free_stock(on_hand: DataFrame, later: DataFrame, pending: DataFrame) -> DataFrame:
    """On hand + what moved afterwards - quantities already promised back."""
    parts = [
        on_hand.select("store_id", "sku", "stocks"),
        later.select("store_id", "sku", F.col("qty").alias("stocks")),
        pending.select("store_id", "sku", (-F.col("qty")).alias("stocks")),
    ]
    return union_rows(parts).groupBy("store_id", "sku").agg(F.sum("stocks").alias("stocks"))


def stock_variance(counts: DataFrame, openings: DataFrame, stores: DataFrame,
                   since_count: str, since_open: str) -> DataFrame:
    """Count variances, the reversal of the last count of closed stores, opening injections."""
    variance = (counts.where((F.col("variance") != 0) & (F.col("count_date") > day(since_count)))
                .select("store_id", "sku", F.col("variance").alias("qty"),
                        F.col("count_date").alias("move_date"), F.lit("varian").alias("stat")))
    last = counts.groupBy("store_id").agg(F.max("count_date").alias("count_date"))
    closed = last.join(stores.where(F.col("hold") == K.CLOSED).select("store_id"), "store_id", "left_semi")
    reversal = (counts.where((F.col("qty") != 0) & (F.col("count_date") > day(since_open)))
                .join(closed, ["store_id", "count_date"], "left_semi")
                .select("store_id", "sku", (-F.col("qty")).alias("qty"),
                        F.col("count_date").alias("move_date"), F.lit("tutup").alias("stat")))
    injected = (openings.where(F.col("inject_date") > day(since_open))
                .join(stores.where("consigned").select("store_id"), "store_id", "left_semi")
                .select("store_id", "sku", "qty", F.col("inject_date").alias("move_date"),
                        F.lit("awal").alias("stat")))
    return union_rows([variance, reversal, injected])


def rows_at_last_date(df: DataFrame, key: str, date: str) -> DataFrame:
    """Rows whose date is the latest of their key (the correlated-maximum filter)."""
    last = df.groupBy(key).agg(F.max(date).alias(date))
    return df.join(last, [key, date], "left_semi")


def latest_one(df: DataFrame, key: str, date: str, columns: Sequence[str]) -> DataFrame:
    """The latest row of every key at once."""
    return best_row(df, [key], [F.col(date), *[F.col(c) for c in columns if c != date]], columns)


# ---- monthly wide tables ---------------------------------------------------

def year_ends(year: int) -> list[str]:
    """The month ends whose snapshots open the months of the year and the January after it."""
    return month_ends(f"{year}-12-31", 13)


def month_stock_wide(snapshots: DataFrame, year: int) -> DataFrame:
    """Stock at the begin of each month of the year, and of the next January, from snapshots (store_id, sku, end_date, qty)."""
    cells = [F.expr(f"coalesce(sum(case when end_date = date'{e}' then qty end), 0D) as stock_{m:02d}")
             for m, e in enumerate(year_ends(year), 1)]
    return snapshots.groupBy("store_id", "sku").agg(*cells)


def sell_through(stock: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Stock and sales side by side: total per month = next month's stock + the month's sales.

    ``stock`` has stock_01 .. stock_13, ``sales`` qty_01 .. qty_12, ``returns`` qty.  Rows
    in which every stock measure is 0 are dropped.
    """
    keys = ["store_id", "sku"]
    stock_cols = [f"stock_{m:02d}" for m in range(1, 14)]
    qty_cols = [f"qty_{m:02d}" for m in range(1, 13)]
    both = stock.join(sales, keys, "full").fillna(0, subset=stock_cols + qty_cols)
    both = both.withColumns({
        **{f"ts_{m:02d}": F.expr(f"qty_{m:02d} + stock_{m + 1:02d}" if m < 12 else "qty_12") for m in range(1, 13)},
        "total_sales_qty": F.expr(" + ".join(qty_cols))})
    both = both.withColumn("ts_all", F.col("stock_13") + F.col("total_sales_qty"))
    back = returns.groupBy(*keys).agg((-F.sum("qty")).alias("qty_retur"))
    out = both.join(back, keys, "left")
    checked = [F.col(c) for c in [*stock_cols[:12], "ts_all", "qty_retur"]]
    return out.where((F.least(*checked) != 0) | (F.greatest(*checked) != 0))


def sell_through_wide(table: DataFrame, articles: DataFrame) -> DataFrame:
    """Report columns of the sell-through table; rows whose SKU has no size are left out."""
    sized = table.join(articles.where("size is not null").select("sku", "size"), "sku")
    cols = ["store_id", "sku", "size"]
    for m in range(1, 13):
        cols += [f"stock_{m:02d}", f"ts_{m:02d}", f"qty_{m:02d}"]
    return sized.select(*cols, F.col("stock_13").alias("stock_at"), "qty_retur", "ts_all",
                        "total_sales_qty")


def month_labels(year: int) -> dict[str, str]:
    """Report names of the month columns, as in 'qty jan 97'."""
    out = {}
    for i, name in enumerate(K.MONTH_NAMES, start=1):
        for short, long in (("qty", "qty"), ("stock", "stock"), ("ts", "total stock")):
            out[f"{short}_{i:02d}"] = f"{long} {name} {year % 100:02d}"
    return out


REPORT_LABELS = {
    "qty_retur": "qty retur", "total_sales_qty": "total sales qty", "stock_at": "stock akhir",
    "ts_all": "total stock", "warehouse_stock": "stock gudang", "store_code": "code toko",
    "store_name": "toko", "article": "artikel",
}


def next_month_stock(monthly: DataFrame) -> DataFrame:
    """Long form: total of a month = stock of the next month + sales of the month.

    At most one row per month and SKU, so the window is bounded by the calendar."""
    order = Window.partitionBy("store_id", "sku").orderBy("month")
    follows = F.add_months("month", 1) == F.lead("month").over(order)
    ahead = F.when(follows, F.lead("stock").over(order))
    return monthly.withColumn("total_stock", F.coalesce(ahead, F.lit(0.0)) + F.col("sales"))
