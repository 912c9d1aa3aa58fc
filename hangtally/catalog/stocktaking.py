"""Stock on a date, sell-through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from hangtally import functions as X
from hangtally.catalog.extracts import BALANCE, LINES, balances, today_sql
from hangtally.catalog.registry import pct, query
from hangtally.catalog.sizes import cells, plus, status_sql
from hangtally import constants as K
from hangtally.operators import sales as S
from hangtally.operators import ledger as L
from hangtally.operators import snapshots as SN
from hangtally.operators import stock as ST
from hangtally.plans import stock_reports as R
from hangtally.session import scratch_path
from hangtally.sources.readers import within_months
from hangtally.sources.versions import written

TODAY = "2001-05-15"
ENDS = ST.month_ends(TODAY, 3)


def starts_sql(ends: Sequence[str], today: str, tag: str = "") -> str:
    """CTE ``starts``: where each store's reconstruction begins for each end date."""
    return f"""
    ends{tag} AS (SELECT UNNEST([{", ".join(f"DATE '{e}'" for e in ends)}]) AS end_date),
    cnt{tag} AS (SELECT store_id, end_date, MAX(count_date) AS d, MAX_BY(status, (count_date, status)) AS s
            FROM stock_count, ends{tag} WHERE count_date <= end_date GROUP BY ALL),
    opn{tag} AS (SELECT store_id, end_date, MAX(inject_date) AS d FROM opening_balance, ends{tag} WHERE inject_date <= end_date GROUP BY ALL),
    nowc{tag} AS (SELECT store_id, MAX(count_date) AS d FROM stock_count WHERE count_date <= DATE '{today}' GROUP BY ALL),
    nowo{tag} AS (SELECT store_id, MAX(inject_date) AS d FROM opening_balance WHERE inject_date <= DATE '{today}' GROUP BY ALL),
    starts{tag} AS (SELECT st.store_id, e.end_date,
        CASE WHEN e.end_date > DATE '{today}' AND c.s = 'T' THEN c.d - 1 ELSE COALESCE(c.d, o.d) END AS start_date,
        CASE WHEN c.d IS NOT NULL THEN 'count' ELSE 'opening' END AS origin
      FROM store st CROSS JOIN ends{tag} e
      LEFT JOIN cnt{tag} c ON c.store_id = st.store_id AND c.end_date = e.end_date
      LEFT JOIN opn{tag} o ON o.store_id = st.store_id AND o.end_date = e.end_date
      LEFT JOIN nowc{tag} nc ON nc.store_id = st.store_id LEFT JOIN nowo{tag} no ON no.store_id = st.store_id
      WHERE COALESCE(c.d, o.d) IS NOT NULL AND NOT (st.hold = 'T' AND COALESCE(nc.d, no.d, DATE '9999-01-01') < e.end_date))"""


def opened_sql(ends: Sequence[str], today: str, tag: str = "") -> str:
    return f"""{starts_sql(ends, today, tag)},
    counted{tag} AS (SELECT s.store_id, end_date, sku, SUM(qty) AS qty FROM stock_count c JOIN starts{tag} s ON s.store_id = c.store_id
                WHERE count_date BETWEEN start_date AND end_date GROUP BY ALL),
    tot{tag} AS (SELECT s.store_id, s.end_date, COALESCE(SUM(qty), 0) AS t FROM starts{tag} s LEFT JOIN counted{tag} c
            ON c.store_id = s.store_id AND c.end_date = s.end_date GROUP BY ALL),
    opened{tag} AS (SELECT store_id, end_date, sku, qty FROM counted{tag} WHERE (store_id, end_date) IN (SELECT (store_id, end_date) FROM tot{tag} WHERE t <> 0)
      UNION ALL SELECT z.store_id, end_date, sku, SUM(qty) FROM opening_balance o JOIN tot{tag} z ON z.store_id = o.store_id
      WHERE t = 0 AND inject_date <= end_date GROUP BY ALL)"""


def stock_sql(ends: Sequence[str], today: str, tag: str = "") -> str:
    """CTE ``snap``: stock per store, SKU and end date."""
    return f"""{opened_sql(ends, today, tag)},
    moved{tag} AS (SELECT s.store_id, end_date, sku, SUM(qty) AS qty FROM movement m JOIN starts{tag} s ON s.store_id = m.store_id
              WHERE move_date BETWEEN start_date AND end_date GROUP BY ALL),
    snap{tag} AS (SELECT store_id, sku, end_date, SUM(qty) AS qty FROM (SELECT store_id, sku, end_date, qty FROM opened{tag}
              UNION ALL SELECT store_id, sku, end_date, qty FROM moved{tag}) AS x GROUP BY store_id, sku, end_date)"""


def sources(s) -> SN.Sources:
    return SN.Sources(s.counted, s.opened, s.ledger, s.store)


def starts(s):
    return ST.last_count_dates(s.counted, s.opened, s.store, TODAY, ENDS)


def snapshots(s, today: str, ends: Sequence[str]):
    """Month snapshots kept as files: built once in a session, read by all reports that need them."""
    def build(own):
        table = SN.MonthSnapshots(own.spark, scratch_path(own.spark, "snapshots"))
        table.build(sources(own), today, ends)
        return table.read()
    return s.derived(f"snapshots-{ends[0]}-{ends[-1]}-{today}", build)


@query("last_count_date", f"WITH {starts_sql(ENDS, TODAY)} SELECT store_id, end_date, start_date, origin FROM starts", dates=["end_date", "start_date"])
def _(s):
    return starts(s)


@query("opening_stock", f"WITH {opened_sql(ENDS, TODAY)} SELECT * FROM opened", dates=["end_date"])
def _(s):
    return ST.opening_stock(s.counted, s.opened, written(starts(s), "starts"))


@query("stock_at_month_end", f"""
    WITH {stock_sql(ENDS, TODAY)}
    SELECT store_id, sku, end_date, qty, LOWER(STRFTIME(end_date + 1, '%b_%y')) AS label FROM snap
    WHERE NOT (store_id IN (5, 6, 7) AND qty = 0)""", dates=["end_date"])
def _(s):
    return ST.stock_at(s.counted, s.opened, s.ledger, s.store, TODAY, ENDS, drop_zero_stores=[5, 6, 7], starts=written(starts(s), "starts"))


CHAIN = ST.month_ends("1997-05-31", 4)


@query("month_snapshot_chain", f"WITH {stock_sql(CHAIN, '1997-07-01')} SELECT * FROM snap", dates=["end_date"])
def _(s):
    """Two months built, two added one by one from a ledger that lacks some lines, then these lines late."""
    missing = (F.col("sku") % 10 == 3) & (F.col("month") == "1997-03")
    src = sources(s)
    early = SN.Sources(src.counts, src.openings, src.ledger.where(~missing), src.stores)
    table = SN.MonthSnapshots(s.spark, scratch_path(s.spark, "snapshot-chain"))
    table.build(early, "1997-07-01", CHAIN[:2])
    for end in CHAIN[2:]:
        table.advance(early, "1997-07-01", end)
    table.late(src.ledger.where(missing))
    return table.read()


@query("count_dates", """
    SELECT DISTINCT store_id, count_date AS day, 'count' AS kind FROM stock_count
    UNION ALL SELECT DISTINCT store_id, inject_date, 'opening' FROM opening_balance""", dates=["day"])
def _(s):
    counts = s.stock_count.select("store_id", F.col("count_date").alias("day")).distinct().withColumn("kind", F.lit("count"))
    opens = s.opening_balance.select("store_id", F.col("inject_date").alias("day")).distinct().withColumn("kind", F.lit("opening"))
    return counts.unionByName(opens)


@query("count_stock_fallback", """
    WITH p AS (SELECT store_id, sku, SUM(qty) AS system_qty FROM movement GROUP BY ALL),
    c AS (SELECT store_id, sku, MAX(qty) AS counted FROM stock_count GROUP BY ALL)
    SELECT store_id, sku, COALESCE(counted, system_qty) AS qty FROM p LEFT JOIN c USING (store_id, sku)""")
def _(s):
    return ST.count_or_system(s.stock_count, s.movement).select("store_id", "sku", "qty")


VARIANCE = """
    variance AS (SELECT store_id, sku, variance AS qty, count_date AS move_date, 'varian' AS stat FROM stock_count
                 WHERE variance <> 0 AND count_date > DATE '1996-01-01'
      UNION ALL SELECT a.store_id, sku, -qty, count_date, 'tutup' FROM stock_count a JOIN store USING (store_id)
      WHERE hold = 'T' AND qty <> 0 AND count_date > DATE '1995-06-01'
        AND count_date = (SELECT MAX(count_date) FROM stock_count b WHERE b.store_id = a.store_id)
      UNION ALL SELECT store_id, sku, qty, inject_date, 'awal' FROM opening_balance JOIN store USING (store_id)
      WHERE inject_date > DATE '1995-06-01' AND consigned)"""


def variances(s):
    return ST.stock_variance(s.counted, s.opened, s.store, "1996-01-01", "1995-06-01")


@query("stock_variance", f"WITH {VARIANCE} SELECT * FROM variance", dates=["move_date"])
def _(s):
    return variances(s)


ASOF, OPENS, ENTERED = "2000-06-17", "2000-05-31", "2000-06-18"
ON_HAND = f"""{VARIANCE}, {stock_sql([OPENS], ASOF)}, {LINES}, day_row AS ({today_sql(ENTERED)}),
    on_hand AS (SELECT store_id, sku, SUM(qty) AS stocks FROM (
        SELECT store_id, sku, qty FROM snap
        UNION ALL SELECT store_id, sku, qty FROM movement WHERE move_date BETWEEN DATE '2000-06-01' AND DATE '{ASOF}'
        UNION ALL SELECT store_id, sku, qty FROM day_row
        UNION ALL SELECT store_id, sku, qty FROM variance WHERE move_date BETWEEN DATE '2000-06-01' AND DATE '{ASOF}') AS x
      GROUP BY store_id, sku)"""


def month_to_date(s):
    return within_months(s.ledger, "move_date", "2000-06-01", ASOF)


def on_hand(s):
    """The month's opening snapshot, the month's ledger, the ledger of the day that is still open, and count variances."""
    entered = s.derived(f"day-ledger-{ENTERED}", lambda own: L.net(L.day_rows(own.docs, ENTERED), ("store_id", "sku")))
    return ST.stock_on_date(snapshots(s, ASOF, [OPENS]), month_to_date(s), entered, variances(s), ASOF)


@query("stock_on_date", f"""
    WITH {ON_HAND} SELECT o.store_id, o.sku, stocks, article, size, size_class, category, brand, price, store_code,
      store_code || ' - ' || store_name AS store_label
    FROM on_hand o LEFT JOIN article USING (sku) LEFT JOIN store USING (store_id)""")
def _(s):
    return (on_hand(s).join(s.article.select("sku", "article", "size", "size_class", "category", "brand", "price"), "sku", "left")
            .join(s.store.select("store_id", "store_code", X.code_label("store_code", "store_name").alias("store_label")), "store_id", "left"))


@query("free_stock", f"""
    WITH {ON_HAND} SELECT store_id, sku, SUM(stocks) AS stocks FROM (
      SELECT * FROM on_hand
      UNION ALL SELECT store_id, sku, qty FROM movement WHERE move_date >= DATE '2000-06-19' AND move_date <= DATE '2000-08-31'
      UNION ALL SELECT l_suppkey, l_partkey, -l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 2) AS x
    GROUP BY store_id, sku""")
def _(s):
    pending = s.lineitem.where("l_returnflag = 'R' and l_linenumber = 2").select(
        F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("sku"), F.col("l_quantity").alias("qty"))
    return ST.free_stock(on_hand(s), within_months(s.ledger, "move_date", "2000-06-19", "2000-08-31"), pending)


@query("movement_by_stat", f"""
    WITH {VARIANCE}, {stock_sql([OPENS], ASOF)},
    r AS (SELECT store_id, sku, qty, 'st' AS stat FROM snap
      UNION ALL SELECT store_id, sku, qty, stat FROM movement WHERE move_date BETWEEN DATE '2000-06-01' AND DATE '{ASOF}'
      UNION ALL SELECT store_id, sku, qty, 'var' FROM variance WHERE move_date BETWEEN DATE '2000-06-01' AND DATE '{ASOF}')
    SELECT store_id, sku, stat, SUM(qty) AS stocks, article, size, store_code || ' - ' || store_name AS store_label
    FROM r LEFT JOIN article USING (sku) LEFT JOIN store USING (store_id) GROUP BY ALL""")
def _(s):
    cols = ("store_id", "sku", "qty", "stat")
    rows = L.union_rows([
        snapshots(s, ASOF, [OPENS]).withColumn("stat", F.lit("st")).select(*cols), month_to_date(s).select(*cols),
        variances(s).where(F.col("move_date").between("2000-06-01", ASOF)).withColumn("stat", F.lit("var")).select(*cols)])
    labels = s.store.select("store_id", X.code_label("store_code", "store_name").alias("store_label"))
    return (L.net(rows, ("store_id", "sku", "stat"), "stocks").join(s.article.select("sku", "article", "size"), "sku", "left")
            .join(labels, "store_id", "left"))


# ---- sell-through ----------------------------------------------------------

REPORT_DAY = "1998-02-15"


def sell_through_sql(year: int, tag: str) -> str:
    months = range(1, 13)
    ends = ST.year_ends(year)
    stock = ", ".join(f"COALESCE(SUM(CASE WHEN end_date = DATE '{e}' THEN qty END), 0) AS stock_{m:02d}" for m, e in enumerate(ends, 1))
    qty = ", ".join(f"COALESCE(SUM(CASE WHEN MONTH(h.sales_date) = {m} THEN qty END), 0) AS qty_{m:02d}" for m in months)
    zero = ", ".join([f"COALESCE(stock_{m:02d}, 0) AS stock_{m:02d}" for m in range(1, 14)] + [f"COALESCE(qty_{m:02d}, 0) AS qty_{m:02d}" for m in months])
    ts = ", ".join(f"qty_{m:02d} + {f'stock_{m + 1:02d}' if m < 12 else '0'} AS ts_{m:02d}" for m in months)
    checked = ", ".join([f"stock_{m:02d}" for m in months] + ["ts_all", "qty_retur"])
    return f"""{stock_sql(ends, REPORT_DAY, tag)},
    stock{tag} AS (SELECT store_id, sku, {stock} FROM snap{tag} GROUP BY store_id, sku),
    sales{tag} AS (SELECT store_id, sku, {qty} FROM sales_line l JOIN sales_header h USING (doc_id)
                   WHERE YEAR(h.sales_date) = {year} AND doc_no LIKE 'PJ%' AND status <> 'F' AND line_status <> 'F' GROUP BY store_id, sku),
    back{tag} AS (SELECT store_id, sku, -SUM(qty) AS qty_retur FROM movement WHERE stat = 'retur' AND YEAR(move_date) = {year} GROUP BY store_id, sku),
    both{tag} AS (SELECT store_id, sku, {zero} FROM stock{tag} FULL JOIN sales{tag} USING (store_id, sku)),
    totals{tag} AS (SELECT *, {ts}, {" + ".join(f"qty_{m:02d}" for m in months)} AS total_sales_qty FROM both{tag}),
    all{tag} AS (SELECT *, stock_13 + total_sales_qty AS ts_all FROM totals{tag} LEFT JOIN back{tag} USING (store_id, sku)),
    st{tag} AS (SELECT * FROM all{tag} WHERE LEAST({checked}) <> 0 OR GREATEST({checked}) <> 0),
    wide{tag} AS (SELECT st{tag}.* EXCLUDE (stock_13), stock_13 AS stock_at, size FROM st{tag} JOIN article USING (sku) WHERE size IS NOT NULL)"""


def year_stock(s, year: int):
    return ST.month_stock_wide(snapshots(s, REPORT_DAY, ST.year_ends(year)), year)


def sell_through(s, year):
    headers = s.between(f"{year}-01-01", f"{year}-12-31").sales_header
    sales = S.monthly_sales_wide(S.documented_lines(headers, s.sales_line), year)
    returns = within_months(s.ledger, "move_date", f"{year}-01-01", f"{year}-12-31").where(F.col("stat") == K.RETURN)
    return ST.sell_through(year_stock(s, year), sales, returns)


def flags_sql(year: int) -> str:
    flags = ", ".join(f"CAST(SUM(stock_{m:02d}) > 1 AS INTEGER) AS art_{m:02d}" for m in range(1, 13))
    return f"WITH {sell_through_sql(year, 'a')} SELECT store_id, article, {flags}, SUM(stock_13) > 1 AS art_at FROM stocka JOIN article USING (sku) GROUP BY ALL"


@query("article_count_flags", flags_sql(1997))
def _(s):
    return R.article_count_flags(year_stock(s, 1997), s.article)


@query("sell_through_table", f"WITH {sell_through_sql(1997, 'a')} SELECT * FROM sta")
def _(s):
    return sell_through(s, 1997)


@query("sell_through_wide", f"WITH {sell_through_sql(1997, 'a')} SELECT * FROM widea")
def _(s):
    return ST.sell_through_wide(sell_through(s, 1997), s.article)


@query("sell_through_pct", f"""
    WITH {sell_through_sql(1997, 'a')}
    SELECT store_id, sku, total_sales_qty AS sales, stock_13 + total_sales_qty AS stock_start,
           {pct('total_sales_qty', '(stock_13 + total_sales_qty)')} AS sell_thru FROM sta""")
def _(s):
    return sell_through(s, 1997).select(
        "store_id", "sku", F.col("total_sales_qty").alias("sales"), F.col("ts_all").alias("stock_start"),
        X.percent("total_sales_qty", "ts_all").alias("sell_thru"))


def labelled(year: int, source: str = "") -> str:
    return ", ".join(f'{source}{k} AS "{v}"' for k, v in ST.month_labels(year).items())


@query("article_size_report_store", f"""
    WITH {sell_through_sql(1997, 'a')},
    r AS (SELECT * FROM widea LEFT JOIN (SELECT sku, article, size_class FROM article) AS a USING (sku) LEFT JOIN store USING (store_id)),
    p AS (SELECT store_id, article, MAX(size_class) AS size_class, {cells('stock_at')} FROM r GROUP BY store_id, article),
    x AS (SELECT store_id, article, {status_sql()} AS status FROM p)
    SELECT CAST(r.store_id AS VARCHAR) || '/' || CAST(sku AS VARCHAR) AS pk_id, sku, store_code AS "code toko", store_name AS toko,
           r.article AS artikel, size, size_class AS "bot/top", status, {labelled(1997)}, stock_at AS "stock akhir", qty_retur AS "qty retur",
           ts_all AS "total stock", total_sales_qty AS "total sales qty"
    FROM r LEFT JOIN x ON x.store_id = r.store_id AND x.article = r.article""")
def _(s):
    return R.report_by_store(ST.sell_through_wide(sell_through(s, 1997), s.article), s.article, s.store, 1997)


def summed(tag: str, year: int) -> str:
    cols = ", ".join(f'COALESCE(SUM({k}), 0) AS "{v}"' for k, v in ST.month_labels(year).items())
    return f"""
    sum{tag} AS (SELECT sku, {cols}, COALESCE(SUM(qty_retur), 0) AS "retur {year}", SUM(total_sales_qty) AS sales{tag}, SUM(stock_at) AS at{tag}
                 FROM wide{tag} GROUP BY sku)"""


def zeroed(year: int) -> str:
    return ", ".join(f'COALESCE("{v}", 0) AS "{v}"' for v in ST.month_labels(year).values()) + f', COALESCE("retur {year}", 0) AS "retur {year}"'


@query("article_size_report_total", f"""
    WITH {sell_through_sql(1996, 'a')}, {sell_through_sql(1997, 'b')}, {summed('a', 1996)}, {summed('b', 1997)}, {BALANCE},
    wh AS (SELECT sku, SUM(stock) AS w FROM bal WHERE type_name IN ('RETUR', 'PUSAT', 'KONSINETTO', 'QC') AND article IS NOT NULL GROUP BY sku),
    r AS (SELECT sku, {zeroed(1996)}, {zeroed(1997)}, COALESCE(atb, 0) AS "stock akhir", COALESCE(w, 0) AS "stock gudang",
                 COALESCE(salesa, 0) + COALESCE(salesb, 0) AS "total sales qty",
                 COALESCE(salesa, 0) + COALESCE(salesb, 0) + COALESCE(atb, 0) AS "total stock"
          FROM suma FULL JOIN sumb USING (sku) FULL JOIN wh USING (sku)),
    j AS (SELECT r.*, article, size, size_class FROM r JOIN article USING (sku)),
    p AS (SELECT article, MAX(size_class) AS size_class, {cells('"stock akhir"')} FROM j GROUP BY article),
    x AS (SELECT article, {status_sql()} AS status FROM p)
    SELECT j.* EXCLUDE (article, size_class), j.article AS artikel, size_class AS "bot/top", status FROM j LEFT JOIN x USING (article)""")
def _(s):
    from hangtally.operators import warehouse as W
    last, this = (ST.sell_through_wide(sell_through(s, y), s.article) for y in (1996, 1997))
    return R.report_total(last, this, W.stock_by_sku(balances(s)), s.article, 1996, 1997)
