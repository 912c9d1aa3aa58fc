"""Scans, unions, upserts, key checks, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hangtally.catalog.registry import query
from hangtally.functions import day, surrogate_key
from hangtally.operators import aggregates as A
from hangtally.operators import outstanding as O
from hangtally.operators.joins import null_safe_anti
from hangtally.operators.ledger import net, union_rows
from hangtally.operators.numbering import number_rows
from hangtally.operators.upsert import merge_upsert, merge_upsert_columns
from hangtally.session import scratch_path
from hangtally.sources.keyed import KeyedTable
from hangtally.sources.readers import read_snapshots, snapshot_labels


@query("scan_projected", "SELECT sku, article, price FROM article")
def _(s):
    return s.article.select("sku", "article", "price")


@query("scan_year_partition", """
    SELECT doc_id, cust_id, sales_date, doc_total FROM sales_header
    WHERE sales_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""", dates=["sales_date"])
def _(s):
    year = s.between("1997-01-01", "1997-12-31")
    return year.sales_header.select("doc_id", "cust_id", "sales_date", "doc_total")


@query("snapshot_files_union", """
    SELECT store_id, sku, LOWER(STRFTIME(move_date, '%b_%y')) AS label, SUM(qty) AS qty FROM movement
    WHERE move_date >= DATE '1996-01-01' AND move_date < DATE '1998-02-01' GROUP BY ALL""")
def _(s):
    moves = s.between("1996-01-01", "1998-12-31").movement
    path = scratch_path(s.spark, "snapshots")
    (net(moves.withColumn("label", F.lower(F.date_format("move_date", "MMM_yy"))), ("store_id", "sku", "label"))
     .hint("rebalance", "label").write.partitionBy("label").parquet(path))
    return read_snapshots(s.spark, path, snapshot_labels(1996, 1997))


UPSERT_OLD = "SELECT o_orderkey AS doc_id, o_orderstatus AS status, o_totalprice AS doc_total, CAST(o_orderdate AS DATE) AS doc_date FROM orders"


def order_rows(s):
    return s.orders.select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("status"),
                           F.col("o_totalprice").alias("doc_total"), F.to_date("o_orderdate").alias("doc_date"))


def changed_orders(s, since):
    return order_rows(s.between(since, None)).withColumn(
        "doc_total", F.when(F.col("doc_id") % 10 == 0, F.col("doc_total") * 2).otherwise(F.col("doc_total")))


@query("merge_upsert", f"""
    WITH old AS ({UPSERT_OLD} WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
    new AS (SELECT doc_id, status, CASE WHEN doc_id % 10 = 0 THEN doc_total * 2 ELSE doc_total END AS doc_total, doc_date
            FROM ({UPSERT_OLD}) AS x WHERE doc_date >= DATE '1999-07-01')
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new)""", dates=["doc_date"])
def _(s):
    return merge_upsert(order_rows(s.between(None, "1999-12-31")), changed_orders(s, "1999-07-01"), ["doc_id"])


@query("keyed_upsert", f"""
    WITH old AS ({UPSERT_OLD} WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
    new AS (SELECT doc_id, status, CASE WHEN doc_id % 10 = 0 THEN doc_total * 2 ELSE doc_total END AS doc_total, doc_date
            FROM ({UPSERT_OLD}) AS x WHERE doc_date >= DATE '1999-07-01'),
    merged AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new))
    SELECT doc_id, status, CASE WHEN doc_date >= DATE '2001-01-01' THEN doc_total / 2 ELSE doc_total END AS doc_total, doc_date FROM merged""",
       dates=["doc_date"])
def _(s):
    """Whole rows, then one column, into the kept table; the second change starts at the mark of its list."""
    before = order_rows(s.between(None, "1999-12-31"))
    table = KeyedTable(s.spark, scratch_path(s.spark, "orders"), before.schema, ["doc_id"], "doc_date", 16)
    table.create(before)
    table.upsert(changed_orders(s, "1999-07-01"))
    halved = table.rows().where("doc_date >= date'2001-01-01'").select("doc_id", (F.col("doc_total") / 2).alias("doc_total"))
    table.upsert(halved, ["doc_total"])
    return table.rows()


@query("merge_upsert_columns", f"""
    WITH old AS ({UPSERT_OLD} WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
    new AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN doc_total * 2 ELSE doc_total END AS doc_total
            FROM ({UPSERT_OLD}) AS x WHERE doc_date >= DATE '1999-07-01')
    SELECT COALESCE(o.doc_id, n.doc_id) AS doc_id, o.status,
           CASE WHEN n.doc_id IS NOT NULL THEN n.doc_total ELSE o.doc_total END AS doc_total, o.doc_date
    FROM old o FULL JOIN new n ON o.doc_id = n.doc_id""", dates=["doc_date"])
def _(s):
    new = changed_orders(s, "1999-07-01").select("doc_id", "doc_total")
    return merge_upsert_columns(order_rows(s.between(None, "1999-12-31")), new, ["doc_id"], ["doc_total"])


@query("high_water_mark", "SELECT CAST(MAX(input_ts) AS VARCHAR) AS max_input, CAST(MIN(input_ts) AS VARCHAR) AS min_input FROM intraday")
def _(s):
    return O.high_water_mark(s.intraday, "input_ts")


OPEN_LINES = """
    open_line AS (SELECT CONCAT(CAST(doc_id AS VARCHAR), '/', CAST(sku AS VARCHAR)) AS pk_id, doc_id, sku, cust_id, input_date, SUM(qty) AS qty
                  FROM delivery_line JOIN delivery USING (doc_id)
                  WHERE status = 'F' AND doc_id NOT IN (SELECT doc_id FROM receiving) GROUP BY ALL),
    all_line AS (SELECT CONCAT(CAST(doc_id AS VARCHAR), '/', CAST(sku AS VARCHAR)) AS pk_id, doc_id, sku, cust_id, input_date, SUM(qty) AS qty
                 FROM delivery_line JOIN delivery USING (doc_id) WHERE status = 'F'
                  AND input_date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30' GROUP BY ALL)"""


def open_lines(s):
    rows = O.outstanding(s.delivery, s.delivery_line, s.receiving, ["doc_id", "sku", "cust_id", "input_date"], "qty")
    return O.with_delivery_key(rows)


def stored_lines(s):
    """What an earlier run stored: everything shipped in a range of input dates."""
    shipped = s.delivery.where((F.col("status") == "F") & F.col("input_date").between("1996-01-01", "2000-06-30"))
    rows = s.delivery_line.join(shipped, "doc_id").groupBy("doc_id", "sku", "cust_id", "input_date").agg(F.sum("qty").alias("qty"))
    return O.with_delivery_key(rows)


@query("incremental_extract", f"""
    WITH {OPEN_LINES}
    SELECT * FROM open_line WHERE input_date >= (SELECT MAX(input_date) FROM all_line)""", dates=["input_date"])
def _(s):
    return O.newer_than_mark(open_lines(s), stored_lines(s), "input_date")


@query("stale_key_detect", f"""
    WITH {OPEN_LINES}
    SELECT pk_id FROM all_line WHERE pk_id NOT IN (SELECT pk_id FROM open_line)""")
def _(s):
    return O.stale_keys(open_lines(s), stored_lines(s), "pk_id", "input_date")


@query("incremental_outstanding", f"""
    WITH {OPEN_LINES},
    fresh AS (SELECT * FROM open_line WHERE input_date >= (SELECT MAX(input_date) FROM all_line))
    SELECT * FROM all_line WHERE pk_id IN (SELECT pk_id FROM open_line) AND pk_id NOT IN (SELECT pk_id FROM fresh)
    UNION ALL
    SELECT * FROM fresh""", dates=["input_date"])
def _(s):
    """The refresh on the kept table: marks from its list, the source read once, only touched buckets written."""
    before = stored_lines(s)
    table = KeyedTable(s.spark, scratch_path(s.spark, "outstanding"), before.schema, ["pk_id"], "input_date", 16)
    table.create(before)
    table.refresh(open_lines(s))
    return table.rows()


@query("pk_violations", """
    SELECT doc_id, line_no, COUNT(*) AS n, 'duplicate' AS problem FROM sales_line GROUP BY doc_id, line_no HAVING COUNT(*) > 1""")
def _(s):
    return A.key_violations(s.sales_line.select("doc_id", "line_no"), ["doc_id", "line_no"])


@query("fk_orphans", """
    SELECT sku, COUNT(*) AS n FROM sales_line WHERE sku NOT IN (SELECT sku FROM article WHERE size IS NOT NULL) GROUP BY sku""")
def _(s):
    return A.orphans(s.sales_line, s.article.where("size is not null"), "sku")


# ---- unions ----------------------------------------------------------------

@query("union_years", """
    SELECT store_id, sku, SUM(qty) AS qty FROM sales_line WHERE sales_date >= DATE '1996-01-01' AND sales_date < DATE '1998-01-01' GROUP BY ALL""")
def _(s):
    # two year tables are two ranges of one dated table: one scan
    return s.between("1996-01-01", "1997-12-31").sales_line.groupBy("store_id", "sku").agg(F.sum("qty").alias("qty"))


@query("concat_sparse", """
    SELECT doc_id, doc_total / 100 AS cut, CAST(NULL AS DOUBLE) AS fee FROM sales_header WHERE doc_no LIKE 'PJ%'
    UNION ALL SELECT doc_id, NULL, doc_total / 200 FROM sales_header WHERE doc_no LIKE 'BZ%'""")
def _(s):
    h = s.sales_header
    cuts = h.where(F.col("doc_no").startswith("PJ")).select("doc_id", (F.col("doc_total") / 100).alias("cut"))
    fees = h.where(F.col("doc_no").startswith("BZ")).select("doc_id", (F.col("doc_total") / 200).alias("fee"))
    return union_rows([cuts, fees], allow_missing=True)


@query("dedup_rows", "SELECT DISTINCT doc_id, line_no, line_status FROM sales_line")
def _(s):
    return s.sales_line.select("doc_id", "line_no", "line_status").distinct()


@query("dedup_key_first", """
    SELECT doc_id, line_no, store_id, sku, qty FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY line_no, store_id, sku, qty) AS rn FROM sales_line) AS x
    WHERE rn = 1""")
def _(s):
    cols = ["line_no", "store_id", "sku", "qty"]
    return A.least_row(s.sales_line, ["doc_id"], [F.col(c) for c in cols], cols)


# ---- sorts and tops --------------------------------------------------------

@query("sort_report", "SELECT store_id, store_code, store_name, city FROM store ORDER BY store_name")
def _(s):
    return s.store.select("store_id", "store_code", "store_name", "city").orderBy("store_name")


@query("latest_one", """
    SELECT store_id, MAX(count_date) AS count_date, MAX_BY(status, (count_date, status)) AS status FROM stock_count GROUP BY store_id""",
       dates=["count_date"])
def _(s):
    from hangtally.operators.stock import latest_one
    return latest_one(s.stock_count, "store_id", "count_date", ["count_date", "status"])


@query("top_n_frequency", """
    SELECT sku, COUNT(*) AS n FROM sales_line GROUP BY sku ORDER BY n DESC, sku LIMIT 20""")
def _(s):
    return A.top_values(s.sales_line, "sku", 20)


@query("value_frequency", "SELECT article_status, COUNT(*) AS n FROM sales_line WHERE article_status IS NOT NULL GROUP BY 1")
def _(s):
    return A.value_frequency(s.sales_line, "article_status").orderBy(F.desc("n"))
