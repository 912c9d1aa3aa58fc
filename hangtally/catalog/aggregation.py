"""Group sums, discounts, numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally import functions as X
from hangtally.catalog.registry import half_even, pct, query
from hangtally.operators import aggregates as A
from hangtally.operators import aging as AG
from hangtally.operators import numbering as N
from hangtally.operators import outstanding as O
from hangtally.operators import quality as Q
from hangtally.operators import sales as S
from hangtally.operators import stock as ST

FIRST = "line_no, gross, qty, article_status"


@query("sum_first_mixed", f"""
    SELECT doc_id, store_id, sku, sales_date, SUM(qty) AS qty, CAST(SUM(CAST(gross AS DECIMAL(18, 2))) AS DOUBLE) AS gross,
           FIRST(article_status ORDER BY {FIRST}) FILTER (WHERE article_status IS NOT NULL) AS article_status,
           FIRST(line_no ORDER BY {FIRST}) AS line_no
    FROM sales_line GROUP BY doc_id, store_id, sku, sales_date""", dates=["sales_date"])
def _(s):
    order = [F.col(c).alias(f"k{i}") for i, c in enumerate(["line_no", "gross", "qty", "article_status"])]
    lines = s.sales_line.withColumn("gross_exact", X.money("gross"))
    return (A.sum_first(lines, ["doc_id", "store_id", "sku", "sales_date"], ["qty", "gross_exact"], ["article_status"], order,
                        carried=["line_no"])
            .withColumnRenamed("gross_exact", "gross"))


CUTS = """
    cuts AS (SELECT doc_id, FLOOR(doc_total / 100) AS cut FROM sales_header WHERE doc_no LIKE 'PJ%' AND event_text <> '2-HIGH'),
    units AS (SELECT doc_id, SUM(qty) AS doc_qty FROM sales_line GROUP BY doc_id)"""


def cuts(s, prefix="PJ"):
    h = s.sales_header.where(F.col("doc_no").startswith(prefix) & (F.col("event_text") != "2-HIGH"))
    return h.select("doc_id", F.floor(F.col("doc_total") / 100).cast("double").alias("cut"))


def charges(s):
    h = s.sales_header.where("event_text in ('2-HIGH', '3-MEDIUM')")
    return h.select("doc_id", (F.col("group_id") * 10.0).alias("service_fee"), (F.col("group_id") * 3.0).alias("premium"),
                    (F.col("group_id") * 2.0).alias("affiliate"), (F.col("group_id") * 7.0).alias("voucher"))


@query("discount_allocation", f"""
    WITH {CUTS},
    both_ AS (SELECT doc_id, cut, NULL AS fee, NULL AS premium, NULL AS affiliate, NULL AS voucher FROM cuts UNION ALL
              SELECT doc_id, NULL, group_id * 10e0, group_id * 3e0, group_id * 2e0, group_id * 7e0 FROM sales_header
              WHERE event_text IN ('2-HIGH', '3-MEDIUM')),
    t AS (SELECT doc_id, COALESCE(SUM(cut), 0) AS cut, COALESCE(SUM(fee), 0) AS fee, COALESCE(SUM(premium), 0) AS premium,
                 COALESCE(SUM(affiliate), 0) AS affiliate, COALESCE(SUM(voucher), 0) AS voucher FROM both_ GROUP BY doc_id),
    u AS (SELECT t.*, COALESCE(doc_qty, 0) AS doc_qty FROM t LEFT JOIN units USING (doc_id))
    SELECT doc_id, doc_qty, {half_even('COALESCE(cut / NULLIF(doc_qty, 0), 0)', 2)} AS unit_cut,
           {half_even('COALESCE(fee / NULLIF(doc_qty, 0), 0)', 2)} AS unit_service_fee,
           {half_even('COALESCE(premium / NULLIF(doc_qty, 0), 0)', 2)} AS unit_premium,
           {half_even('COALESCE(affiliate / NULLIF(doc_qty, 0), 0)', 2)} AS unit_affiliate,
           COALESCE(voucher / NULLIF(doc_qty, 0), 0) AS unit_voucher
    FROM u""")
def _(s):
    return S.discount_allocation(cuts(s), charges(s), s.sales_line).select(
        "doc_id", "doc_qty", "unit_cut", "unit_service_fee", "unit_premium", "unit_affiliate", "unit_voucher")


@query("bazaar_discount", """
    SELECT doc_id, FLOOR(doc_total / 100) AS cut, doc_qty, CEIL(COALESCE(FLOOR(doc_total / 100) / NULLIF(doc_qty, 0), 0)) AS unit_disc
    FROM sales_header LEFT JOIN (SELECT doc_id, SUM(qty) AS doc_qty FROM sales_line GROUP BY doc_id) AS u USING (doc_id)
    WHERE doc_no LIKE 'BZ%' AND FLOOR(doc_total / 100) <> 0""")
def _(s):
    return S.unit_cut_up(cuts(s, "BZ"), s.sales_line, "cut", "unit_disc")


INVOICE = """
    lines_ AS (SELECT doc_id, SUM(FLOOR(gross * disc_rate)) AS lines_disc FROM sales_line GROUP BY doc_id),
    inv AS (SELECT doc_id, FLOOR(doc_total * 0.02e0) AS total_disc, doc_id % 50 AS total_qty FROM sales_header),
    disc AS (SELECT doc_id, CEIL(COALESCE(total_disc / NULLIF(total_qty, 0), 0)) AS unit_disc FROM inv JOIN lines_ USING (doc_id)
             WHERE total_disc <> lines_disc AND NOT (lines_disc - total_disc > 1))"""


def invoice_discounts(s):
    headers = s.sales_header.select("doc_id", F.floor(F.col("doc_total") * 0.02).cast("double").alias("total_disc"),
                                    (F.col("doc_id") % 50).alias("total_qty"))
    lines = s.sales_line.select("doc_id", F.floor(F.col("gross") * F.col("disc_rate")).cast("double").alias("line_disc"))
    return S.invoice_discount(headers, lines)


@query("invoice_discount", f"WITH {INVOICE} SELECT * FROM disc")
def _(s):
    return invoice_discounts(s)


@query("invoice_sales", f"""
    WITH {INVOICE}
    SELECT doc_id, line_no, sku, qty, gross, dpp, unit_disc, dpp - unit_disc AS final_dpp, (dpp - unit_disc) * qty AS total_amount FROM (
      SELECT doc_id, line_no, sku, qty, gross, gross / 1.11e0 / qty AS dpp, COALESCE(unit_disc, 0) AS unit_disc
      FROM sales_line LEFT JOIN disc USING (doc_id)) AS x""")
def _(s):
    lines = s.sales_line.select("doc_id", "line_no", "sku", "qty", "gross", (F.col("gross") / K.TAX_DIVISOR / F.col("qty")).alias("dpp"))
    return S.invoice_sales(lines, invoice_discounts(s))


MONTHS = ", ".join(f"COALESCE(SUM(CASE WHEN MONTH(sales_date) = {m} THEN qty END), 0) AS qty_{m:02d}" for m in range(1, 13))


@query("monthly_sales_matrix", f"""
    SELECT store_id, sku, {MONTHS.replace('MONTH(sales_date)', 'MONTH(h.sales_date)')} FROM sales_line l JOIN sales_header h USING (doc_id)
    WHERE YEAR(h.sales_date) = 1997 AND doc_no LIKE 'PJ%' AND status <> 'F' AND line_status <> 'F' GROUP BY store_id, sku""")
def _(s):
    headers = s.between("1997-01-01", "1997-12-31").sales_header
    return S.monthly_sales_wide(S.documented_lines(headers, s.sales_line), 1997)


@query("aging_min_max", """
    SELECT store_id, article, CAST(MIN(d) AS INTEGER) AS days_min, CAST(MAX(d) AS INTEGER) AS days_max,
           CAST(MIN(m) AS INTEGER) AS months_min, CAST(MAX(m) AS INTEGER) AS months_max
    FROM (SELECT store_id, article, DATE_DIFF('day', move_date, DATE '2001-12-15') AS d, DATE_DIFF('month', move_date, DATE '2001-12-15') AS m
          FROM movement JOIN article USING (sku) WHERE stat = 'receive') AS x GROUP BY store_id, article""")
def _(s):
    return AG.aging_min_max(s.receipts.join(s.article, "sku"), ["store_id", "article"], "2001-12-15")


@query("returns_by_year", """
    SELECT store_id, sku, -SUM(qty) AS qty FROM movement WHERE stat = 'retur' AND YEAR(move_date) = 1998 GROUP BY store_id, sku""")
def _(s):
    rows = s.between("1998-01-01", "1998-12-31").kind("R", "O").where(X.in_year("move_date", 1998))
    return rows.groupBy("store_id", "sku").agg((-F.sum("qty")).alias("qty"))


@query("transfers_sum", """
    SELECT store_id, article, SUM(qty) AS transfer_qty FROM movement JOIN article USING (sku)
    WHERE stat = 'mutasi' AND move_date <= DATE '2000-06-30' GROUP BY store_id, article""")
def _(s):
    rows = s.between(None, "2000-06-30").kind("R", "F")
    return rows.join(s.article, "sku").groupBy("store_id", "article").agg(F.sum("qty").alias("transfer_qty"))


@query("order_delivery_sum", """
    SELECT store_id, article, MAX(delivery_date) AS order_date, SUM(qty) AS ordered_qty,
           MAX(CASE WHEN status <> 'F' THEN input_date END) AS delivery_date,
           SUM(CASE WHEN status <> 'F' THEN qty ELSE 0 END) AS delivered_qty
    FROM delivery JOIN delivery_line USING (doc_id) JOIN article USING (sku) GROUP BY store_id, article""",
       dates=["order_date", "delivery_date"])
def _(s):
    sent = F.col("status") != K.VOID
    rows = (s.delivery_line.join(s.delivery, "doc_id").join(s.article, "sku")
            .select("store_id", "article", F.col("delivery_date").alias("order_date"), F.col("qty").alias("ordered_qty"),
                    F.when(sent, F.col("input_date")).alias("delivery_date"), F.when(sent, F.col("qty")).otherwise(0.0).alias("delivered_qty")))
    return O.order_delivery_sum(rows, ["store_id", "article"])


@query("sales_window_sum", """
    SELECT store_id, article, SUM(qty) AS sales FROM sales_line JOIN article USING (sku)
    WHERE sales_date BETWEEN DATE '2000-04-01' AND DATE '2000-06-30' GROUP BY store_id, article""")
def _(s):
    rows = s.between("2000-04-01", "2000-06-30").sales_line
    return rows.join(s.article, "sku").groupBy("store_id", "article").agg(F.sum("qty").alias("sales"))


@query("pending_returns", """
    WITH stock AS (SELECT store_id, sku, SUM(qty) AS stocks FROM movement GROUP BY ALL),
    pend AS (SELECT l_suppkey AS store_id, l_partkey AS sku, SUM(CASE WHEN l_linenumber % 3 = 1 THEN l_quantity - 1 ELSE l_quantity END) AS q
             FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber % 3 <> 0 GROUP BY ALL)
    SELECT store_id, sku, stocks - COALESCE(q, 0) AS stocks FROM stock LEFT JOIN pend USING (store_id, sku)""")
def _(s):
    n = F.col("l_linenumber") % 3
    pre = s.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("sku"),
        F.when(n == 0, "F").when(n == 1, "X").otherwise("T").alias("status"),
        (F.col("l_quantity") - 1).alias("verified_qty"), F.col("l_quantity").alias("sent_qty"))
    stock = s.movement.groupBy("store_id", "sku").agg(F.sum("qty").alias("stocks"))
    return O.subtract_pending(stock, O.pending_returns(pre, ["store_id", "sku"]), ["store_id", "sku"])


@query("numeric_column_totals", """
    SELECT column_name, total FROM (
      SELECT CAST(SUM(line_no) AS DOUBLE) AS line_no, SUM(qty) AS qty, CAST(SUM(CAST(gross AS DECIMAL(18, 2))) AS DOUBLE) AS gross,
             CAST(SUM(sku) AS DOUBLE) AS sku FROM sales_line) AS x
    UNPIVOT (total FOR column_name IN (line_no, qty, gross, sku))""")
def _(s):
    return A.numeric_totals(s.sales_line.select("line_no", "qty", "gross", "sku", "line_status"), exact=["gross"])


@query("draft_stock", """
    SELECT store_id, sku, size, SUM(-qty) AS stocks FROM movement LEFT JOIN article USING (sku) WHERE stat = 'mutasi'
    GROUP BY store_id, sku, size""")
def _(s):
    drafts = s.kind("R", "F").groupBy("store_id", "sku").agg(F.sum(-F.col("qty")).alias("stocks"))
    return drafts.join(s.article.select("sku", "size"), "sku", "left").select("store_id", "sku", "size", "stocks")


# ---- windows and numbering -------------------------------------------------

@query("top_receipt_then_latest", """
    WITH r AS (SELECT doc_id % 1000 AS order_no, article, move_date AS arrival_date, qty, doc_id FROM movement JOIN article USING (sku) WHERE stat = 'receive'),
    m AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_no, article ORDER BY qty DESC, arrival_date DESC, doc_id DESC) AS rn FROM r) AS x WHERE rn = 1),
    l AS (SELECT * FROM (SELECT * EXCLUDE (rn), ROW_NUMBER() OVER (PARTITION BY article ORDER BY arrival_date DESC, qty DESC, order_no DESC) AS rn2 FROM m) AS x WHERE rn2 = 1)
    SELECT a.article, order_no, COALESCE(arrival_date, DATE '2023-01-01') AS arrival_date, COALESCE(qty, 0) AS qty, doc_id,
           CAST(DATE_DIFF('day', COALESCE(arrival_date, DATE '2023-01-01'), DATE '2001-12-15') AS INTEGER) AS days,
           CAST(DATE_DIFF('month', COALESCE(arrival_date, DATE '2023-01-01'), DATE '2001-12-15') AS INTEGER) AS months
    FROM l RIGHT JOIN (SELECT DISTINCT article FROM article) AS a ON l.article = a.article""", dates=["arrival_date"])
def _(s):
    rows = s.receipts.join(s.article, "sku").select((F.col("doc_id") % 1000).alias("order_no"), "article",
                                                    F.col("move_date").alias("arrival_date"), "qty", "doc_id")
    return AG.latest_main_receipt(rows, s.article, "2001-12-15")


@query("running_suffix", """
    SELECT c_custkey AS cust_id, c_mktsegment || CASE WHEN rn = 1 THEN '' ELSE CAST(rn AS VARCHAR) END AS customer_code FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS rn FROM customer) AS x""")
def _(s):
    rows = s.raw("customer").select(F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("segment"))
    return N.running_suffix(rows, "segment", "cust_id", "customer_code").select("cust_id", "customer_code")


@query("sequence_fill", """
    WITH s AS (SELECT c_custkey AS cust_id, store_id FROM customer LEFT JOIN store ON cust_id = c_custkey)
    SELECT cust_id, store_id FROM s WHERE store_id IS NOT NULL
    UNION ALL SELECT cust_id, COALESCE((SELECT MAX(store_id) FROM s WHERE store_id >= 9000), 8999) + ROW_NUMBER() OVER (ORDER BY cust_id)
    FROM s WHERE store_id IS NULL""")
def _(s):
    rows = s.raw("customer").select(F.col("c_custkey").alias("cust_id")).join(s.store.select("cust_id", "store_id"), "cust_id", "left")
    return N.sequence_fill(rows, "store_id", "cust_id", K.FIRST_SPARE_STORE_ID)


@query("next_month_stock", """
    WITH m AS (SELECT store_id, sku, CAST(DATE_TRUNC('month', move_date) AS DATE) AS month, SUM(qty) AS stock,
                      SUM(CASE WHEN stat = 'penjualan' THEN -qty ELSE 0 END) AS sales FROM movement GROUP BY ALL)
    SELECT a.store_id, a.sku, a.month, a.stock, a.sales, COALESCE(b.stock, 0) + a.sales AS total_stock
    FROM m a LEFT JOIN m b ON a.store_id = b.store_id AND a.sku = b.sku AND b.month = a.month + INTERVAL 1 MONTH""", dates=["month"])
def _(s):
    monthly = s.movement.groupBy("store_id", "sku", X.month_start("move_date").alias("month")).agg(
        F.sum("qty").alias("stock"), F.sum(F.when(F.col("stat") == K.SALE, -F.col("qty")).otherwise(0.0)).alias("sales"))
    return ST.next_month_stock(monthly)


@query("share_of_total", f"""
    WITH c AS (SELECT category, SUM(qty) AS sales FROM sales_line JOIN article USING (sku) GROUP BY category)
    SELECT category, sales, {pct('sales', '(SELECT SUM(sales) FROM c)')} AS share FROM c""")
def _(s):
    total = s.sales_line.agg(F.sum("qty")).scalar()
    sums = (s.sales_line.groupBy("sku").agg(F.sum("qty").alias("q")).join(s.article, "sku")
            .groupBy("category").agg(F.sum("q").alias("sales")))
    return A.share_of_total(sums, "sales", "share", total)


def changed_lines(s):
    """The same sales lines as another system reports them: some quantities differ."""
    return s.sales_line.withColumn("qty", F.when(F.col("gross") > 90000, F.col("qty") + 1).otherwise(F.col("qty")))


@query("row_number_pairing", """
    WITH a AS (SELECT doc_id, sku, qty, gross, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY sku, gross, qty) AS position FROM sales_line),
    b AS (SELECT doc_id, sku, qty, gross, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY sku, gross, qty) AS position FROM (
          SELECT doc_id, sku, gross, CASE WHEN gross > 90000 THEN qty + 1 ELSE qty END AS qty FROM sales_line) AS x)
    SELECT a.doc_id, a.position, a.sku, a.qty AS qty_left, b.qty AS qty_right FROM a JOIN b USING (doc_id, position)
    WHERE a.qty <> b.qty OR a.sku <> b.sku""")
def _(s):
    cols = ["doc_id", "sku", "qty", "gross"]
    a, b = N.pair_by_position(s.sales_line.select(*cols), changed_lines(s).select(*cols), ["doc_id"], "sku", ["gross", "qty"])
    both = a.alias("l").join(b.alias("r"), ["doc_id", "position"])
    return (both.where("l.qty <> r.qty or l.sku <> r.sku")
            .select("doc_id", "position", F.col("l.sku").alias("sku"), F.col("l.qty").alias("qty_left"), F.col("r.qty").alias("qty_right")))


# ---- comparison ------------------------------------------------------------

PAIR = """
    a AS (SELECT doc_id, status, doc_total, sales_date FROM sales_header WHERE group_id <> 7),
    b AS (SELECT doc_id, CASE WHEN event_text = '5-LOW' THEN 'Z' ELSE status END AS status,
                 CASE WHEN group_id = 3 THEN doc_total + 0.05e0 WHEN group_id = 4 THEN doc_total + 5 ELSE doc_total END AS doc_total, sales_date
          FROM sales_header WHERE group_id <> 8)"""


def header_pair(s):
    h = s.sales_header
    a = h.where("group_id <> 7").select("doc_id", "status", "doc_total", "sales_date")
    b = h.where("group_id <> 8").select(
        "doc_id", F.when(F.col("event_text") == "5-LOW", "Z").otherwise(F.col("status")).alias("status"),
        F.when(F.col("group_id") == 3, F.col("doc_total") + 0.05).when(F.col("group_id") == 4, F.col("doc_total") + 5)
         .otherwise(F.col("doc_total")).alias("doc_total"), "sales_date")
    return a, b


CELLS = f"""
    {PAIR},
    j AS (SELECT COALESCE(a.doc_id, b.doc_id) AS doc_id, a.status AS s1, b.status AS s2, a.doc_total AS t1, b.doc_total AS t2,
                 CAST(a.sales_date AS VARCHAR) AS d1, CAST(b.sales_date AS VARCHAR) AS d2 FROM a FULL JOIN b ON a.doc_id = b.doc_id),
    cell AS (SELECT doc_id, 'status' AS column_name, s1 AS v1, s2 AS v2, NULL::DOUBLE AS n1, NULL::DOUBLE AS n2 FROM j WHERE s1 IS DISTINCT FROM s2
       UNION ALL SELECT doc_id, 'doc_total', NULL, NULL, t1, t2 FROM j WHERE t1 IS DISTINCT FROM t2
       UNION ALL SELECT doc_id, 'sales_date', d1, d2, NULL, NULL FROM j WHERE d1 IS DISTINCT FROM d2)"""


@query("cell_diff", f"""
    WITH {CELLS} SELECT doc_id, column_name, v1 AS left_text, v2 AS right_text, n1 AS left_number, n2 AS right_number FROM cell""")
def _(s):
    d = Q.cell_diff(*header_pair(s), ["doc_id"], ["status", "doc_total", "sales_date"])
    number = F.col("column_name") == "doc_total"
    return d.select("doc_id", "column_name", F.when(~number, F.col("left_value")).alias("left_text"),
                    F.when(~number, F.col("right_value")).alias("right_text"),
                    F.when(number, F.col("left_value").cast("double")).alias("left_number"),
                    F.when(number, F.col("right_value").cast("double")).alias("right_number"))


@query("diff_tolerance", f"""
    WITH {CELLS} SELECT doc_id, column_name, ABS(n1 - n2) AS difference, CASE WHEN ABS(n1 - n2) >= 0.1 THEN 'Not OK' ELSE 'OK' END AS status
    FROM cell""")
def _(s):
    d = Q.cell_diff(*header_pair(s), ["doc_id"], ["status", "doc_total", "sales_date"])
    gap, status = Q.tolerance_status("left_value", "right_value")
    return d.select("doc_id", "column_name", gap.alias("difference"), status.alias("status"))


@query("diff_by_column", f"WITH {CELLS} SELECT column_name, COUNT(*) AS n FROM cell GROUP BY column_name")
def _(s):
    return A.value_frequency(Q.cell_diff(*header_pair(s), ["doc_id"], ["status", "doc_total", "sales_date"]), "column_name")


@query("keyed_compare", f"""
    WITH {PAIR} SELECT doc_id, a.status AS status_left, a.doc_total AS doc_total_left, b.status AS status_right, b.doc_total AS doc_total_right
    FROM a JOIN b USING (doc_id) WHERE a.status <> b.status OR a.doc_total <> b.doc_total""")
def _(s):
    return Q.keyed_compare(*header_pair(s), ["doc_id"], ["status", "doc_total"])


@query("whitespace_keys", """
    SELECT code, COUNT(*) AS n, CASE WHEN code LIKE '% %' THEN 'white space' ELSE 'duplicate' END AS problem FROM (
      SELECT CASE WHEN p_size > 25 THEN p_name ELSE REPLACE(p_name, ' ', '') || (p_partkey // 2) END AS code FROM part) AS x
    GROUP BY code HAVING code LIKE '% %' OR COUNT(*) > 1""")
def _(s):
    code = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(
        F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.floor(F.col("p_partkey") / 2).cast("string")))
    return Q.bad_codes(s.raw("part").select(code.alias("code")), "code")


@query("fill_from_siblings", """
    WITH p AS (SELECT p_partkey AS sku, p_name AS name, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS fitting,
                      CASE WHEN p_size % 4 <> 0 THEN p_type END AS status FROM part),
    k AS (SELECT name, MAX((fitting, status)) AS b FROM p WHERE fitting IS NOT NULL AND status IS NOT NULL GROUP BY name)
    SELECT sku, p.name, COALESCE(fitting, b[1]) AS fitting, COALESCE(status, b[2]) AS status FROM p LEFT JOIN k ON p.name = k.name""")
def _(s):
    size = F.col("p_size")
    rows = s.raw("part").select(F.col("p_partkey").alias("sku"), F.col("p_name").alias("name"),
                                F.when(size % 3 != 0, F.col("p_brand")).alias("fitting"), F.when(size % 4 != 0, F.col("p_type")).alias("status"))
    return Q.fill_from_siblings(rows, "name", ["fitting", "status"])
