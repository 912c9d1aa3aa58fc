"""End-to-end jobs and dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally import functions as X
from hangtally.catalog.aggregation import CUTS, cuts, charges
from hangtally.catalog.joining import ASOF_SQL, BAND_SQL, MODAL_SQL
from hangtally.catalog.registry import half_even, pct, query
from hangtally.catalog.scalar import PRICE_CATEGORY, PRICE_EVENT
from hangtally.catalog.sizes import cells, plus, status_sql
from hangtally.catalog.stocktaking import ASOF, ON_HAND, on_hand
from hangtally.operators import sales as S
from hangtally.operators.aging import receipt_aging
from hangtally.plans import dashboard as D
from hangtally.plans import masters as MA
from hangtally.plans import sales_mart as SM
from hangtally.sources.readers import within_months

# ---- sales marts -----------------------------------------------------------


def alloc_sql() -> str:
    unit = lambda c: half_even(f"COALESCE({c} / NULLIF(doc_qty, 0), 0)", 2)
    return f"""{CUTS},
    both_ AS (SELECT doc_id, cut FROM cuts UNION ALL SELECT doc_id, NULL FROM sales_header WHERE event_text IN ('2-HIGH', '3-MEDIUM')),
    alloc AS (SELECT doc_id, {unit('cut')} AS unit_cut FROM (
        SELECT t.*, COALESCE(doc_qty, 0) AS doc_qty FROM (SELECT doc_id, COALESCE(SUM(cut), 0) AS cut FROM both_ GROUP BY doc_id) AS t
        LEFT JOIN units USING (doc_id)) AS u)"""


def mart_sql(where: str) -> str:
    first = "line_no, gross, qty, disc_id, article_status, mark_id"
    return f"""{alloc_sql()}, {MODAL_SQL},
    valid AS (SELECT l.doc_id, l.store_id, l.sku, h.sales_date, h.cust_id, h.category_id, l.line_no, l.gross, l.qty, l.disc_id, l.mark_id,
                     COALESCE(l.article_status, mark_name) AS article_status, mark_name AS event, COALESCE(unit_cut, 0) * l.qty AS disc2
              FROM sales_line l JOIN sales_header h USING (doc_id)
              LEFT JOIN (SELECT disc_id, mark_name FROM discount JOIN mark USING (mark_id)) AS e ON e.disc_id = l.disc_id
              LEFT JOIN alloc ON alloc.doc_id = l.doc_id
              WHERE doc_no LIKE 'PJ%' AND line_status <> 'F' AND status <> 'F' AND {where}),
    grouped AS (SELECT doc_id, store_id, sku, sales_date, SUM(qty) AS qty, CAST(SUM(CAST(gross AS DECIMAL(18, 2))) AS DOUBLE) AS gross,
                       CAST(SUM(CAST(disc2 AS DECIMAL(18, 2))) AS DOUBLE) AS total_disc2, FIRST(line_no ORDER BY {first}) AS line_no,
                       FIRST(cust_id ORDER BY {first}) AS cust_id, FIRST(mark_id ORDER BY {first}) AS mark_id,
                       FIRST(category_id ORDER BY {first}) AS category_id,
                       FIRST(article_status ORDER BY {first}) FILTER (WHERE article_status IS NOT NULL) AS article_status,
                       FIRST(event ORDER BY {first}) FILTER (WHERE event IS NOT NULL) AS event
                FROM valid GROUP BY doc_id, store_id, sku, sales_date),
    found AS (SELECT *, COALESCE({BAND_SQL}, {ASOF_SQL}, 0) AS m FROM grouped h),
    marged AS (SELECT found.*, COALESCE(CAST(CASE WHEN m = 0 THEN modal_margin ELSE m END AS DOUBLE), 0) AS margin,
                      CASE WHEN m = 0 THEN 'X' ELSE 'O' END AS margin_status FROM found LEFT JOIN modal USING (cust_id)),
    netted AS (SELECT *, (gross - total_disc2) * (1 - margin / 100) AS net_amount FROM marged),
    mart AS (SELECT *, CASE WHEN margin_status = 'X' THEN gross ELSE net_amount END AS sim_amount FROM netted)"""


MART_COLUMNS = ["doc_id", "store_id", "sku", "sales_date", "pk_id", "qty", "gross", "total_disc2", "line_no", "article_status", "event",
                "margin", "margin_status", "net_amount", "sim_amount", "dpp", "dpp2"]
MART_SELECT = """SELECT doc_id, store_id, sku, sales_date,
    CAST(store_id AS VARCHAR) || '/' || STRFTIME(sales_date, '%y%m%d') || '/' || CAST(sku AS VARCHAR) AS pk_id, qty, gross, total_disc2, line_no,
    article_status, COALESCE(event, article_status) AS event, margin, margin_status, net_amount, sim_amount,
    net_amount / 1.11e0 AS dpp, sim_amount / 1.11e0 AS dpp2 FROM mart"""


def mart(s, span, period):
    """``span`` reads the documents of the period; discounts are summed for those documents alone."""
    lines = s.sales_line.drop("sales_date")
    headers = span.sales_header
    documents = headers.where(period).select("doc_id")
    wanted = lambda df: df.join(documents, "doc_id", "left_semi")
    allocation = S.discount_allocation(wanted(cuts(span)), wanted(charges(span)), s.sales_line)
    return SM.sales_mart(headers.drop("mark_id"), lines, s.discount, s.mark, allocation, s.rate_asof, s.rate_band, period)


def mart_of_year(s, year):
    since, until = f"{year}-01-01", f"{year}-12-31"
    return mart(s, s.between(since, until), X.in_year("sales_date", year))


@query("sales_mart", f"WITH {mart_sql('YEAR(h.sales_date) = 1998')} {MART_SELECT}", dates=["sales_date"])
def _(s):
    return mart_of_year(s, 1998).select(*MART_COLUMNS)


@query("sales_today", f"""WITH {mart_sql("h.input_date = DATE '1998-03-10'")} {MART_SELECT}""", dates=["sales_date"])
def _(s):
    # by the day of entry alone: a document may be entered long after its date
    return mart(s, s, F.col("input_date") == X.day("1998-03-10")).select(*MART_COLUMNS)


@query("bazaar_sales", """
    WITH disc AS (SELECT doc_id, CEIL(COALESCE(FLOOR(doc_total / 100) / NULLIF(doc_qty, 0), 0)) AS unit_disc
      FROM sales_header LEFT JOIN (SELECT doc_id, SUM(qty) AS doc_qty FROM sales_line GROUP BY doc_id) AS u USING (doc_id)
      WHERE doc_no LIKE 'BZ%' AND event_text <> '2-HIGH' AND FLOOR(doc_total / 100) <> 0)
    SELECT l.doc_id, line_no, store_id, UPPER(sku_code) AS sku_code, qty, gross, h.sales_date, CAST(MONTH(h.sales_date) AS INTEGER) AS month_no,
           MONTHNAME(h.sales_date) AS month_name, CAST(YEAR(h.sales_date) AS INTEGER) AS year,
           COALESCE(article_status, mark_name) AS article_status, mark_name AS event, COALESCE(unit_disc, 0) AS unit_disc
    FROM sales_line l JOIN sales_header h USING (doc_id)
    LEFT JOIN (SELECT disc_id, mark_name FROM discount JOIN mark USING (mark_id)) AS e USING (disc_id) LEFT JOIN disc USING (doc_id)
    WHERE doc_no LIKE 'BZ%' AND line_status <> 'F' AND status <> 'F'""", dates=["sales_date"])
def _(s):
    lines = S.sales_lines(s.sales_header.drop("mark_id"), s.sales_line.drop("sales_date"), s.discount, s.mark, prefix="BZ")
    disc = S.unit_cut_up(cuts(s, "BZ"), s.sales_line, "cut", "unit_disc").select("doc_id", "unit_disc")
    rows = S.clean_sales(lines.join(disc, "doc_id", "left").fillna(0.0, ["unit_disc"]))
    return rows.select("doc_id", "line_no", "store_id", "sku_code", "qty", "gross", "sales_date", "month_no", "month_name", "year",
                       "article_status", "event", "unit_disc")


@query("consignment_export", f"""
    WITH {mart_sql('YEAR(h.sales_date) = 1999')}
    SELECT sales_date AS "Sales Date", store_code AS "Code Store", store_name AS "Store", article AS "Code Articel", category AS "Kategori",
           brand AS "Brand", size AS "Size", COALESCE(event, article_status) AS "Status Article", price AS "HET", gross AS "Total Nett Kassa",
           net_amount AS "Nett Amount", qty AS "Qty"
    FROM mart LEFT JOIN article USING (sku) LEFT JOIN store USING (store_id)""", dates=["Sales Date"])
def _(s):
    return SM.consignment_export(mart_of_year(s, 1999), s.article.drop("category_id"), s.store)


# ---- masters ---------------------------------------------------------------

FRESH = f"""SELECT CASE WHEN p_size % 9 = 0 THEN NULL ELSE 'A' || (p_partkey // 2) || '-' || p_type END AS artsize, p_partkey AS article_id,
    p_name AS barcode, CAST(p_retailprice AS VARCHAR) AS price, CASE WHEN p_size % 8 = 0 THEN 'bad' ELSE CAST(p_size * 10000 AS VARCHAR) END AS amount,
    {PRICE_CATEGORY} AS category, CASE WHEN p_size % 4 <> 0 THEN p_brand END AS rating FROM part"""
STORED_COLUMNS = ["artsize", "article_id", "barcode", "price", "amount", "category", "rating", "photo", "status", "price_class"]
FLOOR = "CASE category " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in K.CATEGORY_PRICE_FLOOR.items()) + " END"


def fresh_articles(s):
    size, key = F.col("p_size"), F.col("p_partkey")
    code = F.concat(F.lit("A "), F.floor(key / 2).cast("string"), F.lit(" -"), F.col("p_type"))
    return s.raw("part").select(
        F.when(size % 9 != 0, code).alias("artsize"), key.alias("article_id"), F.col("p_name").alias("barcode"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.when(size % 8 == 0, "bad").otherwise((size * 10000).cast("string")).alias("amount"),
        F.expr(PRICE_CATEGORY).alias("category"), F.when(size % 4 != 0, F.col("p_brand")).alias("rating"))


def stored_articles(s):
    """What the mart holds: older prices of every fifth size, no class for some."""
    size, key = F.col("p_size"), F.col("p_partkey")
    return s.raw("part").where("p_type <> 'PROMO'").select(
        F.concat(F.lit("A"), F.floor(key / 2).cast("string"), F.lit("-"), F.col("p_type"), F.when(key % 2 == 1, "-x").otherwise("")).alias("artsize"),
        key.alias("article_id"), F.col("p_name").alias("barcode"), F.col("p_retailprice").alias("price"), F.lit(0.0).alias("amount"),
        F.lit("OLD").alias("category"), F.lit("none").alias("rating"), F.lit("none").alias("photo"), F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("price_class"))


@query("article_upsert", f"""
    WITH f AS ({FRESH}),
    one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY artsize ORDER BY article_id) AS rn FROM f WHERE artsize IS NOT NULL) AS x WHERE rn = 1),
    ev AS (SELECT p_partkey AS article_id, {PRICE_EVENT} AS status FROM part),
    n AS (SELECT artsize, article_id, barcode, CAST(price AS DOUBLE) AS price, COALESCE(TRY_CAST(amount AS DOUBLE), 0) AS amount, category,
                 COALESCE(rating, 'none') AS rating, CASE WHEN barcode LIKE 's%' THEN 'img/' || barcode ELSE 'none' END AS photo, status
          FROM one LEFT JOIN ev USING (article_id)),
    c AS (SELECT *, CASE WHEN status IN ('DISC 50%', 'DISC 70%', 'DISC 50+20%') THEN 'Obral' WHEN status = 'NORMAL' THEN 'Normal'
                 WHEN {FLOOR} IS NULL THEN NULL WHEN amount >= {FLOOR} THEN 'Normal' ELSE 'Obral' END AS price_class FROM n),
    old AS (SELECT 'A' || (p_partkey // 2) || '-' || p_type || CASE WHEN p_partkey % 2 = 1 THEN '-x' ELSE '' END AS artsize, p_partkey AS article_id,
                   p_name AS barcode, p_retailprice AS price, 0e0 AS amount, 'OLD' AS category, 'none' AS rating, 'none' AS photo,
                   NULL::VARCHAR AS status, NULL::VARCHAR AS price_class FROM part WHERE p_type <> 'PROMO')
    SELECT * FROM c UNION ALL SELECT * FROM old WHERE artsize NOT IN (SELECT artsize FROM c)""")
def _(s):
    photos = s.raw("part").where("p_name like 's%'").select(F.col("p_name").alias("barcode")).distinct().withColumn(
        "photo", F.concat(F.lit("img/"), "barcode"))
    statuses = s.raw("part").select(F.col("p_partkey").alias("article_id"), F.expr(PRICE_EVENT).alias("status"))
    return MA.article_upsert(fresh_articles(s), stored_articles(s), photos, statuses)


STORE_COLUMNS = ["store_id", "cust_id", "store_code", "customer_code", "store_type", "new_name", "detail_class", "user_name", "supervisor"]


@query("store_upsert", """
    WITH b AS (SELECT store_id, c_custkey AS cust_id,
        CASE c_custkey % 50 WHEN 1 THEN 'MD185' WHEN 2 THEN 'BZ' || c_custkey ELSE 'C' || c_custkey END AS store_code,
        CASE WHEN c_nationkey = 1 THEN 'Surabaya' ELSE 'Other' END AS city, CAST(c_custkey % 12 AS INTEGER) AS group_id,
        CASE WHEN c_acctbal > 5000 THEN 'T' ELSE 'F' END AS net_flag, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS customer_code
        FROM customer LEFT JOIN store ON cust_id = c_custkey),
    sup AS (SELECT 'C' || c_custkey AS store_code, 'S' || c_nationkey AS supervisor FROM customer WHERE c_mktsegment <> 'BUILDING'),
    u AS (SELECT o_custkey AS cust_id, MIN('U' || o_orderkey) AS user_name FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
    j AS (SELECT b.*, COALESCE(user_name, '-') AS user_name, COALESCE(supervisor, '-') AS supervisor FROM b LEFT JOIN u USING (cust_id) LEFT JOIN sup USING (store_code)),
    r AS (SELECT * REPLACE (CASE WHEN city = 'Surabaya' AND store_code = 'MD185' THEN 'MD185.' ELSE store_code END AS store_code) FROM j),
    n AS (SELECT * REPLACE (COALESCE(store_id, 8999 + ROW_NUMBER() OVER (PARTITION BY store_id IS NULL ORDER BY cust_id)) AS store_id,
                            COALESCE(customer_code, store_code) AS customer_code) FROM r),
    d AS (SELECT store_id, cust_id, store_code,
        customer_code || CASE WHEN ROW_NUMBER() OVER (PARTITION BY customer_code ORDER BY cust_id) = 1 THEN ''
                              ELSE CAST(ROW_NUMBER() OVER (PARTITION BY customer_code ORDER BY cust_id) AS VARCHAR) END AS customer_code,
        CASE WHEN store_id IN (18, 27, 74, 117, 134, 137, 151, 116) THEN '7 Toko Strategis' END AS store_type,
        CASE WHEN group_id = 9 THEN 'Bazar' WHEN store_code LIKE 'BZ%' THEN 'Bazar' END AS new_name,
        CASE WHEN group_id = 2 THEN 'MDS' WHEN group_id = 3 THEN 'RMY' WHEN group_id > 3 AND net_flag = 'F' THEN 'Other'
             WHEN group_id > 3 AND net_flag = 'T' THEN 'Consi' END AS detail_class, user_name, supervisor FROM n),
    old AS (SELECT s_suppkey * 2 AS store_id, s_suppkey AS cust_id, 'OLD' AS store_code, 'OLD' AS customer_code, NULL::VARCHAR AS store_type,
                   NULL::VARCHAR AS new_name, NULL::VARCHAR AS detail_class, '-' AS user_name, '-' AS supervisor FROM supplier)
    SELECT * FROM d UNION ALL SELECT * FROM old WHERE store_id NOT IN (SELECT store_id FROM d)""")
def _(s):
    c, key = s.raw("customer"), F.col("c_custkey")
    text = key.cast("string")
    rows = c.select(
        key.alias("cust_id"),
        F.when(key % 50 == 1, "MD185").when(key % 50 == 2, F.concat(F.lit("BZ"), text)).otherwise(F.concat(F.lit("C"), text)).alias("store_code"),
        F.when(F.col("c_nationkey") == 1, "Surabaya").otherwise("Other").alias("city"), (key % 12).cast("int").alias("group_id"),
        F.when(F.col("c_acctbal") > 5000, "T").otherwise("F").alias("net_flag"),
        F.when(key % 4 != 0, F.col("c_mktsegment")).alias("customer_code"), F.lit(None).cast("string").alias("store_type"),
        F.lit(None).cast("string").alias("new_name")).join(s.store.select("cust_id", "store_id"), "cust_id", "left")
    users = s.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("cust_id"),
                                                         F.concat(F.lit("U"), F.col("o_orderkey").cast("string")).alias("user_name"))
    contacts = c.where("c_mktsegment <> 'BUILDING'").select(F.concat(F.lit("C"), text).alias("store_code"),
                                            F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("supervisor"))
    none = F.lit(None).cast("string")
    stored = s.raw("supplier").select(
        (F.col("s_suppkey") * 2).alias("store_id"), F.col("s_suppkey").alias("cust_id"), F.lit("OLD").alias("store_code"),
        F.lit("OLD").alias("customer_code"), none.alias("store_type"), none.alias("new_name"), none.alias("detail_class"),
        F.lit("-").alias("user_name"), F.lit("-").alias("supervisor"))
    return MA.store_upsert(rows, users, contacts, stored, STORE_COLUMNS)


# ---- dashboards ------------------------------------------------------------

@query("receipt_aging", f"""
    WITH d AS (SELECT store_id, article, move_date, SUM(qty) AS qty FROM movement JOIN article USING (sku)
               WHERE stat = 'receive' AND move_date <= DATE '{ASOF}' GROUP BY ALL)
    SELECT store_id, article, MIN(move_date) AS first_receipt, MAX(move_date) AS last_receipt, MIN_BY(qty, move_date) AS first_qty,
           CAST(DATE_DIFF('day', MAX(move_date), DATE '{ASOF}') AS INTEGER) AS aging FROM d GROUP BY store_id, article""",
       dates=["first_receipt", "last_receipt"])
def _(s):
    receipts = within_months(s.ledger, "move_date", None, ASOF).where(F.col("stat") == K.RECEIVE)
    return receipt_aging(receipts.join(s.article, "sku"), ["store_id", "article"], ASOF)


OPEN = """
    open_do AS (SELECT store_id, sku, qty FROM delivery d JOIN delivery_line l USING (doc_id)
                WHERE d.status = 'F' AND NOT EXISTS (SELECT 1 FROM receiving r WHERE r.doc_id = d.doc_id)),
    open_dm AS (SELECT store_id + 1 AS store_id, sku, qty FROM delivery d JOIN delivery_line l USING (doc_id)
                WHERE d.status = 'F' AND flag = 'R' AND NOT EXISTS (SELECT 1 FROM receiving r WHERE r.doc_id = d.doc_id))"""


def deliveries(s):
    return D.delivery_cells(s.delivery, s.delivery_line, s.receiving)


def movements(s) -> D.Movements:
    upto = within_months(s.ledger, "move_date", None, ASOF)
    return D.Movements(on_hand=on_hand(s), receipts=upto.where(F.col("stat") == K.RECEIVE), sales=s.between("2000-03-19", ASOF).sales_line,
                       moved=upto, deliveries=deliveries(s))


BY_ARTICLE = f"""{ON_HAND}, {OPEN},
    p AS (SELECT store_id, article, MAX(size_class) AS size_class, {cells('stocks')} FROM on_hand JOIN article USING (sku) GROUP BY store_id, article),
    q AS (SELECT *, {plus(K.ALL_SIZES)} AS sum_qty, {status_sql()} AS status FROM p),
    sal AS (SELECT store_id, article, SUM(qty) AS sales FROM sales_line JOIN article USING (sku)
            WHERE sales_date BETWEEN DATE '2000-03-19' AND DATE '{ASOF}' GROUP BY ALL),
    ret AS (SELECT store_id, article, -SUM(qty) AS returned FROM movement JOIN article USING (sku) WHERE stat = 'retur' AND move_date <= DATE '{ASOF}' GROUP BY ALL),
    trf AS (SELECT store_id, article, SUM(qty) AS transferred FROM movement JOIN article USING (sku) WHERE stat = 'mutasi' AND move_date <= DATE '{ASOF}' GROUP BY ALL),
    obd AS (SELECT store_id, article, MAX(delivery_date) AS order_date, SUM(qty) AS ordered_qty, MAX(CASE WHEN status <> 'F' THEN input_date END) AS delivery_date,
                   SUM(CASE WHEN status <> 'F' THEN qty ELSE 0 END) AS delivered_qty
            FROM delivery JOIN delivery_line USING (doc_id) JOIN article USING (sku) GROUP BY ALL),
    odo AS (SELECT store_id, article, SUM(qty) AS open_orders FROM open_do JOIN article USING (sku) GROUP BY ALL),
    odm AS (SELECT store_id, article, SUM(qty) AS open_transfers FROM open_dm JOIN article USING (sku) GROUP BY ALL),
    daily AS (SELECT store_id, article, move_date, SUM(qty) AS qty FROM movement JOIN article USING (sku)
              WHERE stat = 'receive' AND move_date <= DATE '{ASOF}' GROUP BY ALL),
    age AS (SELECT store_id, article, MIN(move_date) AS first_receipt, MAX(move_date) AS last_receipt, MIN_BY(qty, move_date) AS first_qty,
                   CAST(DATE_DIFF('day', MAX(move_date), DATE '{ASOF}') AS INTEGER) AS aging FROM daily GROUP BY ALL),
    info AS (SELECT article, MIN(category) AS category, MIN(brand) AS brand, MIN(price) AS price, MAX(size_class) AS cls FROM article GROUP BY article),
    m AS (SELECT store_id, article, {", ".join(f'COALESCE("{z}", 0) AS "{z}"' for z in K.ALL_SIZES)}, COALESCE(size_class, cls) AS size_class, status,
                 COALESCE(sum_qty, 0) AS sum_qty, COALESCE(sales, 0) AS sales, COALESCE(returned, 0) AS returned, COALESCE(transferred, 0) AS transferred,
                 COALESCE(open_orders, 0) AS open_orders, COALESCE(open_transfers, 0) AS open_transfers, COALESCE(ordered_qty, 0) AS ordered_qty,
                 COALESCE(delivered_qty, 0) AS delivered_qty, order_date, delivery_date, first_receipt, last_receipt, COALESCE(first_qty, 0) AS first_qty,
                 COALESCE(aging, 0) AS aging, COALESCE(sum_qty, 0) + COALESCE(sales, 0) AS stock_start,
                 COALESCE(sum_qty, 0) + COALESCE(open_orders, 0) + COALESCE(open_transfers, 0) AS stock_future, category, brand, price
          FROM q FULL JOIN odo USING (store_id, article) FULL JOIN odm USING (store_id, article)
          LEFT JOIN sal USING (store_id, article) LEFT JOIN ret USING (store_id, article) LEFT JOIN trf USING (store_id, article)
          LEFT JOIN obd USING (store_id, article) LEFT JOIN age USING (store_id, article) LEFT JOIN info USING (article)),
    detail AS (SELECT m.*, {pct('sales', 'stock_start')} AS sell_thru, CASE WHEN brand LIKE '%1%' THEN 'Obral' END AS price_class,
                      store_code, store_code || ' - ' || store_name AS store_label FROM m LEFT JOIN store USING (store_id))"""


def detail(s):
    classes = s.article.where(F.col("brand").contains("1")).select("article").distinct().withColumn("price_class", F.lit(K.CLASS_MARKDOWN))
    return D.stock_detail(movements(s), s.article, s.store, classes, ASOF)


@query("stock_detail", f"WITH {BY_ARTICLE} SELECT * FROM detail", dates=["order_date", "delivery_date", "first_receipt", "last_receipt"])
def _(s):
    return detail(s)


@query("return_candidates", f"""
    WITH {BY_ARTICLE} SELECT {", ".join(f'"{c}"' for c in D.RETURN_COLUMNS)} FROM detail""")
def _(s):
    return D.return_candidates(detail(s))


@query("stock_future", f"""
    WITH {ON_HAND}, {OPEN}
    SELECT store_id, sku, SUM(q) AS stock_future FROM (SELECT store_id, sku, stocks AS q FROM on_hand UNION ALL SELECT * FROM open_do
      UNION ALL SELECT * FROM open_dm) AS x GROUP BY store_id, sku""")
def _(s):
    return D.stock_future(on_hand(s), deliveries(s)).select("store_id", "sku", "stock_future")


@query("stock_mobile", f"""
    WITH {ON_HAND}, {OPEN},
    a AS (SELECT store_id, sku, SUM(qty) AS open_orders FROM open_do GROUP BY ALL),
    b AS (SELECT store_id, sku, SUM(qty) AS open_transfers FROM open_dm GROUP BY ALL)
    SELECT store_id, sku, COALESCE(stocks, 0) AS sum_qty, COALESCE(open_orders, 0) AS open_orders, COALESCE(open_transfers, 0) AS open_transfers,
           COALESCE(stocks, 0) + COALESCE(open_orders, 0) + COALESCE(open_transfers, 0) AS stock_future, article, size, brand, price
    FROM on_hand FULL JOIN a USING (store_id, sku) FULL JOIN b USING (store_id, sku) LEFT JOIN article USING (sku)""")
def _(s):
    return D.stock_mobile(on_hand(s), deliveries(s), s.article)


@query("category_summary", f"""
    WITH {BY_ARTICLE},
    c AS (SELECT category, SUM(stock_start) AS stock_start, SUM(sales) AS sales, CAST(SUM(sum_qty) AS DOUBLE) AS sum_qty,
                 COUNT(*) FILTER (WHERE status = 'BROKEN') AS broken, COUNT(*) FILTER (WHERE status = 'SEHAT') AS complete, COUNT(*) AS cart,
                 CAST(COALESCE(SUM(sum_qty) FILTER (WHERE status = 'BROKEN'), 0) AS DOUBLE) AS broken_pcs,
                 CAST(COALESCE(SUM(sum_qty) FILTER (WHERE status = 'SEHAT'), 0) AS DOUBLE) AS complete_pcs,
                 COUNT(*) FILTER (WHERE aging > 12) AS aging_gt_12 FROM m WHERE status IS NOT NULL GROUP BY category)
    SELECT *, {pct('sales', 'stock_start')} AS sell_thru, {pct('sales', '(SELECT SUM(sales) FROM c)')} AS sales_contrib, sum_qty AS total_pcs FROM c""")
def _(s):
    return D.category_summary(D.article_measures(movements(s), s.article, ASOF), D.article_info(s.article))
