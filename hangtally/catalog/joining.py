"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hangtally import functions as X
from hangtally.catalog.registry import query
from hangtally.operators import joins as J
from hangtally.operators import master as M
from hangtally.operators import outstanding as O
from hangtally.operators import sales as S
from hangtally.operators.filters import stores_only
from hangtally.operators.stock import rows_at_last_date


@query("sales_lines", """
    SELECT l.doc_id, doc_no, cust_id, store_id, line_no, sku, qty, gross, h.sales_date, article_status, mark_name AS event
    FROM sales_line l JOIN sales_header h USING (doc_id)
    LEFT JOIN (SELECT disc_id, mark_name FROM discount JOIN mark USING (mark_id)) AS e USING (disc_id)
    WHERE doc_no LIKE 'PJ%' AND line_status <> 'F' AND status <> 'F'
      AND h.sales_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""", dates=["sales_date"])
def _(s):
    year = s.between("1997-01-01", "1997-12-31")
    return S.sales_lines(year.sales_header, s.sales_line.drop("sales_date"), s.discount, s.mark).select(
        "doc_id", "doc_no", "cust_id", "store_id", "line_no", "sku", "qty", "gross", "sales_date", "article_status", "event")


def article_parts(s):
    part, nation, region = s.raw("part"), s.raw("nation"), s.raw("region")
    k = F.col("p_partkey")
    articles = part.select(
        k.alias("article_id"), F.col("p_name").alias("barcode"), F.col("p_retailprice").alias("price"),
        (k % 27).cast("int").alias("brand_id"), (k % 26).cast("int").alias("color_id"), (k % 5).cast("int").alias("division_id"),
        (k % 6).cast("int").alias("mark_id"), (k % 23).cast("int").alias("fit_id"), (k % 24).cast("int").alias("material_id"),
        (k % 7).cast("int").alias("category_key"), (k % 20).cast("int").alias("motif_id"), (k % 30).cast("int").alias("rating_id"))
    sizes = part.where("p_size < 45").select(k.alias("article_id"), (F.col("p_size") % 30).alias("size_id"),
                                             F.concat(F.lit("A"), k.cast("string"), F.lit("-"), F.col("p_size").cast("string")).alias("artsize"))
    def nation_dim(key, name, hold=True):
        cols = [F.col("n_nationkey").alias(key), F.col("n_name").alias(name)]
        if hold:
            cols.append(F.when(F.col("n_nationkey") % 5 == 0, "T").otherwise("F").alias("hold"))
        return nation.select(*cols)
    def region_dim(key, name):
        return region.select(F.col("r_regionkey").alias(key), F.col("r_name").alias(name),
                             F.when(F.col("r_regionkey") == 4, "T").otherwise("F").alias("hold"))
    dims = {
        "brand_id": nation_dim("brand_id", "brand", hold=False), "color_id": nation_dim("color_id", "color"),
        "division_id": region_dim("division_id", "division"), "mark_id": region_dim("mark_id", "mark"),
        "fit_id": nation_dim("fit_id", "fit"), "material_id": nation_dim("material_id", "material"),
        "size_id": nation_dim("size_id", "size_name"),
        "category_key": region_dim("category_key", "category").withColumn("category_type_id", F.col("category_key") + 1),
    }
    config = nation.select(F.col("n_nationkey").alias("config_id"), F.col("n_name").alias("config_name"))
    return articles, sizes, dims, config


ARTICLE_COLUMNS = ["article_id", "barcode", "artsize", "price", "brand", "color", "division", "mark", "fit", "material",
                   "size_name", "category", "size_class", "motif", "rating"]
ARTICLE_SQL = """
    SELECT p_partkey AS article_id, p_name AS barcode, artsize, p_retailprice AS price, br.n_name AS brand, co.n_name AS color,
      dv.r_name AS division, mk.r_name AS mark, fi.n_name AS fit, ma.n_name AS material, sz.n_name AS size_name,
      ca.r_name AS category, c1.n_name AS size_class, c2.n_name AS motif, c3.n_name AS rating
    FROM part
    LEFT JOIN (SELECT p_partkey AS k, p_size % 30 AS size_id, 'A' || p_partkey || '-' || p_size AS artsize FROM part WHERE p_size < 45) AS s
      ON s.k = p_partkey
    LEFT JOIN nation br ON br.n_nationkey = p_partkey % 27
    LEFT JOIN nation co ON co.n_nationkey = p_partkey % 26 AND co.n_nationkey % 5 <> 0
    LEFT JOIN region dv ON dv.r_regionkey = p_partkey % 5 AND dv.r_regionkey <> 4
    LEFT JOIN region mk ON mk.r_regionkey = p_partkey % 6 AND mk.r_regionkey <> 4
    LEFT JOIN nation fi ON fi.n_nationkey = p_partkey % 23 AND fi.n_nationkey % 5 <> 0
    LEFT JOIN nation ma ON ma.n_nationkey = p_partkey % 24 AND ma.n_nationkey % 5 <> 0
    LEFT JOIN nation sz ON sz.n_nationkey = s.size_id AND sz.n_nationkey % 5 <> 0
    LEFT JOIN region ca ON ca.r_regionkey = p_partkey % 7 AND ca.r_regionkey <> 4
    LEFT JOIN nation c1 ON c1.n_nationkey = ca.r_regionkey + 1
    LEFT JOIN nation c2 ON c2.n_nationkey = p_partkey % 20
    LEFT JOIN nation c3 ON c3.n_nationkey = p_partkey % 30"""


@query("article_master", ARTICLE_SQL)
def _(s):
    return M.article_master(*article_parts(s)).select(*ARTICLE_COLUMNS)


@query("store_master", """
    SELECT store_id, c_custkey AS cust_id, c_name AS customer_name, n_name AS city, r_name AS province, c_mktsegment AS segment
    FROM store RIGHT JOIN customer ON cust_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(s):
    customers = s.raw("customer").select(F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("customer_name"),
                                         F.col("c_nationkey").alias("city_id"), F.col("c_mktsegment").alias("segment"))
    cities = s.raw("nation").select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"),
                                    F.col("n_regionkey").alias("province_id"))
    provinces = s.raw("region").select(F.col("r_regionkey").alias("province_id"), F.col("r_name").alias("province"))
    return M.store_master(s.store.select("store_id", "cust_id"), customers, (cities, "city_id"), (provinces, "province_id")).select(
        "store_id", "cust_id", "customer_name", "city", "province", "segment")


@query("store_users", """
    SELECT c_custkey AS user_id, o_orderkey AS cust_id
    FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_nationkey < 10 AND c_acctbal >= 0 AND o_orderpriority <> '5-LOW'""")
def _(s):
    users = s.raw("customer").select(F.col("c_custkey").alias("user_id"), F.when(F.col("c_nationkey") < 10, 2).otherwise(1).alias("user_level"),
                                     F.when(F.col("c_acctbal") < 0, "T").otherwise("F").alias("hold"))
    access = s.orders.select(F.col("o_custkey").alias("user_id"),
                             F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("cust_id"))
    return M.store_users(users, access)


ASOF_SQL = """(SELECT margin FROM rate_asof r WHERE r.cust_id = h.cust_id AND r.mark_id = h.mark_id
       AND r.effective_date <= h.sales_date ORDER BY effective_date DESC, margin LIMIT 1)"""
BAND_SQL = """(SELECT margin FROM rate_band b WHERE b.cust_id = h.cust_id AND b.mark_id = h.mark_id AND b.category_id = h.category_id
       AND h.sales_date BETWEEN b.begin_date AND b.end_date ORDER BY begin_date DESC, margin LIMIT 1)"""
MODAL_SQL = """
    latest AS (SELECT cust_id, mark_id, margin FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY cust_id, mark_id ORDER BY effective_date DESC, margin) AS rn FROM rate_asof) AS x WHERE rn = 1),
    modal AS (SELECT cust_id, margin AS modal_margin FROM (
        SELECT cust_id, margin, ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY COUNT(*) DESC, margin) AS rn
        FROM latest GROUP BY cust_id, margin) AS x WHERE rn = 1)"""


@query("asof_margin", f"SELECT doc_id, cust_id, mark_id, sales_date, {ASOF_SQL} AS margin FROM sales_header h", dates=["sales_date"])
def _(s):
    facts = s.sales_header.select("doc_id", "cust_id", "mark_id", "sales_date")
    return J.asof_join(facts, s.rate_asof, ["cust_id", "mark_id"], "sales_date", "effective_date", "margin", "margin")


@query("range_margin", f"SELECT doc_id, cust_id, mark_id, category_id, sales_date, {BAND_SQL} AS margin FROM sales_header h",
       dates=["sales_date"])
def _(s):
    facts = s.sales_header.select("doc_id", "cust_id", "mark_id", "category_id", "sales_date")
    return J.interval_join(facts, s.rate_band, ["cust_id", "mark_id", "category_id"], "sales_date", "begin_date", "end_date",
                           "margin", "margin")


@query("margin_resolve", f"""
    WITH {MODAL_SQL},
    marked AS (SELECT l.doc_id, line_no, cust_id, h.sales_date, a.category_id,
                      CAST(COALESCE(CASE WHEN line_no % 3 <> 0 THEN l.mark_id END, a.sku % 2) AS INTEGER) AS mark_id
               FROM sales_line l JOIN sales_header h USING (doc_id) LEFT JOIN article a ON a.sku = l.sku),
    found AS (SELECT doc_id, line_no, cust_id, mark_id, COALESCE({BAND_SQL}, {ASOF_SQL}, 0) AS m FROM marked h)
    SELECT doc_id, line_no, cust_id, mark_id, CASE WHEN m = 0 THEN modal_margin ELSE m END AS margin,
           CASE WHEN m = 0 THEN 'X' ELSE 'O' END AS margin_status
    FROM found LEFT JOIN modal USING (cust_id)""")
def _(s):
    # every third line has no mark of its own
    lines = s.sales_line.select("doc_id", "line_no", "sku", F.when(F.col("line_no") % 3 != 0, F.col("mark_id")).cast("int").alias("mark_id"))
    articles = s.article.select("sku", (F.col("sku") % 2).cast("int").alias("mark_id"), "category_id")
    headers = S.with_usual_margin(s.sales_header.select("doc_id", "cust_id", "sales_date"), s.rate_asof)
    facts = S.marks_from_articles(lines.join(headers, "doc_id"), articles)
    return S.resolve_margin(facts, s.rate_asof, s.rate_band).select("doc_id", "line_no", "cust_id", "mark_id", "margin", "margin_status")


@query("store_modal_margin", f"WITH {MODAL_SQL} SELECT cust_id, modal_margin FROM modal")
def _(s):
    return S.store_modal_margin(s.rate_asof)


@query("outstanding_orders", """
    SELECT o.cust_id, sku, delivery_date, SUM(qty) AS qty
    FROM delivery d JOIN delivery_line l ON l.doc_id = d.doc_id
    JOIN (SELECT o_orderkey AS order_no, o_custkey AS cust_id FROM orders WHERE o_orderkey % 22 <> 0) AS o ON o.order_no = d.doc_id - d.doc_id % 2
    WHERE d.status = 'F' AND NOT EXISTS (SELECT 1 FROM receiving r WHERE r.doc_id = d.doc_id)
    GROUP BY o.cust_id, sku, delivery_date""", dates=["delivery_date"])
def _(s):
    # two deliveries share an order; some orders are missing
    deliveries = s.delivery.withColumn("order_no", F.col("doc_id") - F.col("doc_id") % 2)
    orders = s.orders.where("o_orderkey % 22 <> 0").select(F.col("o_orderkey").alias("order_no"), F.col("o_custkey").alias("cust_id"))
    return O.outstanding(deliveries, s.delivery_line, s.receiving, ["cust_id", "sku", "delivery_date"], "qty", orders)


@query("outstanding_transfers", """
    SELECT to_cust_id, sku, delivery_date, SUM(qty) AS qty FROM delivery d JOIN delivery_line l USING (doc_id)
    WHERE d.status = 'F' AND flag = 'R' AND NOT EXISTS (SELECT 1 FROM receiving r WHERE r.doc_id = d.doc_id)
    GROUP BY to_cust_id, sku, delivery_date""", dates=["delivery_date"])
def _(s):
    return O.outstanding(s.delivery, s.delivery_line.where("flag = 'R'"), s.receiving, ["to_cust_id", "sku", "delivery_date"], "qty")


@query("full_outer_merge", """
    WITH a AS (SELECT store_id, sku, SUM(qty) AS sales FROM sales_line WHERE sales_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY ALL),
    b AS (SELECT store_id, sku, SUM(qty) AS stock FROM movement WHERE move_date < DATE '1997-01-01' GROUP BY ALL)
    SELECT store_id, sku, COALESCE(sales, 0) AS sales, COALESCE(stock, 0) AS stock FROM a FULL JOIN b USING (store_id, sku)""")
def _(s):
    sales = s.between("1997-01-01", "1997-12-31").sales_line.groupBy("store_id", "sku").agg(F.sum("qty").alias("sales"))
    stock = s.between(None, "1996-12-31").movement.groupBy("store_id", "sku").agg(F.sum("qty").alias("stock"))
    return J.full_join(sales, stock, ["store_id", "sku"], zeros=["sales", "stock"])


OLD_PART = "SELECT p_partkey AS sku, CASE WHEN p_size = 3 THEN NULL ELSE p_name END AS name, p_retailprice AS price FROM part WHERE p_size <> 4"
NEW_PART = """SELECT p_partkey AS sku, CASE WHEN p_size IN (3, 5) THEN NULL ELSE p_name END AS name,
    CASE WHEN p_size = 7 THEN p_retailprice + 1 ELSE p_retailprice END AS price FROM part"""


def old_and_new_parts(s):
    p, size = s.raw("part"), F.col("p_size")
    old = p.where(size != 4).select(F.col("p_partkey").alias("sku"), F.when(size != 3, F.col("p_name")).alias("name"),
                                    F.col("p_retailprice").alias("price"))
    new = p.select(F.col("p_partkey").alias("sku"), F.when(~size.isin(3, 5), F.col("p_name")).alias("name"),
                   F.when(size == 7, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("price"))
    return old, new


@query("changed_rows", f"""
    WITH o AS ({OLD_PART}), n AS ({NEW_PART}) SELECT * FROM n EXCEPT ALL SELECT * FROM o""")
def _(s):
    old, new = old_and_new_parts(s)
    return J.null_safe_anti(new, old, ["sku", "name", "price"])


@query("key_translate", "SELECT doc_id, store_id, h.doc_total FROM sales_header h LEFT JOIN store USING (cust_id)")
def _(s):
    facts = s.sales_header.select("doc_id", "cust_id", "doc_total")
    return J.key_translate(facts, s.store, "cust_id", "store_id").select("doc_id", "store_id", "doc_total")


@query("join_unequal_names", """
    SELECT doc_id, h.cust_id, c_name AS contact FROM sales_header h LEFT JOIN customer ON h.cust_id + 3 = c_custkey""")
def _(s):
    contacts = s.raw("customer").select((F.col("c_custkey") - 3).alias("contact_key"), F.col("c_name").alias("contact"))
    return J.renamed_join(s.sales_header.select("doc_id", "cust_id"), contacts, "cust_id", "contact_key")


@query("right_join_keep_dim", """
    SELECT article, COALESCE(qty, 0) AS qty, COALESCE(first_date, DATE '2023-01-01') AS first_date
    FROM (SELECT article, SUM(qty) AS qty, MIN(sales_date) AS first_date FROM sales_line JOIN article USING (sku)
          GROUP BY article) AS x
    RIGHT JOIN (SELECT article FROM article UNION SELECT brand FROM article) AS d USING (article)""", dates=["first_date"])
def _(s):
    sold = (s.sales_line.groupBy("sku").agg(F.sum("qty").alias("qty"), F.min("sales_date").alias("d"))
            .join(s.article, "sku").groupBy("article").agg(F.sum("qty").alias("qty"), F.min("d").alias("first_date")))
    # brands are planned articles without a sale
    planned = s.article.select("article").union(s.article.select("brand")).distinct()
    return (sold.join(planned, "article", "right")
            .fillna({"qty": 0.0}).withColumn("first_date", F.coalesce("first_date", X.day("2023-01-01"))))


@query("transfer_trace", """
    SELECT DISTINCT d.o_orderkey AS transfer_id, CAST(d.o_orderdate AS DATE) AS transfer_date, d.o_custkey AS store_from,
           r.o_orderkey * 3 AS receipt_id, t.l_partkey AS sku, t.l_quantity AS sent_qty, rl.l_quantity AS received_qty
    FROM orders d LEFT JOIN lineitem t ON t.l_orderkey = d.o_orderkey AND t.l_returnflag <> 'N'
    LEFT JOIN orders r ON r.o_orderkey = d.o_orderkey AND r.o_orderpriority <> '1-URGENT'
    LEFT JOIN lineitem rl ON rl.l_orderkey = r.o_orderkey AND rl.l_partkey = t.l_partkey AND rl.l_linestatus = 'O'
    WHERE d.o_orderstatus <> 'F' AND d.o_orderdate >= TIMESTAMP '1998-04-01 00:00:00' AND d.o_orderdate < TIMESTAMP '2000-10-01 00:00:00'""",
       dates=["transfer_date"])
def _(s):
    span = s.between("1998-04-01", "2000-09-30")
    key = F.col("o_orderkey")
    transfers = s.orders.select(key.alias("transfer_id"), F.to_date("o_orderdate").alias("transfer_date"),
                                   F.col("o_custkey").alias("store_from"))
    deliveries = span.orders.where("o_orderstatus <> 'F'").select(key.alias("transfer_id"), (key * 2).alias("delivery_id"))
    receipts = s.orders.where("o_orderpriority <> '1-URGENT'").select((key * 2).alias("delivery_id"), (key * 3).alias("receipt_id"))
    lines = s.lineitem.where("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("transfer_id"), F.col("l_partkey").alias("sku"),
                                                           F.col("l_quantity").alias("sent_qty"))
    got = s.lineitem.where("l_linestatus = 'O'").select((F.col("l_orderkey") * 3).alias("receipt_id"), F.col("l_partkey").alias("sku"),
                                                        F.col("l_quantity").alias("received_qty"))
    return O.transfer_trace(transfers, lines, deliveries, receipts, got).select(
        "transfer_id", "transfer_date", "store_from", "receipt_id", "sku", "sent_qty", "received_qty")


@query("store_filter_semi", """
    SELECT store_id, sku, SUM(qty) AS qty FROM movement WHERE store_id IN (
      SELECT store_id FROM store WHERE store_code IN ('ST1', 'ST3', 'ST7', 'ST9')) GROUP BY ALL""")
def _(s):
    return (stores_only(s.movement, s.store, ["ST1", "ST3", "ST7", "ST9"])
            .groupBy("store_id", "sku").agg(F.sum("qty").alias("qty")))


@query("correlated_max", """
    SELECT store_id, sku, count_date, qty FROM stock_count a
    WHERE count_date = (SELECT MAX(count_date) FROM stock_count b WHERE b.store_id = a.store_id)""", dates=["count_date"])
def _(s):
    return rows_at_last_date(s.stock_count.select("store_id", "sku", "count_date", "qty"), "store_id", "count_date")


@query("suffix_key_join", """
    SELECT doc_no, store_code, sku, qty FROM (
      SELECT 'RC/' || doc_id || '/' || store_id AS doc_no, sku, qty FROM movement WHERE stat = 'receive') AS x
    JOIN store ON store_id = CAST(SPLIT_PART(doc_no, '/', 3) AS BIGINT)""")
def _(s):
    docs = s.receipts.select(F.concat(F.lit("RC/"), F.col("doc_id").cast("string"), F.lit("/"), F.col("store_id").cast("string")).alias("doc_no"),
                             "sku", "qty")
    keyed = docs.withColumn("store_id", X.key_from_suffix("doc_no").try_cast("bigint"))
    return keyed.join(s.store, "store_id").select("doc_no", "store_code", "sku", "qty")


@query("latest_per_key", """
    SELECT cust_id, mark_id, effective_date, margin FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY cust_id, mark_id ORDER BY effective_date DESC, margin) AS rn FROM rate_asof) AS x
    WHERE rn = 1""", dates=["effective_date"])
def _(s):
    from hangtally.operators.aggregates import best_row
    return best_row(s.rate_asof, ["cust_id", "mark_id"], [F.col("effective_date"), -F.col("margin")], ["effective_date", "margin"])
