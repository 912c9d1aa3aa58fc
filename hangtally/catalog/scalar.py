"""Projections, filters and column rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally import functions as X
from hangtally.catalog.registry import half_even, query
from hangtally.operators import master as M
from hangtally.operators import quality as Q
from hangtally.operators import sales as S
from hangtally.operators import stock as ST
from hangtally.operators.filters import optional_filters


@query("clean_sales", """
    SELECT doc_id, line_no, sku, qty, sales_date, CAST(MONTH(sales_date) AS INTEGER) AS month_no,
           MONTHNAME(sales_date) AS month_name, CAST(YEAR(sales_date) AS INTEGER) AS year, UPPER(sku_code) AS sku_code,
           COALESCE(article_status, mark_name) AS article_status
    FROM sales_line LEFT JOIN (SELECT disc_id, mark_name FROM discount JOIN mark USING (mark_id)) AS e USING (disc_id)""",
       dates=["sales_date"])
def _(s):
    events = s.discount.join(s.mark, "mark_id").select("disc_id", F.col("mark_name").alias("event"))
    lines = (s.sales_line.join(events, "disc_id", "left")
             .withColumn("date_text", F.date_format("sales_date", "MM-dd-yyyy"))
             .withColumn("sales_date", X.us_date("date_text")))
    return S.clean_sales(lines).select("doc_id", "line_no", "sku", "qty", "sales_date", "month_no", "month_name", "year",
                                       "sku_code", "article_status")


MONTH_SUMS = ",\n".join(
    f"""COALESCE(SUM(CASE WHEN MONTH(sales_date) = {m} THEN qty END), 0) AS "qty {K.MONTH_NAMES[m - 1]} 97" """ for m in range(1, 13))


@query("rename_columns", f"""
    SELECT store_id, sku, {MONTH_SUMS} FROM sales_line
    WHERE sales_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY store_id, sku""")
def _(s):
    wide = S.monthly_sales_wide(s.between("1997-01-01", "1997-12-31").sales_line, 1997)
    return wide.withColumnsRenamed(ST.month_labels(1997))


@query("surrogate_key", """
    SELECT doc_id, line_no, CAST(store_id AS VARCHAR) || '/' || STRFTIME(sales_date, '%y%m%d') || '/' || CAST(sku AS VARCHAR) AS pk_id,
           CAST(store_id AS VARCHAR) || '/' || article_status AS status_key
    FROM sales_line""")
def _(s):
    return s.sales_line.select("doc_id", "line_no",
                               X.surrogate_key("store_id", F.date_format("sales_date", "yyMMdd"), "sku").alias("pk_id"),
                               X.surrogate_key("store_id", "article_status").alias("status_key"))


@query("net_amounts", """
    SELECT doc_id, line_no, gross, net AS net_amount, sim AS sim_amount, net / 1.11e0 AS dpp, sim / 1.11e0 AS dpp2 FROM (
      SELECT *, CASE WHEN margin_status = 'X' THEN gross ELSE net END AS sim FROM (
        SELECT *, (gross - qty * 1.5e0) * (1 - line_no * 5e0 / 100) AS net,
               CASE WHEN line_status = 'F' THEN 'X' ELSE 'O' END AS margin_status FROM sales_line) AS a) AS b""")
def _(s):
    lines = s.sales_line.withColumns({
        "disc2": F.col("qty") * 1.5, "margin": F.col("line_no") * 5.0,
        "margin_status": F.when(F.col("line_status") == "F", "X").otherwise("O")})
    return S.add_net_amounts(lines, "gross", "disc2", "margin", "margin_status").select(
        "doc_id", "line_no", "gross", "net_amount", "sim_amount", "dpp", "dpp2")


@query("filter_predicates", """
    SELECT doc_id, doc_no, sales_date, group_id FROM sales_header
    WHERE doc_no LIKE 'PJ%' AND status <> 'F' AND sales_date BETWEEN DATE '1996-02-01' AND DATE '1998-02-28'
      AND group_id IN (1, 2, 3, 404)""", dates=["sales_date"])
def _(s):
    h = s.between("1996-02-01", "1998-02-28").sales_header
    return h.where(F.col("doc_no").like("PJ%") & (F.col("status") != K.VOID)
                   & F.col("group_id").isin(1, 2, 3, 404)).select("doc_id", "doc_no", "sales_date", "group_id")


@query("optional_filters", """
    SELECT doc_id, line_no, store_id, l.sku, brand FROM sales_line l JOIN article a ON l.sku = a.sku
    WHERE brand = 'Brand#3' AND store_id IN (SELECT store_id FROM store WHERE store_code IN ('ST1', 'ST2', 'ST5', 'ST8'))""")
def _(s):
    lines = s.sales_line.join(s.article, "sku")
    return optional_filters(lines, s.store, store_codes=["ST1", "ST2", "ST5", "ST8"], brand="Brand#3", price_class=None).select(
        "doc_id", "line_no", "store_id", "sku", "brand")


PRICE_EVENT = "CASE p_size % 5 WHEN 0 THEN 'DISC 50%' WHEN 1 THEN 'NORMAL' WHEN 2 THEN NULL WHEN 3 THEN 'SP 299' ELSE 'DISC 50+20%' END"
PRICE_CATEGORY = """CASE p_type WHEN 'SMALL' THEN 'LONG SLEEVE SHIRT' WHEN 'MEDIUM' THEN 'SHORT SLEEVE POLO SHIRT'
    WHEN 'LARGE' THEN 'SWEAT SHIRT' WHEN 'STANDARD' THEN 'CHINO SHORT PIECE DYED' WHEN 'ECONOMY' THEN 'LONG SLEEVE T-SHIRT (CREW NECK)'
    ELSE 'ACCESSORY' END"""


def priced_articles(s):
    return s.raw("part").select(
        F.col("p_partkey").alias("sku"), F.expr(PRICE_EVENT).alias("event"), F.expr(PRICE_CATEGORY).alias("rule_category"),
        (F.col("p_retailprice") * 200).alias("amount"))


@query("price_class", f"""
    SELECT sku, event, rule_category, amount,
      CASE WHEN event IN ('DISC 50%', 'DISC 70%', 'DISC 50+20%') THEN 'Obral' WHEN event = 'NORMAL' THEN 'Normal'
           WHEN floor_price IS NULL THEN NULL WHEN amount >= floor_price THEN 'Normal' ELSE 'Obral' END AS price_class
    FROM (SELECT *, CASE rule_category WHEN 'LONG SLEEVE SHIRT' THEN 229000 WHEN 'SHORT SLEEVE POLO SHIRT' THEN 189000
                   WHEN 'SWEAT SHIRT' THEN 200000 WHEN 'CHINO SHORT PIECE DYED' THEN 279000
                   WHEN 'LONG SLEEVE T-SHIRT (CREW NECK)' THEN 192000 END AS floor_price
          FROM (SELECT p_partkey AS sku, {PRICE_EVENT} AS event, {PRICE_CATEGORY} AS rule_category, p_retailprice * 200 AS amount
                FROM part) AS a) AS b""")
def _(s):
    return priced_articles(s).withColumn("price_class", X.price_class("event", "rule_category", "amount"))


@query("store_detail_class", """
    SELECT store_id, group_id, net_flag, CASE WHEN group_id = 2 THEN 'MDS' WHEN group_id = 3 THEN 'RMY'
      WHEN group_id > 3 AND net_flag = 'F' THEN 'Other' WHEN group_id > 3 AND net_flag = 'T' THEN 'Consi' END AS detail_class FROM store""")
def _(s):
    return s.store.select("store_id", "group_id", "net_flag", X.store_detail_class("group_id", "net_flag").alias("detail_class"))


@query("input_delay_score", """
    SELECT doc_id, CAST(DATE_DIFF('day', sales_date, input_date) AS INTEGER) AS days,
           CASE WHEN DATE_DIFF('day', sales_date, input_date) <= 3 THEN 'BAIK'
                WHEN DATE_DIFF('day', sales_date, input_date) <= 10 THEN 'SEDANG' ELSE 'BURUK' END AS score
    FROM sales_header""")
def _(s):
    days = F.datediff("input_date", "sales_date")
    return s.sales_header.select("doc_id", days.alias("days")).withColumn("score", X.delay_score("days"))


@query("schema_by_prefix", """
    SELECT CAST(o_orderkey AS INTEGER) AS fn_orderkey, CAST(o_custkey AS INTEGER) AS fn_custkey, o_orderstatus AS fv_status,
           CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS DOUBLE) AS fn_totalprice, CAST(o_orderdate AS DATE) AS fd_day
    FROM orders""", dates=["fd_day"])
def _(s):
    named = Q.prefix_names(s.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"),
                                           F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("totalprice"),
                                           F.col("o_orderdate").alias("day")))
    return Q.schema_by_prefix(named).withColumn("fd_day", F.to_date("fd_day"))


@query("text_cleanup", """
    SELECT p_partkey AS sku, CONCAT(UPPER(w[1][1]), LOWER(w[1][2:]), ' ', UPPER(w[2][1]), LOWER(w[2][2:])) AS title,
           p_name || ' x' AS no_commas, REPLACE(p_name, ' ', '') AS no_spaces, p_name || '’s' AS quoted
    FROM (SELECT *, STRING_SPLIT(p_name, ' ') AS w FROM part) AS x""")
def _(s):
    name = F.col("p_name")
    return s.raw("part").select(
        F.col("p_partkey").alias("sku"),
        X.letters_title(F.concat(F.lit(" 12"), F.upper(name), F.lit("** "))).alias("title"),
        X.drop_commas(F.concat(name, F.lit(", x,"))).alias("no_commas"),
        X.remove_spaces(name).alias("no_spaces"),
        X.fix_mojibake(F.concat(name, F.lit("â€™sâ"))).alias("quoted"))


@query("coerce_numeric", """
    SELECT sku, COALESCE(TRY_CAST(t AS DOUBLE), 0) AS value FROM (
      SELECT p_partkey AS sku, CASE WHEN p_size % 5 = 0 THEN 'n/a' WHEN p_size % 7 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS t
      FROM part) AS x""")
def _(s):
    size = F.col("p_size")
    text = F.when(size % 5 == 0, "n/a").when(size % 7 == 0, F.lit(None)).otherwise(size.cast("string"))
    return s.raw("part").select(F.col("p_partkey").alias("sku"), X.to_number(text).alias("value"))


CONSIGN = """
    SELECT l_orderkey AS doc_id, l_linenumber AS line_no, l_partkey AS sku, l_quantity AS qty,
           CASE l_linenumber WHEN 1 THEN 'SP 299' WHEN 2 THEN 'NP 99' WHEN 3 THEN CASE WHEN l_quantity > 25 THEN 'DISC 50+20%' ELSE 'DISC 50%+20%' END WHEN 4 THEN 'DISC 50%'
                WHEN 5 THEN 'POTONGAN 20' WHEN 6 THEN 'DISC 70%' WHEN 7 THEN CASE WHEN l_quantity > 25 THEN 'NORMAL' END END AS event,
           CASE WHEN l_tax > 0.075 THEN 'T' ELSE 'F' END AS bonus,
           99000 + 1000e0 * l_linenumber AS mark_amount, 200001 + 100e0 * l_suppkey AS list_price,
           150000 + 10e0 * l_suppkey AS price, ROUND(l_discount * 100) * 1000 AS disc,
           l_quantity * 2 AS total_disc2, CAST(l_linenumber * 5 AS DOUBLE) AS margin,
           CASE WHEN l_suppkey % 4 = 0 THEN 404 ELSE 5 END AS group_id,
           1.25e0 AS unit_service_fee, 0.5e0 AS unit_premium, 0.75e0 AS unit_affiliate, l_quantity / 4 AS voucher
    FROM lineitem"""
CONSIGN_CASE = """
    SELECT *,
      CASE WHEN bonus = 'T' THEN mark_amount WHEN event LIKE '%SP%' OR event LIKE '%NP%' THEN mark_amount
           WHEN CONTAINS(event, 'DISC 50%+20%') OR event = 'DISC 50+20%' THEN list_price
           WHEN CONTAINS(event, 'DISC 50%') THEN list_price
           WHEN CONTAINS(event, 'POTONGAN') THEN price ELSE list_price END AS final_price,
      CASE WHEN bonus = 'T' THEN disc WHEN event LIKE '%SP%' OR event LIKE '%NP%' THEN 0
           WHEN CONTAINS(event, 'DISC 50%+20%') OR event = 'DISC 50+20%' THEN list_price * 0.6e0
           WHEN CONTAINS(event, 'DISC 50%') THEN list_price * 0.5e0
           WHEN CONTAINS(event, 'POTONGAN') THEN disc WHEN CONTAINS(event, 'DISC 70%') THEN list_price * 0.7e0
           WHEN CONTAINS(event, 'NORMAL') THEN 0 ELSE disc END AS raw_disc
    FROM consign"""


def consign_lines(s):
    n, qty = F.col("l_linenumber"), F.col("l_quantity")
    event = (F.when(n == 1, "SP 299").when(n == 2, "NP 99").when((n == 3) & (qty > 25), "DISC 50+20%").when(n == 3, "DISC 50%+20%").when(n == 4, "DISC 50%")
             .when(n == 5, "POTONGAN 20").when(n == 6, "DISC 70%").when((n == 7) & (qty > 25), "NORMAL"))
    return s.lineitem.select(
        F.col("l_orderkey").alias("doc_id"), n.alias("line_no"), F.col("l_partkey").alias("sku"), qty.alias("qty"),
        event.alias("event"), F.when(F.col("l_tax") > 0.075, "T").otherwise("F").alias("bonus"),
        (n * 1000.0 + 99000).alias("mark_amount"), (F.col("l_suppkey") * 100.0 + 200001).alias("list_price"),
        (F.col("l_suppkey") * 10.0 + 150000).alias("price"), (F.round(F.col("l_discount") * 100) * 1000).alias("disc"),
        (qty * 2).alias("total_disc2"), (n * 5).cast("double").alias("margin"),
        F.when(F.col("l_suppkey") % 4 == 0, 404).otherwise(5).alias("group_id"),
        F.lit(1.25).alias("unit_service_fee"), F.lit(0.5).alias("unit_premium"), F.lit(0.75).alias("unit_affiliate"),
        (qty / 4).alias("voucher"))


@query("price_disc_case", f"""
    WITH consign AS ({CONSIGN}), c AS ({CONSIGN_CASE})
    SELECT doc_id, line_no, event, bonus, final_price, CAST({half_even('raw_disc')} AS INTEGER) AS final_disc FROM c""")
def _(s):
    price, disc = X.event_price_and_discount("event", "bonus", "mark_amount", "list_price", "price", "disc")
    return consign_lines(s).select("doc_id", "line_no", "event", "bonus", price.alias("final_price"), disc.alias("final_disc"))


@query("consignment_report", f"""
    WITH consign AS ({CONSIGN}), c AS ({CONSIGN_CASE}),
    d AS (SELECT *, {half_even('raw_disc')} AS final_disc FROM c),
    e AS (SELECT *, CASE WHEN event LIKE '%SP%' OR event LIKE '%NP%' THEN mark_amount * qty ELSE final_price * qty END AS gross_total,
                 final_disc * qty AS disc_total FROM d),
    f AS (SELECT *, gross_total - disc_total - total_disc2 AS net_cash FROM e),
    g AS (SELECT *, {half_even('net_cash * margin / 100')} AS margin_amount,
                 CASE WHEN group_id = 404 THEN net_cash - voucher ELSE 0 END AS online_base FROM f)
    SELECT doc_id, line_no, gross_total, disc_total, net_cash, margin_amount,
      CASE WHEN group_id = 404 THEN online_base - margin_amount - 1.25e0 * qty - 0.5e0 * qty - 0.75e0 * qty
           ELSE net_cash - margin_amount END AS net_amount,
      CASE WHEN group_id = 404 THEN 0 ELSE {half_even('(net_cash - margin_amount) / 1.11e0', 2)} END AS dpp,
      CASE WHEN group_id = 404 THEN 0 ELSE {half_even('(net_cash - margin_amount) / 1.11e0 * 0.11e0', 2)} END AS vat,
      {half_even('online_base / 1.11e0', 2)} AS online_dpp, {half_even('online_base / 1.11e0 * 0.11e0', 2)} AS online_vat
    FROM g""")
def _(s):
    return S.consignment_amounts(consign_lines(s)).select(
        "doc_id", "line_no", "gross_total", "disc_total", "net_cash", "margin_amount", "net_amount", "dpp", "vat",
        "online_dpp", "online_vat")


@query("coalesce_columns", """
    SELECT doc_id, line_no, COALESCE(article_status, line_status) AS status FROM sales_line""")
def _(s):
    return s.sales_line.select("doc_id", "line_no", F.coalesce("article_status", "line_status").alias("status"))


@query("group_total_label", """
    SELECT province, store_code || ' - ' || store_name AS store_label, COUNT(*) AS lines, SUM(qty) AS qty
    FROM movement JOIN store USING (store_id) GROUP BY 1, 2""")
def _(s):
    sums = s.movement.groupBy("store_id").agg(F.count("*").alias("n"), F.sum("qty").alias("q"))
    return (sums.join(s.store, "store_id").groupBy("province", X.code_label("store_code", "store_name").alias("store_label"))
            .agg(F.sum("n").alias("lines"), F.sum("q").alias("qty")))


@query("month_calendar", """
    WITH span AS (SELECT MIN(sales_date) AS lo, MAX(sales_date) AS hi FROM sales_header),
    m AS (SELECT CAST(UNNEST(GENERATE_SERIES(DATE_TRUNC('year', lo)::TIMESTAMP,
              LEAST(DATE_TRUNC('year', hi) + INTERVAL 11 MONTH, DATE_TRUNC('month', hi) + INTERVAL 1 MONTH)::TIMESTAMP,
              INTERVAL 1 MONTH)) AS DATE) AS start_date FROM span)
    SELECT LOWER(STRFTIME(start_date, '%b_%y')) AS label, start_date, LAST_DAY(start_date) AS end_date, COUNT(doc_id) AS documents
    FROM m LEFT JOIN sales_header ON sales_date BETWEEN start_date AND LAST_DAY(start_date) GROUP BY start_date""",
       dates=["start_date", "end_date"])
def _(s):
    from hangtally.plans.calendar import month_calendar
    per_month = s.sales_header.groupBy(X.month_start("sales_date").alias("start_date")).agg(F.count("*").alias("documents"))
    return month_calendar(s.sales_header, "sales_date").join(per_month, "start_date", "left").fillna(0, ["documents"])


@query("last_n_month_ends", """
    SELECT store_id, LAST_DAY(CAST(d - TO_MONTHS(back) AS DATE)) AS month_end
    FROM (SELECT store_id, DATE_TRUNC('month', MAX(move_date)) AS d FROM movement GROUP BY store_id) AS x,
         (SELECT UNNEST([0, 1, 2]) AS back) AS y""", dates=["month_end"])
def _(s):
    from hangtally.plans.calendar import last_month_ends
    return last_month_ends(s.movement, ["store_id"], "move_date", 3)


@query("default_columns", """
    SELECT store_id, sku, CAST(NULL AS VARCHAR) AS first_receipt, 0 AS aging, stock FROM (
      SELECT store_id, sku, SUM(qty) AS stock FROM movement GROUP BY ALL) AS x""")
def _(s):
    stock = s.movement.groupBy("store_id", "sku").agg(F.sum("qty").alias("stock"))
    return M.default_columns(stock, {"store_id": None, "sku": None, "first_receipt": None, "aging": 0, "stock": None})


@query("distinct_values", "SELECT DISTINCT city, province FROM store")
def _(s):
    return s.store.select("city", "province").distinct()
