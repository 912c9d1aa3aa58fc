"""Ledger and warehouse extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hangtally.catalog.registry import query
from hangtally.functions import in_year
from hangtally.operators import ledger as L
from hangtally.operators import stock as ST
from hangtally.operators import warehouse as W
from hangtally.sources.versions import written

LINES = """
    line AS (SELECT h.*, l.sku, l.qty, l.stock_qty, l.line_status, l.line_cancel_date, l.cancelled_by, l.kind, l.family
             FROM doc_header h JOIN doc_line l USING (doc_id))"""


def no(prefix: str) -> str:
    return f"CONCAT(CASE WHEN foreign_prefix THEN 'XX/' ELSE '{prefix}/' END, CAST(doc_id AS VARCHAR))"


def branch(prefix: str, stat: str, qty: str, where: str) -> str:
    return f"SELECT store_id, sku, doc_date AS move_date, {no(prefix)} AS doc_no, '{stat}' AS stat, {qty} AS qty FROM line WHERE {where}"


DATED = " UNION ALL ".join([
    branch("RC", "receive", "qty", "family = 'NO' AND status <> 'F'"),
    branch("AD", "adj_in", "qty", "family = 'NF' AND status = 'X' AND kind = 'I' AND cancelled_by IS NULL"),
    branch("AD", "adj_out", "-qty", "family = 'NF' AND status = 'X' AND kind = 'O' AND cancelled_by IS NULL"),
    branch("PJ", "b_penjualan", "qty", "family IN ('AO', 'AF') AND line_status = 'F'"),
    branch("PJ", "penjualan", "-qty", "family IN ('AO', 'AF') AND NOT foreign_prefix"),
    branch("RT", "b_retur", "qty", "family = 'RO' AND line_status = 'F'"),
    branch("RT", "retur", "-qty", "family = 'RO' AND NOT foreign_prefix"),
    branch("MT", "b_mutasi", "qty", "family = 'RF' AND line_status = 'F'"),
    branch("MT", "mutasi", "-qty", "family = 'RF' AND NOT foreign_prefix"),
])


def today_sql(asof: str) -> str:
    day = f"DATE '{asof}'"
    return " UNION ALL ".join([
        branch("RC", "receive", "qty", f"family = 'NO' AND status <> 'F' AND input_date = {day}"),
        branch("AD", "adj_in", "qty", f"family = 'NF' AND status = 'X' AND kind = 'I' AND cancelled_by IS NULL AND input_date = {day}"),
        branch("AD", "adj_out", "-qty", f"family = 'NF' AND status = 'X' AND kind = 'O' AND cancelled_by IS NULL AND input_date = {day}"),
        branch("PJ", "b_penjualan", "qty", f"family IN ('AO', 'AF') AND line_status = 'F' AND line_cancel_date = {day}"),
        branch("PJ", "penjualan", "-qty", f"family IN ('AO', 'AF') AND NOT foreign_prefix AND line_cancel_date IS NULL AND input_date = {day}"),
        branch("RT", "b_retur", "qty", f"family = 'RO' AND line_status = 'F' AND line_cancel_date = {day}"),
        branch("RT", "b_retur2", "stock_qty - qty", f"family = 'RO' AND cancelled_by IS NOT NULL AND line_cancel_date = {day}"),
        branch("RT", "retur", "-qty", f"family = 'RO' AND NOT foreign_prefix AND input_date = {day}"),
        branch("MT", "b_mutasi", "qty", f"family = 'RF' AND line_status = 'F' AND cancel_date = {day}"),
        branch("MT", "b_mutasi2", "stock_qty - qty", f"family = 'RF' AND cancelled_by IS NOT NULL AND line_cancel_date = {day}"),
        branch("MT", "mutasi", "-qty", f"family = 'RF' AND NOT foreign_prefix AND input_date = {day}"),
    ])


@query("union_ledger", f"WITH {LINES} {DATED}", dates=["move_date"])
def _(s):
    return L.movement_rows(s.docs)


@query("ledger_net", """
    SELECT store_id, sku, move_date, stat, SUM(qty) AS qty FROM movement GROUP BY store_id, sku, move_date, stat""",
       dates=["move_date"])
def _(s):
    return L.net(s.movement)


@query("ledger_year_net", f"""
    WITH {LINES}, rows_ AS ({DATED})
    SELECT store_id, sku, move_date, stat, SUM(qty) AS qty FROM rows_
    WHERE move_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY store_id, sku, move_date, stat""", dates=["move_date"])
def _(s):
    return L.net(L.movement_rows(s.between("1997-01-01", "1997-12-31").docs, in_year("doc_date", 1997)))


@query("ledger_today", f"""
    WITH {LINES}, rows_ AS ({today_sql('1997-06-13')})
    SELECT store_id, sku, move_date, doc_no, stat, SUM(qty) AS qty FROM rows_ GROUP BY store_id, sku, move_date, doc_no, stat""",
       dates=["move_date"])
def _(s):
    return L.net(L.day_rows(s.docs, "1997-06-13"), ("store_id", "sku", "move_date", "doc_no", "stat"))


@query("ledger_range_by_store", f"""
    WITH {LINES}, rows_ AS ({DATED}),
    win AS (SELECT store_id, MIN(doc_date) + 180 AS start_date, MAX(doc_date) - 180 AS end_date FROM doc_header GROUP BY store_id)
    SELECT store_id, sku, end_date, SUM(qty) AS qty FROM rows_ JOIN win USING (store_id)
    WHERE move_date BETWEEN start_date AND end_date GROUP BY store_id, sku, end_date""", dates=["end_date"])
def _(s):
    windows = s.doc_header.groupBy("store_id").agg(F.date_add(F.min("doc_date"), 180).alias("start_date"),
                                                   F.date_sub(F.max("doc_date"), 180).alias("end_date"))
    ledger = s.derived("document-ledger", lambda own: L.net_by_month(L.movement_rows(own.docs), "move_date"), "move_date")
    return ST.ledger_in_windows(ledger, written(windows, "windows"))


@query("returns_ledger", f"""
    WITH {LINES}, rows_ AS ({DATED})
    SELECT store_id, sku, move_date, doc_no, stat, qty FROM rows_
    WHERE stat IN ('retur', 'b_retur') AND move_date BETWEEN DATE '1996-12-31' AND DATE '1999-06-30'""", dates=["move_date"])
def _(s):
    return L.returns_ledger(s.between("1996-12-31", "1999-06-30").docs, "1996-12-31", "1999-06-30")


@query("ledger_extract", """
    SELECT store_name, city, article, sku, size, qty, doc_id, stat, move_date FROM movement JOIN store USING (store_id)
    LEFT JOIN article USING (sku)
    WHERE city = 'NATION_3' AND move_date BETWEEN DATE '1997-06-01' AND DATE '1997-08-22'""", dates=["move_date"])
def _(s):
    rows = s.between("1997-06-01", "1997-08-22").movement
    return (rows.join(s.store.where("city = 'NATION_3'"), "store_id").join(s.article, "sku", "left")
            .select("store_name", "city", "article", "sku", "size", "qty", "doc_id", "stat", "move_date"))


# ---- warehouses ------------------------------------------------------------

@query("warehouse_types", """
    SELECT type_id, t.wh_id, type_name, wh_name FROM warehouse_type t JOIN warehouse w ON t.wh_id = w.wh_id
    WHERE type_hold = 'F' AND wh_hold = 'F'""")
def _(s):
    return W.active_types(s.warehouse_type, s.warehouse)


BALANCE = """
    bal AS (SELECT article, b.sku, wh_name, type_name, stock, booked FROM (
        SELECT wh_id, type_id, sku, SUM(qty) AS stock, SUM(CASE WHEN family = 'NF' THEN qty ELSE 0 END) AS booked
        FROM warehouse_row WHERE family IN ('NO', 'NF') GROUP BY wh_id, type_id, sku) AS b
      LEFT JOIN (SELECT * FROM warehouse WHERE wh_hold = 'F') AS w ON b.wh_id = w.wh_id
      LEFT JOIN (SELECT * FROM warehouse_type WHERE type_hold = 'F') AS t ON b.type_id = t.type_id
      LEFT JOIN article a ON b.sku = a.sku)"""


def balances(s):
    stock = (s.warehouse_row("NO").withColumn("booked", F.lit(0.0))
             .unionByName(s.warehouse_row("NF").withColumn("booked", F.col("qty")))
             .groupBy("wh_id", "type_id", "sku").agg(F.sum("qty").alias("stock"), F.sum("booked").alias("booked")))
    return W.balance(stock, s.warehouse, s.warehouse_type, s.article)


@query("warehouse_balance", f"WITH {BALANCE} SELECT * FROM bal")
def _(s):
    return balances(s)


@query("warehouse_stock", f"""
    WITH {BALANCE} SELECT sku, SUM(stock) AS stock FROM bal
    WHERE type_name IN ('RETUR', 'PUSAT', 'KONSINETTO', 'QC') AND article IS NOT NULL GROUP BY sku""")
def _(s):
    return W.stock_by_sku(balances(s))


WH_JOIN = "JOIN warehouse w ON r.wh_id = w.wh_id JOIN warehouse_type t ON r.type_id = t.type_id"


@query("warehouse_ledger", f"""
    SELECT wh_name, type_name, sku, CASE WHEN family IN ('RO', 'RF') THEN -qty ELSE qty END AS qty, move_date,
           CASE family WHEN 'NO' THEN 'Stock GR' WHEN 'NF' THEN 'Stock In Gudang' WHEN 'RO' THEN 'Stock Out Gudang' ELSE 'Stock DO' END AS stat
    FROM warehouse_row r {WH_JOIN}
    WHERE move_date > DATE '1998-01-01' AND family IN ('NO', 'NF', 'RO', 'RF')
      AND (family <> 'RF' OR (doc_no LIKE 'DO/%' AND qty <> 0))""", dates=["move_date"])
def _(s):
    late = s.between("1998-01-02", None)
    return W.ledger(late.warehouse_row("NO"), late.warehouse_row("NF"), late.warehouse_row("RO"), late.warehouse_row("RF"),
                    s.warehouse, s.warehouse_type, "1998-01-01")


@query("warehouse_opening", f"""
    SELECT wh_name, type_name, sku, qty, qty_in, move_date FROM warehouse_row r {WH_JOIN}
    WHERE family = 'AO' AND move_date > DATE '1998-01-01' AND qty <> 0""", dates=["move_date"])
def _(s):
    rows = s.between("1998-01-02", None).warehouse_row("AO")
    return W.dated_extract(rows, s.warehouse, s.warehouse_type, "1998-01-01", keep=F.col("qty") != 0,
                           columns=("wh_name", "type_name", "sku", "qty", "qty_in", "move_date"))


@query("warehouse_returns", f"""
    SELECT wh_name, type_name, sku, qty, move_date, 'Stock In Retur' AS stat FROM warehouse_row r {WH_JOIN}
    WHERE family = 'RO' AND move_date > DATE '1998-01-01'""", dates=["move_date"])
def _(s):
    rows = s.between("1998-01-02", None).warehouse_row("RO")
    return W.dated_extract(rows, s.warehouse, s.warehouse_type, "1998-01-01", tag="Stock In Retur")


@query("warehouse_counts", f"""
    SELECT wh_name, type_name, sku, qty, move_date, 'SO Gudang' AS stat FROM warehouse_row r {WH_JOIN}
    WHERE family = 'AF' AND move_date > DATE '1998-05-01' AND qty <> 0""", dates=["move_date"])
def _(s):
    rows = s.between("1998-05-02", None).warehouse_row("AF")
    return W.dated_extract(rows, s.warehouse, s.warehouse_type, "1998-05-01", tag="SO Gudang", keep=F.col("qty") != 0)
