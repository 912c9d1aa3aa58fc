"""The given star-schema tables seen as retail tables.

Every stand-in exists twice: as a DataFrame here and as SQL text for the check engine.
Dates can be limited on the raw column (``between``), so that the limit reaches the scan.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hangtally import constants as K
from hangtally.operators.ledger import Documents, Family, net_by_month
from hangtally.operators.skus import numbered, sku_dictionary
from hangtally.session import scratch_path
from hangtally.sources.readers import read_months
from hangtally.sources.sinks import write_months

#: Folders and schemas of tables derived once per session, input folder and name.
_DERIVED: dict[tuple[str, str, str], tuple[str, StructType]] = {}

VIEWS: dict[str, str] = {
    "store": """
        SELECT s_suppkey AS store_id, s_suppkey * 3 AS cust_id,
               CONCAT('ST', CAST(s_suppkey AS VARCHAR)) AS store_code, s_name AS store_name,
               n_name AS city, r_name AS province,
               CASE WHEN s_acctbal < 0 THEN 'T' ELSE 'F' END AS hold,
               CAST(s_suppkey % 12 AS INTEGER) AS group_id,
               CASE WHEN s_acctbal > 5000 THEN 'T' ELSE 'F' END AS net_flag,
               s_suppkey % 12 < 6 AS consigned
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                      LEFT JOIN region ON n_regionkey = r_regionkey""",
    "article": """
        SELECT p_partkey AS sku, CONCAT(p_brand, '/', p_type) AS article, p_brand AS brand,
               p_type AS category, p_name AS article_name,
               CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'TOP' ELSE 'BOTTOM' END AS size_class,
               CASE WHEN p_size = 50 THEN NULL
                    WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN
                      CASE p_size % 7 WHEN 0 THEN 'XS' WHEN 1 THEN 'S' WHEN 2 THEN 'M' WHEN 3 THEN 'L'
                                      WHEN 4 THEN 'XL' WHEN 5 THEN 'XXL' ELSE 'XXXL' END
                    ELSE CAST(25 + p_size % 16 AS VARCHAR) END AS size,
               CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 0 WHEN p_type IN ('LARGE', 'STANDARD') THEN 1
                    ELSE 2 END AS category_id,
               p_retailprice AS price
        FROM part""",
    "sales_header": """
        SELECT o_orderkey AS doc_id,
               CONCAT(CASE WHEN o_orderpriority = '5-LOW' THEN 'BZ/' ELSE 'PJ/' END, CAST(o_orderkey AS VARCHAR)) AS doc_no,
               o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS sales_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) AS input_date,
               o_orderstatus AS status, o_orderpriority AS event_text, o_totalprice AS doc_total,
               CASE WHEN o_custkey % 10 = 0 THEN 404 ELSE CAST(o_custkey % 12 AS INTEGER) END AS group_id,
               CAST(o_orderkey % 2 AS INTEGER) AS mark_id,
               CAST((o_orderkey % 6 - o_orderkey % 2) / 2 AS INTEGER) AS category_id
        FROM orders""",
    "sales_line": """
        SELECT l_orderkey AS doc_id, l_linenumber AS line_no, l_suppkey AS store_id, l_partkey AS sku,
               CONCAT('sku', CAST(l_partkey AS VARCHAR)) AS sku_code, l_quantity AS qty,
               l_extendedprice AS gross, l_discount AS disc_rate, l_linestatus AS line_status,
               CAST(ROUND(l_discount * 100) AS INTEGER) + 20 AS disc_id,
               l_linenumber % 2 AS mark_id,
               CASE WHEN l_tax > 0.045 THEN NULL ELSE l_returnflag END AS article_status,
               CAST(l_shipdate AS DATE) AS sales_date
        FROM lineitem""",
    "movement": """
        SELECT l_suppkey AS store_id, l_partkey AS sku, CAST(l_shipdate AS DATE) AS move_date,
               l_orderkey AS doc_id,
               CASE CONCAT(l_returnflag, l_linestatus) WHEN 'NO' THEN 'receive' WHEN 'NF' THEN 'adj_in'
                    WHEN 'AO' THEN 'penjualan' WHEN 'AF' THEN 'b_penjualan' WHEN 'RO' THEN 'retur'
                    ELSE 'mutasi' END AS stat,
               CASE WHEN CONCAT(l_returnflag, l_linestatus) IN ('NO', 'NF', 'AF') THEN l_quantity
                    ELSE -l_quantity END AS qty
        FROM lineitem""",
    "stock_count": """
        SELECT l_suppkey AS store_id, l_partkey AS sku, CAST(l_shipdate AS DATE) AS count_date,
               l_quantity AS qty, l_quantity - 25 AS variance,
               CASE WHEN l_linestatus = 'F' THEN 'T' ELSE 'X' END AS status
        FROM lineitem WHERE l_linenumber = 7""",
    "opening_balance": """
        SELECT l_suppkey AS store_id, l_partkey AS sku, CAST(l_shipdate AS DATE) AS inject_date, l_quantity AS qty
        FROM lineitem WHERE l_linenumber = 1 AND l_shipdate < TIMESTAMP '1996-01-01 00:00:00'""",
    "rate_asof": """
        SELECT o_custkey AS cust_id, CAST(o_orderkey % 2 AS INTEGER) AS mark_id,
               CAST(o_orderdate AS DATE) AS effective_date, MIN(o_orderkey % 40) AS margin
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2, 3""",
    "rate_band": """
        SELECT o_custkey AS cust_id, CAST(o_orderkey % 2 AS INTEGER) AS mark_id,
               CAST((o_orderkey % 6 - o_orderkey % 2) / 2 AS INTEGER) AS category_id,
               CAST(o_orderdate AS DATE) AS begin_date, CAST(o_orderdate AS DATE) + 365 AS end_date,
               MIN(o_orderkey % 40) AS margin
        FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM') GROUP BY 1, 2, 3, 4, 5""",
    "delivery": """
        SELECT o_orderkey AS doc_id, o_custkey AS cust_id, o_custkey + 1 AS to_cust_id,
               CAST(o_orderdate AS DATE) AS delivery_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) AS input_date, o_orderstatus AS status
        FROM orders""",
    "delivery_line": """
        SELECT l_orderkey AS doc_id, l_suppkey AS store_id, l_partkey AS sku, l_returnflag AS flag, l_quantity AS qty
        FROM lineitem""",
    "receiving": "SELECT DISTINCT l_orderkey AS doc_id FROM lineitem WHERE l_returnflag = 'N'",
    "discount": "SELECT n_nationkey AS disc_id, n_regionkey AS mark_id, n_name AS disc_name FROM nation",
    "mark": "SELECT r_regionkey AS mark_id, r_name AS mark_name FROM region",
    "intraday": """
        SELECT event_id AS line_id, user_id AS store_id, CAST(FLOOR(value) AS BIGINT) AS sku,
               CAST(ts AS DATE) AS move_date, ts AS input_ts, event_type AS stat,
               CASE event_type WHEN 'purchase' THEN -1e0 WHEN 'error' THEN 1e0 ELSE 0e0 END AS qty
        FROM events""",
    "doc_header": """
        SELECT o_orderkey AS doc_id, o_orderpriority = '5-LOW' AS foreign_prefix, o_custkey AS store_id,
               CAST(o_orderdate AS DATE) AS doc_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) AS input_date,
               CASE o_orderstatus WHEN 'O' THEN 'X' ELSE o_orderstatus END AS status,
               CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) + 20 END AS cancel_date
        FROM orders""",
    "doc_line": """
        SELECT l_orderkey AS doc_id, l_partkey AS sku, l_quantity AS qty, l_quantity + l_linenumber AS stock_qty,
               CASE WHEN l_linenumber = 7 THEN 'F' ELSE 'O' END AS line_status,
               CASE WHEN l_linenumber >= 6 THEN CAST(l_shipdate AS DATE) END AS line_cancel_date,
               CASE WHEN l_linenumber = 6 THEN l_suppkey END AS cancelled_by,
               CASE WHEN l_tax < 0.035 THEN 'I' ELSE 'O' END AS kind,
               CONCAT(l_returnflag, l_linestatus) AS family
        FROM lineitem""",
    "warehouse": """
        SELECT n_nationkey AS wh_id, n_name AS wh_name,
               CASE WHEN n_nationkey % 5 = 0 THEN 'T' ELSE 'F' END AS wh_hold FROM nation""",
    "warehouse_type": """
        SELECT r_regionkey AS type_id, r_regionkey * 4 AS wh_id,
               CASE r_regionkey WHEN 0 THEN 'RETUR' WHEN 1 THEN 'PUSAT' WHEN 2 THEN 'KONSINETTO' WHEN 3 THEN 'QC'
                    ELSE 'LAIN' END AS type_name,
               CASE WHEN r_regionkey = 3 THEN 'T' ELSE 'F' END AS type_hold FROM region""",
    "warehouse_row": """
        SELECT CAST(l_suppkey % 25 AS INTEGER) AS wh_id, l_linenumber % 5 AS type_id, l_partkey AS sku,
               CONCAT(CASE WHEN l_tax < 0.065 THEN 'DO/' ELSE 'XX/' END, CAST(l_orderkey AS VARCHAR)) AS doc_no,
               l_quantity AS qty, l_extendedprice AS qty_in, CAST(l_shipdate AS DATE) AS move_date,
               CONCAT(l_returnflag, l_linestatus) AS family
        FROM lineitem""",
}


def with_views(sql: str) -> str:
    """Put the stand-ins a text mentions in front of it, in dependency order."""
    named = {v for v in VIEWS if re.search(rf"(?<![\w.\"]){v}(?![\w\"])", sql)}
    used = [v for v in VIEWS if v in named]
    if not used:
        return sql
    views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in used)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def _text(c: str) -> Column:
    return F.col(c).cast("string")


class Standins:
    """Lazy frames over one data folder.  ``between`` gives the same frames with the raw
    document date limited at the scan."""

    def __init__(self, spark: SparkSession, folder: str, lo: str | None = None, hi: str | None = None,
                 tables: dict[str, DataFrame] | None = None):
        self.spark, self.folder, self.lo, self.hi = spark, folder, lo, hi
        self._tables = {} if tables is None else tables   # each table's schema is read once

    def between(self, lo: str | None, hi: str | None) -> "Standins":
        return Standins(self.spark, self.folder, lo, hi, self._tables)

    def raw(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def _dated(self, name: str, date: str) -> DataFrame:
        df = self.raw(name)
        if self.lo:
            df = df.where(F.col(date) >= F.lit(self.lo).cast("timestamp_ntz"))
        if self.hi:
            df = df.where(F.col(date) < (F.date_add(F.lit(self.hi).cast("date"), 1)).cast("timestamp_ntz"))
        return df

    def derived(self, name: str, build: Callable[["Standins"], DataFrame], date: str | None = None) -> DataFrame:
        """A table built from the whole input once per session and kept in the shared folder, by month where ``date`` is given."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _DERIVED:
            frame = build(Standins(self.spark, self.folder, tables=self._tables))
            path = scratch_path(self.spark, name)
            write_months(frame, date, path) if date else frame.write.parquet(path)
            _DERIVED[key] = path, frame.drop("month").schema if date else frame.schema
        path, schema = _DERIVED[key]
        return read_months(self.spark, path, schema) if date else self.spark.read.schema(schema).parquet(path)

    # ---- ingestion: SKU texts become numbers, movements become a ledger by month ----

    @property
    def article_code(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(k.alias("sku"), F.when(k == 1, "BBRD103V042333").otherwise(F.concat(F.lit("SKU"), k.cast("string"))).alias("code"))

    def with_sku_text(self, df: DataFrame, spelling: Column) -> DataFrame:
        """``df`` with its SKU spelled as source systems do: in other case, with blanks, and one wrongly."""
        code = F.when(F.col("sku") == 1, "BBRD103V042333").otherwise(F.concat(F.lit("SKU"), _text("sku")))
        text = (F.when((spelling == 0) & (F.col("sku") == 1), F.concat(code, F.lit("-"))).when(spelling == 1, F.lower(code))
                .when(spelling == 2, F.concat(F.lit(" "), code, F.lit(" "))).when(spelling == 3, F.initcap(code)).otherwise(code))
        return df.withColumn("sku_text", text).drop("sku")

    @property
    def movement_text(self) -> DataFrame:
        return self.with_sku_text(self.movement, F.col("doc_id") % 5)

    @property
    def stock_count_text(self) -> DataFrame:
        return self.with_sku_text(self.stock_count, F.col("store_id") % 5)

    @property
    def opening_balance_text(self) -> DataFrame:
        return self.with_sku_text(self.opening_balance, (F.col("store_id") + F.col("qty").cast("long")) % 5)

    @property
    def sku_numbers(self) -> DataFrame:
        texts = lambda s: [t.select("sku_text") for t in (s.movement_text, s.stock_count_text, s.opening_balance_text)]
        return self.derived("sku-numbers", lambda s: sku_dictionary(texts(s), s.article_code))

    @property
    def ledger(self) -> DataFrame:
        """Movements by store, SKU, date and kind, in folders by month."""
        return self.derived("month-ledger", lambda s: net_by_month(numbered(s.movement_text, s.sku_numbers), "move_date"), "move_date")

    @property
    def counted(self) -> DataFrame:
        return self.derived("stock-counts", lambda s: numbered(s.stock_count_text, s.sku_numbers))

    @property
    def opened(self) -> DataFrame:
        return self.derived("opening-balances", lambda s: numbered(s.opening_balance_text, s.sku_numbers))

    @cached_property
    def orders(self) -> DataFrame:
        return self._dated("orders", "o_orderdate")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self._dated("lineitem", "l_shipdate")

    @cached_property
    def store(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return (self.raw("supplier")
                .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
                .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
                .select(F.col("s_suppkey").alias("store_id"), (F.col("s_suppkey") * 3).alias("cust_id"),
                        F.concat(F.lit("ST"), _text("s_suppkey")).alias("store_code"),
                        F.col("s_name").alias("store_name"), F.col("n_name").alias("city"),
                        F.col("r_name").alias("province"),
                        F.when(F.col("s_acctbal") < 0, "T").otherwise("F").alias("hold"),
                        (F.col("s_suppkey") % 12).cast("int").alias("group_id"),
                        F.when(F.col("s_acctbal") > 5000, "T").otherwise("F").alias("net_flag"),
                        (F.col("s_suppkey") % 12 < 6).alias("consigned")))

    @cached_property
    def article(self) -> DataFrame:
        top = F.col("p_type").isin("SMALL", "MEDIUM", "LARGE")
        names = F.array(*[F.lit(x) for x in ("XS", "S", "M", "L", "XL", "XXL", "XXXL")])
        size = (F.when(F.col("p_size") == 50, F.lit(None).cast("string"))
                .when(top, F.get(names, F.col("p_size") % 7))
                .otherwise((F.col("p_size") % 16 + 25).cast("string")))
        return self.raw("part").select(
            F.col("p_partkey").alias("sku"), F.concat("p_brand", F.lit("/"), "p_type").alias("article"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), F.col("p_name").alias("article_name"),
            F.when(top, "TOP").otherwise("BOTTOM").alias("size_class"), size.alias("size"),
            F.when(F.col("p_type").isin("SMALL", "MEDIUM"), 0)
             .when(F.col("p_type").isin("LARGE", "STANDARD"), 1).otherwise(2).alias("category_id"),
            F.col("p_retailprice").alias("price"))

    @cached_property
    def sales_header(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.orders.select(
            k.alias("doc_id"),
            F.concat(F.when(F.col("o_orderpriority") == "5-LOW", "BZ/").otherwise("PJ/"), k.cast("string")).alias("doc_no"),
            F.col("o_custkey").alias("cust_id"), F.to_date("o_orderdate").alias("sales_date"),
            F.date_add(F.to_date("o_orderdate"), (k % 15).cast("int")).alias("input_date"),
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("event_text"),
            F.col("o_totalprice").alias("doc_total"),
            F.when(F.col("o_custkey") % 10 == 0, 404).otherwise((F.col("o_custkey") % 12).cast("int")).alias("group_id"),
            (k % 2).cast("int").alias("mark_id"), ((k % 6 - k % 2) / 2).cast("int").alias("category_id"))

    @cached_property
    def sales_line(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("sku"),
            F.concat(F.lit("sku"), _text("l_partkey")).alias("sku_code"), F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("gross"), F.col("l_discount").alias("disc_rate"),
            F.col("l_linestatus").alias("line_status"),
            (F.round(F.col("l_discount") * 100).cast("int") + 20).alias("disc_id"),
            (F.col("l_linenumber") % 2).alias("mark_id"),
            F.when(F.col("l_tax") > 0.045, F.lit(None)).otherwise(F.col("l_returnflag")).alias("article_status"),
            F.to_date("l_shipdate").alias("sales_date"))

    @cached_property
    def movement(self) -> DataFrame:
        f = F.concat("l_returnflag", "l_linestatus")
        stat = (F.when(f == "NO", K.RECEIVE).when(f == "NF", K.ADJUST_IN).when(f == "AO", K.SALE)
                .when(f == "AF", K.SALE_VOID).when(f == "RO", K.RETURN).otherwise(K.TRANSFER))
        return self.lineitem.select(
            F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("sku"),
            F.to_date("l_shipdate").alias("move_date"), F.col("l_orderkey").alias("doc_id"), stat.alias("stat"),
            F.when(f.isin("NO", "NF", "AF"), F.col("l_quantity")).otherwise(-F.col("l_quantity")).alias("qty"))

    def kind(self, returnflag: str, linestatus: str) -> DataFrame:
        """Movements of one kind, chosen by the raw flags so that the scan can skip."""
        one = self.between(self.lo, self.hi)
        one.__dict__["lineitem"] = self.lineitem.where(
            (F.col("l_returnflag") == returnflag) & (F.col("l_linestatus") == linestatus))
        return one.movement

    @cached_property
    def receipts(self) -> DataFrame:
        return self.kind("N", "O")

    @cached_property
    def stock_count(self) -> DataFrame:
        return self.lineitem.where("l_linenumber = 7").select(
            F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("sku"),
            F.to_date("l_shipdate").alias("count_date"), F.col("l_quantity").alias("qty"),
            (F.col("l_quantity") - 25).alias("variance"),
            F.when(F.col("l_linestatus") == "F", "T").otherwise("X").alias("status"))

    @cached_property
    def opening_balance(self) -> DataFrame:
        return (self.lineitem.where((F.col("l_linenumber") == 1)
                                    & (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")))
                .select(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("sku"),
                        F.to_date("l_shipdate").alias("inject_date"), F.col("l_quantity").alias("qty")))

    @cached_property
    def rate_asof(self) -> DataFrame:
        k = F.col("o_orderkey")
        return (self.orders.where("o_orderpriority = '1-URGENT'")
                .groupBy(F.col("o_custkey").alias("cust_id"), (k % 2).cast("int").alias("mark_id"),
                         F.to_date("o_orderdate").alias("effective_date"))
                .agg(F.min(k % 40).alias("margin")))

    @cached_property
    def rate_band(self) -> DataFrame:
        k = F.col("o_orderkey")
        return (self.orders.where("o_orderpriority in ('2-HIGH', '3-MEDIUM')")
                .groupBy(F.col("o_custkey").alias("cust_id"), (k % 2).cast("int").alias("mark_id"),
                         ((k % 6 - k % 2) / 2).cast("int").alias("category_id"),
                         F.to_date("o_orderdate").alias("begin_date"))
                .agg(F.min(k % 40).alias("margin"))
                .withColumn("end_date", F.date_add("begin_date", 365)))

    @cached_property
    def delivery(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.orders.select(
            k.alias("doc_id"), F.col("o_custkey").alias("cust_id"), (F.col("o_custkey") + 1).alias("to_cust_id"),
            F.to_date("o_orderdate").alias("delivery_date"),
            F.date_add(F.to_date("o_orderdate"), (k % 15).cast("int")).alias("input_date"),
            F.col("o_orderstatus").alias("status"))

    @cached_property
    def delivery_line(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_orderkey").alias("doc_id"), F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("sku"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("qty"))

    @cached_property
    def receiving(self) -> DataFrame:
        # used as the right side of an anti join, which needs no distinct rows
        return self.lineitem.where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("doc_id"))

    @cached_property
    def discount(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").alias("disc_id"), F.col("n_regionkey").alias("mark_id"),
                                         F.col("n_name").alias("disc_name"))

    @cached_property
    def mark(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").alias("mark_id"), F.col("r_name").alias("mark_name"))

    @staticmethod
    def intraday_of(events: DataFrame) -> DataFrame:
        qty = F.when(F.col("event_type") == "purchase", -1.0).when(F.col("event_type") == "error", 1.0).otherwise(0.0)
        return events.select(
            F.col("event_id").alias("line_id"), F.col("user_id").alias("store_id"),
            F.floor("value").cast("long").alias("sku"), F.to_date("ts").alias("move_date"),
            F.col("ts").alias("input_ts"), F.col("event_type").alias("stat"), qty.alias("qty"))

    @cached_property
    def intraday(self) -> DataFrame:
        return self.intraday_of(self.raw("events"))

    @cached_property
    def doc_header(self) -> DataFrame:
        k = F.col("o_orderkey")
        d = F.to_date("o_orderdate")
        return self.orders.select(
            k.alias("doc_id"), (F.col("o_orderpriority") == "5-LOW").alias("foreign_prefix"),
            F.col("o_custkey").alias("store_id"), d.alias("doc_date"),
            F.date_add(d, (k % 15).cast("int")).alias("input_date"),
            F.when(F.col("o_orderstatus") == "O", "X").otherwise(F.col("o_orderstatus")).alias("status"),
            F.when(k % 7 == 0, F.date_add(d, 20)).alias("cancel_date"))

    def _family(self, prefix: str, flags: Column) -> Family:
        headers = self.doc_header.withColumn("doc_no", F.concat(
            F.when(F.col("foreign_prefix"), "XX/").otherwise(f"{prefix}/"), _text("doc_id"))).drop("foreign_prefix")
        n = F.col("l_linenumber")
        lines = self.raw("lineitem").where(flags).select(
            F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("sku"), F.col("l_quantity").alias("qty"),
            (F.col("l_quantity") + n).alias("stock_qty"),
            F.when(n == 7, "F").otherwise("O").alias("line_status"),
            F.when(n >= 6, F.to_date("l_shipdate")).alias("line_cancel_date"),
            F.when(n == 6, F.col("l_suppkey")).alias("cancelled_by"),
            F.when(F.col("l_tax") < 0.035, "I").otherwise("O").alias("kind"))
        return Family(headers, lines)

    @cached_property
    def docs(self) -> Documents:
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        return Documents(
            receiving=self._family("RC", (flag == "N") & (status == "O")),
            adjustment=self._family("AD", (flag == "N") & (status == "F")),
            sale=self._family("PJ", flag == "A"),
            returned=self._family("RT", (flag == "R") & (status == "O")),
            transfer=self._family("MT", (flag == "R") & (status == "F")))

    @cached_property
    def warehouse(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("wh_id"), F.col("n_name").alias("wh_name"),
            F.when(F.col("n_nationkey") % 5 == 0, "T").otherwise("F").alias("wh_hold"))

    @cached_property
    def warehouse_type(self) -> DataFrame:
        k = F.col("r_regionkey")
        return self.raw("region").select(
            k.alias("type_id"), (k * 4).alias("wh_id"),
            F.when(k == 0, "RETUR").when(k == 1, "PUSAT").when(k == 2, "KONSINETTO").when(k == 3, "QC")
             .otherwise("LAIN").alias("type_name"),
            F.when(k == 3, "T").otherwise("F").alias("type_hold"))

    def warehouse_row(self, *families: str) -> DataFrame:
        keep = F.lit(False)
        for f in families:
            keep = keep | ((F.col("l_returnflag") == f[0]) & (F.col("l_linestatus") == f[1]))
        return self.lineitem.where(keep).select(
            (F.col("l_suppkey") % 25).cast("int").alias("wh_id"), (F.col("l_linenumber") % 5).alias("type_id"),
            F.col("l_partkey").alias("sku"),
            F.concat(F.when(F.col("l_tax") < 0.065, "DO/").otherwise("XX/"), _text("l_orderkey")).alias("doc_no"),
            F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("qty_in"),
            F.to_date("l_shipdate").alias("move_date"))
