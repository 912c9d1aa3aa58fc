"""Cases that no stand-in contains: late entries, further classes and sizes, marks, used ids."""

import datetime as dt

from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally import functions as X
from hangtally.operators import numbering as N
from hangtally.operators import outstanding as O
from hangtally.operators import sales as S
from hangtally.operators import sizerun as G
from hangtally.plans.stock_reports import status_with_sales
from hangtally.sources import sinks as W


def test_other_size_classes_are_carried_through(spark, rows):
    size = K.ALL_SIZES[0]
    df = spark.createDataFrame([("s", "a", size, "ACC", 2.0), ("s", "b", size, "TOP", 1.0), ("s", "b", size, "ACC", 1.0), ("s", "c", size, None, 1.0)],
                               "store string, article string, size string, size_class string, qty double")
    assert rows(G.size_pivot(df, ["store", "article"], "qty"), "article", "size_class") == [("a", "ACC"), ("b", "TOP"), ("c", None)]
    long = df.withColumn("size_class", F.concat(F.lit("ACCESSORIES OF ALL KINDS "), "article"))   # of any length; the greatest wins
    assert rows(G.size_pivot(long, ["store"], "qty"), "size_class") == [("ACCESSORIES OF ALL KINDS c",)]
    assert rows(G.size_pivot(long, ["store", "article"], "qty", articles=long), "size_class")[0] == ("ACCESSORIES OF ALL KINDS a",)


def test_unlisted_sizes_count_in_the_status_with_sales(spark, rows):
    df = spark.createDataFrame([(1, "a", "ODD", "TOP", 4.0, "receive"), (1, "a", K.ALL_SIZES[0], "TOP", 3.0, "receive"), (1, "b", "ODD", "TOP", 2.0, "receive"),
                                (1, "c", None, "TOP", 2.0, "receive")], "store_id int, article string, size string, size_class string, qty double, stat string")
    assert rows(status_with_sales(df), "article", "sum_qty") == [("a", 7), ("b", 2)]


def test_rows_on_the_mark_come_again_and_are_written_once(spark, rows):
    day = lambda n: dt.date(2024, 1, n)
    target = spark.createDataFrame([(1, day(1), 1.0), (2, day(2), 1.0)], "k int, d date, q double")
    source = spark.createDataFrame([(1, day(1), 1.0), (2, day(2), 1.0), (3, day(2), 5.0), (4, day(3), 6.0)], "k int, d date, q double")
    assert rows(O.newer_than_mark(source, target, "d"), "k") == [(2,), (3,), (4,)]
    once = O.refresh_outstanding(source, target, "k", "d")
    assert rows(once) == rows(source) == rows(O.refresh_outstanding(source, once, "k", "d"))


def test_spare_ids_do_not_meet_used_ones(spark, rows):
    df = spark.createDataFrame([(1, 9000), (2, None), (3, 12), (4, None), (5, 9007)], "cust_id int, store_id int")
    assert rows(N.sequence_fill(df, "store_id", "cust_id", 9000), "store_id") == [(12,), (9000,), (9007,), (9008,), (9009,)]
    assert rows(N.sequence_fill(df.where("cust_id in (2, 3)"), "store_id", "cust_id", 9000), "store_id") == [(12,), (9000,)]


def test_monthly_sales_follow_the_document(spark, rows):
    day = dt.date(1997, 1, 31)
    headers = spark.createDataFrame([(1, "PJ1", "T", day), (2, "BZ2", "T", day), (3, "PJ3", "F", day)], "doc_id int, doc_no string, status string, sales_date date")
    lines = spark.createDataFrame([(d, 7, 8, s, dt.date(1997, 2, 1), 1.0) for d in (1, 2, 3) for s in ("T", "F")],
                                  "doc_id int, store_id int, sku int, line_status string, sales_date date, qty double")
    assert rows(S.monthly_sales_wide(S.documented_lines(headers, lines), 1997), "qty_01", "qty_02") == [(1.0, 0.0)]


def test_event_text_is_repaired_before_the_rules(spark, rows):
    df = spark.createDataFrame([("DISC 50+20%",), ("DISC 50%+20%",), ("DISC 50%",)], "e string").selectExpr(
        "e", "'F' AS b", "1D AS m", "1000D AS l", "2D AS p", "3D AS d")
    price, disc = X.event_price_and_discount("e", "b", "m", "l", "p", "d")
    assert rows(df.select("e", price.alias("p"), disc.alias("d"))) == [
        ("DISC 50%", 1000.0, 500), ("DISC 50%+20%", 1000.0, 600), ("DISC 50+20%", 1000.0, 600)]


def test_mark_of_the_article_where_the_line_has_none(spark, rows):
    lines = spark.createDataFrame([(1, 10, 5), (2, 10, None), (3, 11, None), (4, 99, None)], "id int, sku int, mark_id int")
    articles = spark.createDataFrame([(10, 7, 1), (11, 8, 2)], "sku int, mark_id int, category_id int")
    assert rows(S.marks_from_articles(lines, articles).select("id", "mark_id", "category_id")) == [
        (1, 5, 1), (2, 7, 1), (3, 8, 2), (4, None, None)]


def test_outstanding_takes_the_customer_of_the_order(spark, rows):
    deliveries = spark.createDataFrame([(1, 50, "F", 7), (2, 51, "F", 7), (3, 52, "F", None), (4, 53, "F", 8), (5, 54, "F", 9)],
                                       "doc_id int, cust_id int, status string, order_no int")
    lines = spark.createDataFrame([(k, 1, 2.0) for k in range(1, 6)], "doc_id int, sku int, qty double")
    received = spark.createDataFrame([(5,)], "doc_id int")
    orders = spark.createDataFrame([(7, 100), (9, 101)], "order_no int, cust_id int")
    assert rows(O.outstanding(deliveries, lines, received, ["cust_id", "sku"], "qty", orders)) == [(100, 1, 4.0)]


def test_numbers_of_sparse_ids(spark):
    ids = [(-1) ** k * (k * 0x9E3779B97F4A7C15 % (1 << 63)) for k in range(500)] + [None]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = {r["id"]: r["n"] for r in N.number_rows(df, [], "id", "n").collect()}
    assert got == {i: k for k, i in enumerate([None] + sorted(ids[:-1]), 1)}
    same = spark.createDataFrame([(7, "b"), (7, "a")], "id bigint, t string")
    assert sorted((r["t"], r["n"]) for r in N.number_rows(same, [], "id", "n", ["t"]).collect()) == [("a", 1), ("b", 2)]


def test_export_in_equal_parts(spark, tmp_path):
    W.export_in_equal_parts(spark.range(10).toDF("k"), str(tmp_path / "thirds"), "k")
    got = [sorted(int(r["k"]) for r in spark.read.option("header", True).csv(f"{tmp_path}/thirds/part={i}").collect()) for i in range(3)]
    assert got == [[0, 1, 2, 3], [4, 5, 6], [7, 8, 9]]
