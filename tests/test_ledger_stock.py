import datetime as dt

from pyspark.sql import functions as F

from hangtally.operators import ledger as L
from hangtally.operators import stock as ST
from hangtally.operators.ledger import Documents, Family

H = "doc_id int, doc_no string, store_id int, doc_date date, input_date date, status string, cancel_date date"
N = "doc_id int, sku string, qty int, stock_qty int, line_status string, line_cancel_date date, cancelled_by int, kind string"
D = dt.date(2024, 3, 5)
LATER = dt.date(2024, 3, 9)


def docs(spark):
    def fam(headers, lines):
        return Family(spark.createDataFrame(headers, H), spark.createDataFrame(lines, N))
    return Documents(
        receiving=fam([(1, "RC/1/7", 7, D, D, "X", None), (2, "RC/2/7", 7, D, D, "F", None)],
                      [(1, "A", 10, 0, "O", None, None, None), (2, "A", 99, 0, "O", None, None, None)]),
        adjustment=fam([(3, "AD/3", 7, D, D, "X", None), (4, "AD/4", 7, D, D, "O", None)],
                       [(3, "A", 4, 0, "O", None, None, "I"), (3, "A", 1, 0, "O", None, None, "O"), (3, "A", 50, 0, "O", None, 8, "I"),
                        (4, "A", 77, 0, "O", None, None, "I")]),
        sale=fam([(5, "PJ/5", 7, D, D, "X", None), (6, "BZ/6", 7, D, D, "X", None)],
                 [(5, "A", 2, 0, "O", None, None, None), (5, "A", 3, 0, "F", LATER, 1, None), (6, "A", 9, 0, "O", None, None, None)]),
        returned=fam([(7, "RT/7", 7, D, D, "X", None)],
                     [(7, "A", 2, 5, "O", None, None, None), (7, "A", 1, 6, "O", LATER, 4, None)]),
        transfer=fam([(8, "MT/8", 7, D, D, "X", LATER)], [(8, "A", 3, 0, "F", None, None, None)]))


def by_stat(df):
    return {r.stat: r.q for r in df.groupBy("stat").agg(F.sum("qty").alias("q")).collect()}


def test_dated_ledger_shows_a_void_line_twice(spark):
    got = by_stat(L.movement_rows(docs(spark)))
    assert got == {"receive": 10.0, "adj_in": 4.0, "adj_out": -1.0, "penjualan": -5.0, "b_penjualan": 3.0, "retur": -3.0,
                   "mutasi": -3.0, "b_mutasi": 3.0}
    assert L.movement_rows(docs(spark), F.col("doc_date") > F.lit(D)).count() == 0


def test_day_ledger_keeps_entries_and_cancels_apart(spark):
    assert by_stat(L.day_rows(docs(spark), "2024-03-05")) == {
        "receive": 10.0, "adj_in": 4.0, "adj_out": -1.0, "penjualan": -2.0, "retur": -3.0, "mutasi": -3.0}
    # on the later day: the void sale, the rest of the partly cancelled return, the cancelled transfer (header date)
    assert by_stat(L.day_rows(docs(spark), "2024-03-09")) == {"b_penjualan": 3.0, "b_retur2": 5.0, "b_mutasi": 3.0}


def test_net_conserves_quantity(spark):
    rows = L.movement_rows(docs(spark))
    total = rows.agg(F.sum("qty")).first()[0]
    assert L.net(rows).agg(F.sum("qty")).first()[0] == total
    assert L.net(rows, ("store_id", "sku")).agg(F.sum("qty")).first()[0] == total


def dates(*texts):
    return [dt.date.fromisoformat(t) for t in texts]


def setup(spark):
    counts = spark.createDataFrame([
        (1, "A", "2024-01-10", 5.0, "X"), (1, "A", "2024-03-20", 7.0, "X"), (1, "B", "2024-03-20", 1.0, "X"),
        (3, "A", "2024-01-10", 4.0, "X"), (4, "A", "2024-02-01", 0.0, "X"), (5, "A", "2024-03-25", 6.0, "T")],
        "store_id int, sku string, d string, qty double, status string").withColumn("count_date", F.to_date("d"))
    opens = spark.createDataFrame([(2, "A", "2024-01-05", 9.0), (4, "A", "2023-12-01", 2.0), (4, "C", "2023-12-15", 3.0)],
                                  "store_id int, sku string, d string, qty double").withColumn("inject_date", F.to_date("d"))
    stores = spark.createDataFrame([(1, "F"), (2, "F"), (3, "T"), (4, "F"), (5, "F"), (6, "F")], "store_id int, hold string")
    moves = spark.createDataFrame([(1, "A", "2024-03-19", 100.0), (1, "A", "2024-03-20", -1.0), (1, "A", "2024-03-31", -2.0),
                                   (1, "A", "2024-04-01", 50.0), (2, "A", "2024-02-01", -9.0), (4, "C", "2024-02-10", 1.0)],
                                  "store_id int, sku string, d string, qty double").withColumn("move_date", F.to_date("d"))
    return counts, opens, stores, moves


def test_start_dates(spark, rows):
    counts, opens, stores, _ = setup(spark)
    got = {r.store_id: (str(r.start_date), r.origin) for r in
           ST.last_count_dates(counts, opens, stores, "2024-03-28", ["2024-03-31"]).collect()}
    # 3 is closed and old, 6 has neither count nor opening, 5 has an open count and the end date is ahead
    assert got == {1: ("2024-03-20", "count"), 2: ("2024-01-05", "opening"), 4: ("2024-02-01", "count"), 5: ("2024-03-24", "count")}
    past = ST.last_count_dates(counts, opens, stores, "2024-04-28", ["2024-03-31"])
    assert {r.store_id: str(r.start_date) for r in past.collect()}[5] == "2024-03-25"


def test_stock_at_month_end(spark):
    counts, opens, stores, moves = setup(spark)
    got = {(r.store_id, r.sku): (r.qty, r.label) for r in
           ST.stock_at(counts, opens, moves, stores, "2024-04-28", ["2024-03-31"], drop_zero_stores=[2]).collect()}
    # store 4 counted nothing, so its opening balances stand; store 2 comes to 0 and is dropped
    assert got == {(1, "A"): (4.0, "apr_24"), (1, "B"): (1.0, "apr_24"), (4, "A"): (2.0, "apr_24"), (4, "C"): (4.0, "apr_24"),
                   (5, "A"): (6.0, "apr_24")}


def test_all_month_ends_at_once_equal_one_by_one(spark, rows):
    counts, opens, stores, moves = setup(spark)
    ends = ["2024-01-31", "2024-02-29", "2024-03-31"]
    together = ST.stock_at(counts, opens, moves, stores, "2024-03-28", ends)
    apart = [r for e in ends for r in rows(ST.stock_at(counts, opens, moves, stores, "2024-03-28", [e]))]
    assert rows(together) == sorted(apart, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_month_ends():
    assert ST.month_ends("2024-03-15", 3) == ["2024-01-31", "2024-02-29", "2024-03-31"]
    assert ST.month_ends("2024-01-31", 3) == ["2023-11-30", "2023-12-31", "2024-01-31"]


def test_next_month_stock_needs_the_very_next_month(spark, rows):
    df = spark.createDataFrame([(1, "A", "2024-01-01", 5.0, 1.0), (1, "A", "2024-02-01", 7.0, 2.0), (1, "A", "2024-04-01", 9.0, 3.0)],
                               "store_id int, sku string, m string, stock double, sales double").withColumn("month", F.to_date("m"))
    assert rows(ST.next_month_stock(df), "m", "total_stock") == [("2024-01-01", 8.0), ("2024-02-01", 2.0), ("2024-04-01", 3.0)]
