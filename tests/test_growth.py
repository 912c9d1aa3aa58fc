"""Steps that must not grow faster than their input."""

import datetime as dt
import re

from pyspark.sql import functions as F

from hangtally.operators import joins as J
from hangtally.operators import ledger as L
from hangtally.operators import stock as ST
from hangtally.sources.readers import read_months
from hangtally.sources.sinks import write_months


def text(df):
    return df._jdf.queryExecution().toString()


def test_windows_of_many_stores_are_not_repeated(spark):
    """one row per store and window, however many pieces a hot store would have."""
    days = spark.range(0, 20_000).select((F.col("id") % 5000).alias("store_id"), F.col("id").alias("sku"),
                                         F.expr("date'2024-01-01' + cast(id % 40 as int)").alias("move_date"), F.lit(1.0).alias("qty"))
    windows = spark.range(0, 5000).select(F.col("id").alias("store_id"), F.expr("date'2024-01-03'").alias("start_date"), F.expr("date'2024-01-20'").alias("end_date"))
    got = ST.ledger_in_windows(days, windows)
    assert "Generate" not in text(got)
    want = days.where("move_date between date'2024-01-03' and date'2024-01-20'")
    assert got.agg(F.count("*"), F.sum("qty")).first() == (want.count(), float(want.count()))
    hot = days.union(days.withColumn("store_id", F.lit(7)).withColumn("sku", F.col("sku") + 20_000))
    hits, piece = J.spread_join(hot, windows, "store_id", "sku")
    pieces = {r[0]: r[1] for r in hits.groupBy((F.col("store_id") == 7).alias("hot")).agg(F.count_distinct(piece)).collect()}
    assert pieces == {True: 32, False: 1} and hits.count() == hot.count()


def test_a_month_ledger_is_dealt_once(spark, rows, tmp_path):
    """F2 to F6, F8: the sum and the folders by month come from one exchange."""
    data = [(s, k, dt.date(2024, m, 3) if m else None, stat, q) for s, k, m, stat, q in [
        (1, 5, 1, "a", 2.0), (1, 5, 1, "a", 3.0), (1, 5, 1, "b", 1.0), (1, 5, 2, "a", 7.0), (None, 5, 2, "a", 4.0), (2, None, 0, None, None)]]
    moved = spark.createDataFrame(data, "store_id long, sku long, move_date date, stat string, qty double")
    net = L.net_by_month(moved, "move_date")
    assert len(re.findall("Exchange hashpartitioning", net._jdf.queryExecution().executedPlan().toString())) == 1
    write_months(net, "move_date", str(tmp_path / "ledger"))
    back = read_months(spark, str(tmp_path / "ledger"), net.drop("month").schema)
    assert rows(back.drop("month")) == rows(L.net(moved))
    assert rows(back.where("move_date is not null").select("month").distinct()) == [("2024-01",), ("2024-02",)]


def test_few_spans_a_key_take_one_join(spark, rows, monkeypatch):
    """facts are shuffled once for closed and open spans, and spans are not spread over months."""
    rates = spark.createDataFrame([(k, dt.date(2024, 1 + (k + n) % 12, 1 + n), 10 * k + n) for k in range(40) for n in range(3)] + [(None, None, 1)],
                                  "k int, eff date, v int")
    facts = spark.createDataFrame([(n, n % 41, dt.date(2023, 12, 1) + dt.timedelta(days=n % 500)) for n in range(2000)] + [(-1, 3, None), (-2, None, dt.date(2024, 5, 5))],
                                  "id int, k int, day date")
    joined = lambda: J.asof_join(facts, rates, ["k"], "day", "eff", "v", "margin")
    bands = rates.withColumn("e", F.when(F.col("v") % 3 > 0, F.date_add("eff", 50))).withColumn("b", F.when(F.col("v") % 5 > 0, F.col("eff")))
    banded = lambda: J.interval_join(facts, bands, ["k"], "day", "b", "e", "v", "margin")
    want, want_banded = rows(joined()), rows(banded())
    monkeypatch.setattr(J, "SMALL_SPANS", 0)
    one = joined()
    assert len(re.findall("LeftOuter", one._jdf.queryExecution().optimizedPlan().toString())) == 1 and "explode" not in text(one)
    assert rows(one) == want and rows(banded()) == want_banded
    monkeypatch.setattr(J, "FEW_SPANS", 1)
    assert rows(joined()) == want and "explode" in text(joined())
