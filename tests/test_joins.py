import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hangtally.operators import joins as J

BASE = dt.date(2024, 1, 1)


def d(n):
    return BASE + dt.timedelta(days=n)


def brute_asof(facts, rates):
    out = []
    for i, k, day in facts:
        known = [(r, -v) for kk, r, v in rates if kk == k and k is not None and day is not None and r <= day]
        out.append((i, -max(known)[1] if known else None))
    return sorted(out)


def brute_band(facts, bands):
    out = []
    for i, k, day in facts:
        hit = [(b, -v) for kk, b, e, v in bands if kk == k and k is not None and day is not None and b <= day <= e]
        out.append((i, -max(hit)[1] if hit else None))
    return sorted(out)


def frames(spark, facts, rates, schema):
    return (spark.createDataFrame(facts, "id int, k int, day date"), spark.createDataFrame(rates, schema))


def check_asof(spark, facts, rates, **limits):
    f, r = frames(spark, facts, rates, "k int, eff date, v int")
    got = sorted((x.id, x.margin) for x in J.asof_join(f, r, ["k"], "day", "eff", "v", "margin", **limits).collect())
    assert got == brute_asof(facts, rates)


def check_band(spark, facts, bands):
    f, b = frames(spark, facts, bands, "k int, b date, e date, v int")
    got = sorted((x.id, x.margin) for x in J.interval_join(f, b, ["k"], "day", "b", "e", "v", "margin").collect())
    assert got == brute_band(facts, bands)


def test_asof_edges(spark):
    facts = [(1, 1, d(-5)), (2, 1, d(0)), (3, 1, d(9)), (4, 1, d(10)), (5, 1, d(900)), (6, None, d(3)), (7, 1, None), (8, 2, d(3))]
    rates = [(1, d(0), 20), (1, d(10), 30), (1, d(10), 25), (None, d(0), 99)]     # a tie on d(10): the lowest
    check_asof(spark, facts, rates)


def test_asof_rates_far_outside_the_facts(spark):
    facts = [(i, i % 3, d(i)) for i in range(60)]
    rates = [(k, d(n), n + k) for k in range(3) for n in (-100, 5, 31, 59, 61, 400)]
    check_asof(spark, facts, rates)


def test_open_bands(spark):
    facts = [(i, 1, d(n)) for i, n in enumerate((-3000, -1, 0, 5, 9, 10, 99, 30000))]
    bands = [(1, None, d(5), 3), (1, d(0), d(9), 4), (1, d(99), None, 5)]
    f, b = frames(spark, facts, bands, "k int, b date, e date, v int")
    got = sorted((x.id, x.margin) for x in J.interval_join(f, b, ["k"], "day", "b", "e", "v", "margin").collect())
    assert got == [(0, 3), (1, 3), (2, 4), (3, 4), (4, 4), (5, None), (6, 5), (7, 5)]


def test_band_edges(spark):
    facts = [(1, 1, d(-1)), (2, 1, d(0)), (3, 1, d(40)), (4, 1, d(41)), (5, 1, d(20)), (6, None, d(3)), (7, 1, d(80))]
    bands = [(1, d(0), d(40), 10), (1, d(15), d(30), 12), (1, d(15), d(25), 11), (1, d(70), d(5000), 7), (1, d(90), d(60), 1)]
    check_band(spark, facts, bands)


small = st.integers(0, 3)
days = st.integers(-60, 120)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(small, days), min_size=1, max_size=30),
       st.lists(st.tuples(small, days, st.integers(0, 90), st.integers(1, 40)), min_size=1, max_size=15))
def test_rate_joins_equal_brute_force(spark, facts, bands):
    f = [(i, k, d(n)) for i, (k, n) in enumerate(facts)]
    check_asof(spark, f, [(k, d(n), v) for k, n, _, v in bands])
    check_band(spark, f, [(k, d(n), d(n + length), v) for k, n, length, v in bands])


def test_null_safe_anti(spark, rows):
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "id int, t string")
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, t string")
    assert rows(J.null_safe_anti(new, old, ["id", "t"])) == [(3, "x")]


def test_spread_join_equals_plain_join_on_a_hot_key(spark, rows):
    rng = random.Random(7)
    facts = [(1 if rng.random() < 0.5 else rng.randint(2, 9), rng.randint(0, 50), 1) for _ in range(2000)]
    f = spark.createDataFrame(facts, "store_id int, sku int, qty int")
    per_store = spark.createDataFrame([(i, i * 10) for i in range(1, 8)], "store_id int, w int")
    got, piece = J.spread_join(f, per_store, "store_id", "sku", pieces=8)
    assert got.select(piece).distinct().count() > 4
    assert rows(got.groupBy("store_id", piece, "sku").agg(F.sum("w").alias("w")).drop(piece)) == \
        rows(f.join(per_store, "store_id").groupBy("store_id", "sku").agg(F.sum("w").alias("w")))


def test_full_join_keeps_both_sides(spark, rows):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, a double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "k int, b double")
    assert rows(J.full_join(a, b, ["k"], zeros=["a", "b"]), "k", "a", "b") == [(1, 2.0, 0.0), (2, 3.0, 5.0), (3, 0.0, 6.0)]


def test_key_translate_with_doubled_lookup(spark, rows):
    f = spark.createDataFrame([(1, 5), (2, 6)], "id int, cust int")
    lookup = spark.createDataFrame([(5, 50), (5, 50)], "cust int, store int")
    assert rows(J.key_translate(f, lookup, "cust", "store"), "id", "store") == [(1, 50), (2, None)]
