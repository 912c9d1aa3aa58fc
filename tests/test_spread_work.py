"""Crowded keys: bands, numbers, models."""

import bisect
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hangtally.operators import forecast as FC
from hangtally.operators import joins as J
from hangtally.operators import numbering as N
from hangtally.sources import readers as RD

BASE = dt.date(2020, 1, 1)


def d(n):
    return BASE + dt.timedelta(days=n)


def test_many_bands_of_one_key(spark):
    r = random.Random(1)
    bands = []
    for k in range(100_000):
        begin = r.randint(0, 1500)
        bands.append((1, d(begin), d(begin + min(r.randint(0, 60), 1500)), k % 977))
    bands += [(1, None, d(40), 5000), (1, d(1400), None, 6000), (2, None, None, 7), (2, None, None, 8), (None, d(0), d(9), 1)]
    facts = [(n, 1, d(n - 30)) for n in range(0, 1700, 7)] + [(9000, 2, d(-9999)), (9001, 2, d(9999)), (9002, 3, d(0)), (9003, 1, None)]
    f = spark.createDataFrame(facts, "id int, k int, day date")
    b = spark.createDataFrame(bands, "k int, b date, e date, v int").repartition(8)
    joined = J.interval_join(f, b, ["k"], "day", "b", "e", "v", "margin")
    assert "collect_set" not in joined._jdf.queryExecution().toString()
    got = {x["id"]: x["margin"] for x in joined.collect()}
    own = sorted((x[1] or dt.date.min, x[2] or dt.date.max, x[3]) for x in bands if x[0] == 1)
    begins = [x[0] for x in own]
    for i, k, day in facts[:-4]:
        active = [x for x in own[:bisect.bisect_right(begins, day)] if x[1] >= day]
        latest = max((x[0] for x in active), default=None)
        assert got[i] == min((x[2] for x in active if x[0] == latest), default=None)
    assert [got[i] for i in range(9000, 9004)] == [7, 7, None, None] and len(got) == len(facts)


def test_one_far_id_leaves_the_rest_spread(spark):
    df = spark.range(0, 200_000, numPartitions=8).withColumn("k", F.lit("a")).union(spark.createDataFrame([(9 * 10 ** 18, "a")], "id long, k string"))
    out = N.number_rows(df, ["k"], "id", "n")
    facts = out.agg(F.count("*"), F.min("n"), F.max("n"), F.count_if(F.expr("n <> id + 1")), F.count_distinct("n")).first()
    assert tuple(facts) == (200_001, 1, 200_001, 1, 200_001)


def test_a_million_equal_ids_run_in_many_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 1_000_000, numPartitions=8).select(F.lit(7).alias("id"), F.col("id").alias("row"), F.lit(None).cast("string").alias("k"))
        out = N.number_rows(df, ["k"], "id", "n")
        assert out.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (1_000_000, 1, 1_000_000)
        spread = df.withColumn("_h", F.xxhash64(*df.columns)).repartitionByRange("k", "id", "_h").groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in spread) < 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.fixture(scope="module")
def demand(spark):
    r = random.Random(6)
    rows = []
    for year in (1, 2):
        for _ in range(400):
            c, p, m = r.choice("abc" if year == 1 else "abcd"), float(r.randint(1, 50)), r.randint(1, 12)
            rows.append((year, m, c, p, 3.0 * p + {"a": 0, "b": 40, "c": -25, "d": 0}[c] + r.gauss(0, 2)))
    return spark.createDataFrame(rows, "year int, month int, c string, p double, qty double")


def test_features_are_the_non_zero_ones(demand):
    long = FC.demand_features(demand.where("year = 1"), ["month"], ["c"], ["p"])
    counted = {x["feature"]: x["count"] for x in long.groupBy("feature").count().collect()}
    by_level = {x["c"]: x["count"] for x in demand.where("year = 1").groupBy("c").count().collect()}
    assert counted == {"c=b": by_level["b"], "c=c": by_level["c"], "p": 400}


def test_coefficients_solve_the_normal_equations(spark, demand):
    train = demand.where("year = 1")
    coefficient = {x["feature"]: x["coefficient"] for x in FC.linear_coefficients(spark, train, ["c"], ["p", "month"], "qty").collect()}
    product = {}
    for x in FC.normal_equations(train, ["c"], ["p", "month"], "qty").collect():
        product[x["feature"], x["other"]] = product[x["other"], x["feature"]] = x["product"]
    names = sorted(coefficient)
    for a in names:   # the residual is at right angles to every feature
        left = product.get((a, "label"), 0.0) - sum(coefficient[b] * product.get((a, b), 0.0) for b in names)
        assert abs(left) < 1e-3 * abs(product[a, "label"])
    solved = np.linalg.solve([[product.get((a, b), 0.0) for b in names] for a in names], [product[a, "label"] for a in names])
    assert solved == pytest.approx([coefficient[a] for a in names], rel=1e-3, abs=0.05)


def test_forecast_beats_the_mean_and_knows_no_new_levels(demand):
    predicted, mae = FC.boosted_forecast(demand, ["c"], ["p", "month"], "qty", "year", 1)
    rows = FC.forecast_rows(demand, ["month", "c"], ["c"], "qty", "year", 1).collect()
    assert len(rows) == predicted.count() == 400 and {r["train_rows"] for r in rows} == {400}
    assert all(r["unseen_levels"] == (r["c"] == "d") for r in rows) and any(r["unseen_levels"] for r in rows)
    assert mae < 0.3 * sum(r["mean_error"] for r in rows) / len(rows)


def test_jdbc_reader_slices_the_table(monkeypatch):
    given = {}

    class Reader:
        def format(self, name):
            given["format"] = name
            return self

        def options(self, **more):
            given.update(more)
            return self

        def option(self, key, value):
            given[key] = value
            return self

        def load(self):
            return given

    class Session:
        read = Reader()

    got = RD.read_jdbc(Session(), "jdbc:x://h/db", "lines", "id", "1", "1000", 8, {"fetchsize": "5000"})
    assert got == {"format": "jdbc", "fetchsize": "5000", "url": "jdbc:x://h/db", "dbtable": "lines", "partitionColumn": "id",
                   "lowerBound": "1", "upperBound": "1000", "numPartitions": 8}
