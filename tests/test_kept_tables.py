"""Tables kept in versions: by key, and month snapshots; canonical SKUs."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hangtally.operators import skus
from hangtally.operators import snapshots as SN
from hangtally.operators import stock as ST
from hangtally.operators.outstanding import refresh_outstanding
from hangtally.operators.upsert import merge_upsert, merge_upsert_columns
from hangtally.sources.keyed import KeyedTable
from hangtally.sources.versions import Versions

SCHEMA = "id bigint, name string, seen date"


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def kept(spark, path, data):
    table = KeyedTable(spark, str(path), SCHEMA, ["id"], "seen", 8)
    table.create(spark.createDataFrame(data, SCHEMA))
    return table


def test_upsert_touches_only_its_buckets(spark, rows, tmp_path):
    old = [(k, f"n{k}", day(k)) for k in range(100)] + [(None, "none", None)]
    table = kept(spark, tmp_path, old)
    assert table.marks() == ("2024-01-01", "2024-04-09")
    before = {e["part"]: e["path"] for e in table.versions.current()[1]}
    change = spark.createDataFrame([(3, "new", day(200)), (3, "aaa", day(1)), (1000, None, day(5))], SCHEMA)
    want = rows(merge_upsert(spark.createDataFrame(old, SCHEMA), change, ["id"]))
    touched = table.upsert(change)
    after = {e["part"]: e["path"] for e in table.versions.current()[1]}
    assert len(touched) <= 2 < len(before) and all((before[p] == after[p]) == (p not in touched) for p in before)
    assert rows(table.rows()) == want and table.marks()[1] == "2024-07-19"
    table.upsert(change)   # twice is once
    assert rows(table.rows()) == want
    some = spark.createDataFrame([(4, "x"), (2000, "y")], "id bigint, name string")
    want = rows(merge_upsert_columns(table.rows(), some, ["id"], ["name"]))
    table.upsert(some, ["name"])
    assert rows(table.rows()) == want
    number = table.versions.current()[0]
    assert table.upsert(change.limit(0)) == [] and table.versions.current()[0] == number
    with pytest.raises(ValueError, match="unknown columns"):
        table.upsert(change.withColumn("more", F.lit(1)))


def test_run_that_ends_before_the_list_changes_nothing(spark, rows, tmp_path, monkeypatch):
    table = kept(spark, tmp_path, [(k, "a", day(k)) for k in range(30)])
    before, change = rows(table.rows()), spark.createDataFrame([(k, "b", day(k)) for k in range(10)], SCHEMA)
    monkeypatch.setattr(table.versions, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.upsert(change)
    monkeypatch.undo()
    assert rows(table.rows()) == before
    table.upsert(change)
    assert rows(table.rows(), "id", "name") == sorted([(k, "b" if k < 10 else "a") for k in range(30)], key=lambda t: tuple((v is None, str(v)) for v in t))


def test_second_writer_of_one_list_fails(spark, tmp_path):
    table = Versions(spark, str(tmp_path), "id bigint", "part")
    number, entries = table.current()
    new = table.write(spark.createDataFrame([(1, "a")], "id bigint, part string"))
    table.commit(number, new)
    with pytest.raises(AnalysisException):
        table.commit(number, new)
    assert [e["rows"] for e in table.current()[1]] == [1] and table.read([]).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_refresh_equals_the_plain_one(spark, rows, tmp_path, seed):
    r = random.Random(seed)
    old = [(k, "old", day(r.randint(10, 40))) for k in range(80)]
    source = [(k, "new", d) for k, _, d in old if r.random() < 0.8] + [(100 + k, "new", day(r.randint(0, 60))) for k in range(40)]
    table, src = kept(spark, tmp_path, old), spark.createDataFrame(source, SCHEMA)
    want = rows(refresh_outstanding(src, spark.createDataFrame(old, SCHEMA), "id", "seen"))
    table.refresh(src)
    assert rows(table.rows()) == want
    table.refresh(src)
    assert rows(table.rows(), "id") == [(r[0],) for r in want]


def test_refresh_of_an_empty_table(spark, rows, tmp_path):
    table = kept(spark, tmp_path, [])
    assert table.marks() == (None, None)
    table.refresh(spark.createDataFrame([(1, "a", day(1))], SCHEMA))
    assert rows(table.rows(), "id") == [(1,)]


# ---- snapshots ---------------------------------------------------------------------

ENDS = [f"2024-0{m}-{d}" for m, d in ((1, 31), (2, 29), (3, 31), (4, 30), (5, 31))]


def stock_sources(spark, seed):
    r = random.Random(seed)
    d = lambda: dt.date(2023, 12, 1) + dt.timedelta(days=r.randint(0, 180))
    moves = [(r.randint(1, 8), r.randint(1, 5), d(), float(r.randint(-5, 9))) for _ in range(600)]
    counts = [(s, k, day_, q, "T" if r.random() < 0.5 else "X") for s in (1, 2, 3, 4, 8) for day_ in (d(), d()) for k in (1, 2)
              for q in ([0.0] if s == 3 else [float(r.randint(0, 9))])]
    opens = [(s, r.randint(1, 5), d(), 3.0) for s in (2, 3, 5, 6) for _ in range(4)]
    stores = [(s, "T" if s in (4, 8) else "F", s % 2 == 0) for s in range(1, 10)]
    ledger = spark.createDataFrame(moves, "store_id bigint, sku bigint, move_date date, qty double").withColumn("month", F.date_format("move_date", "yyyy-MM"))
    return SN.Sources(spark.createDataFrame(counts, "store_id bigint, sku bigint, count_date date, qty double, status string"),
                      spark.createDataFrame(opens, "store_id bigint, sku bigint, inject_date date, qty double"), ledger,
                      spark.createDataFrame(stores, "store_id bigint, hold string, consigned boolean"))


@pytest.mark.parametrize("seed", range(2))
def test_snapshots_built_advanced_and_corrected_agree(spark, rows, tmp_path, seed):
    src = stock_sources(spark, seed)
    want = rows(ST.stock_at(src.counts, src.openings, src.ledger, src.stores, "2024-06-30", ENDS, []).drop("label"), "store_id", "sku", "end_date", "qty")
    late = (F.col("sku") == 2) & (F.col("move_date").between("2024-02-10", "2024-02-25"))
    early = SN.Sources(src.counts, src.openings, src.ledger.where(~late), src.stores)
    table = SN.MonthSnapshots(spark, str(tmp_path))
    table.build(early, "2024-06-30", ENDS[:2])
    for e in ENDS[2:]:
        table.advance(early, "2024-06-30", e)
    before = {x["part"]: x["path"] for x in table.months.current()[1]}
    written = table.late(src.ledger.where(late))
    after = {x["part"]: x["path"] for x in table.months.current()[1]}
    assert rows(table.read(), "store_id", "sku", "end_date", "qty") == want and table.ends() == ENDS
    assert "2024-01-31" not in written and all((before[e] == after[e]) == (e not in written) for e in ENDS)
    assert table.late(src.ledger.where("false")) == []


def test_snapshots_refuse_open_months_and_gaps_in_order(spark, tmp_path):
    src, table = stock_sources(spark, 9), SN.MonthSnapshots(spark, str(tmp_path))
    with pytest.raises(ValueError, match="not over"):
        table.build(src, "2024-01-15", ENDS[:1])
    table.build(src, "2024-06-30", ENDS[:2])
    with pytest.raises(ValueError, match="does not follow"):
        table.advance(src, "2024-06-30", ENDS[1])


# ---- canonical SKUs --------------------------------------------------------------------

def test_spellings_of_one_sku_are_one_number(spark, rows):
    texts = ["SKU7", "sku7", " Sku7 ", "bbrd103v042333-", "BBRD103V042333", None, "nobody", "NOBODY"]
    articles = spark.createDataFrame([("SKU7", 7), ("BBRD103V042333", 1), ("SKU7", 9)], "code string, sku bigint")
    df = spark.createDataFrame([(t, float(k)) for k, t in enumerate(texts)], "sku_text string, qty double")
    dictionary = skus.sku_dictionary([df.select("sku_text"), df.select("sku_text")], articles)
    got = dict((int(r["qty"]), r["sku"]) for r in skus.numbered(df, dictionary).collect())
    assert [got[k] for k in range(6)] == [7, 7, 7, 1, 1, None] and got[6] == got[7] < 0
    assert dictionary.count() == 7


def test_stock_paths_meet_one_number_per_sku(spark):
    from hangtally.sources.standins import Standins
    s = Standins(spark, "/root/testdata/sf0.001")
    texts = s.movement_text.select("sku_text").distinct().count()
    assert texts > 2 * s.movement.select("sku").distinct().count()   # spelled in several ways
    for given, made in ((s.movement, s.ledger), (s.stock_count, s.counted), (s.opening_balance, s.opened)):
        sums = lambda df: sorted(map(tuple, df.groupBy("store_id", "sku").agg(F.sum("qty")).collect()))
        assert sums(given) == sums(made)
