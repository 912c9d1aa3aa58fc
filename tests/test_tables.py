import datetime as dt
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hangtally.operators import aggregates as A
from hangtally.operators import master as M
from hangtally.operators import numbering as N
from hangtally.operators import outstanding as O
from hangtally.operators import quality as Q
from hangtally.operators import sales as S
from hangtally.operators.upsert import merge_upsert, merge_upsert_columns
from hangtally.sources import readers as R
from hangtally.sources import sinks as W

T = "id int, a string, b double"


def test_upsert_rules(spark, rows):
    old = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], T)
    new = spark.createDataFrame([(2, None, 5.0), (3, "z", 3.0), (3, "a", 9.0)], T)
    once = merge_upsert(old, new, ["id"])
    assert rows(once) == [(1, "x", 1.0), (2, None, 5.0), (3, "z", 3.0)]
    assert rows(merge_upsert(once, new, ["id"])) == rows(once)
    assert rows(merge_upsert(old, new.limit(0), ["id"])) == rows(old)
    with pytest.raises(ValueError):
        merge_upsert(old, new.withColumn("c", F.lit(1)), ["id"])


def test_upsert_of_some_columns(spark, rows):
    old = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], T)
    new = spark.createDataFrame([(2, None), (3, "z")], "id int, a string")
    want = [(1, "x", 1.0), (2, None, 2.0), (3, "z", None)]
    assert rows(merge_upsert_columns(old, new, ["id"], ["a"])) == want
    assert rows(merge_upsert(old, new, ["id"])) == want


pairs = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, pairs)
def test_upsert_twice_is_once(spark, old, new):
    t = spark.createDataFrame(list(dict(old).items()), "id int, v int")
    s = spark.createDataFrame(new, "id int, v int")
    once = merge_upsert(t, s, ["id"])
    want = dict(old) | {k: max(v for kk, v in new if kk == k) for k, _ in new}
    assert dict((r.id, r.v) for r in once.collect()) == want
    assert dict((r.id, r.v) for r in merge_upsert(once, s, ["id"]).collect()) == want


def test_upsert_to_new_path(spark, rows, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    spark.createDataFrame([(1, "x", 1.0)], T).write.parquet(old)
    src = spark.createDataFrame([(1, "y", 1.0)], T)
    assert rows(W.upsert_to(spark, old, new, src, ["id"])) == [(1, "y", 1.0)]
    assert rows(spark.read.parquet(old)) == [(1, "x", 1.0)]
    assert rows(W.upsert_to(spark, old, str(tmp_path / "v3"), src.limit(0), ["id"])) == [(1, "x", 1.0)]
    assert not (tmp_path / "v3").exists()
    with pytest.raises(ValueError):
        W.upsert_to(spark, old, old, src, ["id"])


def test_csv_source_and_exports(spark, rows, tmp_path):
    df = spark.createDataFrame([(i, dt.date(2024, 1 + i % 3, 1), float(i)) for i in range(30)], "id int, day date, v double")
    W.export_by_month(df, "day", str(tmp_path / "months"))
    assert sorted(p.name for p in (tmp_path / "months" / "year=2024").iterdir()) == ["month=1", "month=2", "month=3"]
    W.export_in_parts(df.coalesce(1), str(tmp_path / "parts"), 7)
    files = list((tmp_path / "parts").glob("*.csv"))
    assert len(files) == 5 and max(len(f.read_text().splitlines()) for f in files) == 8
    back = R.read_csv(spark, str(tmp_path / "parts"), "id int, day date, v double")
    assert rows(back) == rows(df)
    W.overwrite(df, str(tmp_path / "one"), str(tmp_path / "two"))
    assert rows(spark.read.parquet(str(tmp_path / "one"))) == rows(spark.read.parquet(str(tmp_path / "two"))) == rows(df)


def test_year_partition_reads_one_folder(spark, tmp_path):
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, year int")
    W.overwrite(df, str(tmp_path / "t"), partition_by=["year"])
    one = R.read_year(spark, str(tmp_path / "t"), 2024)
    assert [r.id for r in one.collect()] == [2]
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()


def test_snapshots_are_read_once_each(spark, rows, tmp_path):
    for label, q in (("jan_24", 1.0), ("feb_24", 2.0), ("jan_25", 4.0)):
        spark.createDataFrame([(1, "A", q), (1, "A", q)], "store_id int, sku string, qty double").write.parquet(
            f"{tmp_path}/s/label={label}")
    labels = R.snapshot_labels(2023, 2024)
    assert labels.count("jan_24") == 1 and labels[-1] == "jan_25"
    assert rows(R.read_snapshots(spark, f"{tmp_path}/s", labels), "label", "qty") == [("feb_24", 4.0), ("jan_24", 2.0), ("jan_25", 8.0)]
    paths = []
    for m, q in (("jan", 1.0), ("feb", 2.0)):
        paths.append(f"{tmp_path}/f_{m}")
        spark.createDataFrame([(1, "A", q, "2024")], f"store_id int, sku string, stock_{m} double, note string").write.parquet(paths[-1])
    assert rows(R.read_snapshot_files(spark, [*paths, paths[0]]), "stock_jan", "stock_feb") == [(1.0, 2.0)]


def test_number_rows_in_small_ranges(spark, rows):
    df = spark.createDataFrame([(k, i * 3) for i in range(200) for k in (None, "a", "b") if (i + len(k or "")) % 3], "k string, id int")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("long"))
    assert rows(N.number_rows(df, ["k"], "id", "n")) == rows(want)


def test_suffix_and_fill(spark, rows):
    df = spark.createDataFrame([(1, "x", None), (2, "x", 5), (3, "y", None), (4, "x", None)], "id int, code string, store int")
    assert rows(N.running_suffix(df, "code", "id", "code"), "id", "code") == [(1, "x"), (2, "x2"), (3, "y"), (4, "x3")]
    assert rows(N.sequence_fill(df, "store", "id", 9000), "id", "store") == [(1, 9000), (2, 5), (3, 9001), (4, 9002)]


def test_sum_first_skips_nulls(spark, rows):
    df = spark.createDataFrame([(1, 2, None, 1.0), (1, 1, None, 2.0), (1, 3, "b", 3.0), (1, 4, "c", 4.0), (None, 1, "z", 9.0)],
                               "k int, line int, t string, q double")
    got = A.sum_first(df, ["k"], ["q"], ["t"], [F.col("line")], carried=["line"])
    assert rows(got, "k", "q", "t", "line") == [(1, 10.0, "b", 1)]


def test_mode_takes_the_smallest_on_ties(spark, rows):
    df = spark.createDataFrame([(1, 30), (1, 20), (1, 20), (1, 30), (2, 5), (2, None), (2, None)], "k int, v int")
    assert rows(A.modal_value(df, ["k"], "v", "m")) == [(1, 20), (2, 5)]


def test_key_checks(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    assert rows(A.key_violations(df, ["id"]), "id", "problem") == [(1, "duplicate"), (None, "null key")]
    assert rows(A.orphans(df, spark.createDataFrame([(1,)], "id int"), "id")) == [(2, 1)]


def test_allocation_guards(spark):
    cuts = spark.createDataFrame([(1, 100.0), (2, 50.0), (4, 0.0)], "doc_id int, cut double")
    charges = spark.createDataFrame([(1, 10.0, 0.0, 3.0, 10.0)], "doc_id int, service_fee double, premium double, affiliate double, voucher double")
    lines = spark.createDataFrame([(1, 3.0), (2, 0.0)], "doc_id int, qty double")
    got = {r.doc_id: (r.unit_cut, r.unit_service_fee, r.unit_voucher) for r in S.discount_allocation(cuts, charges, lines).collect()}
    assert got == {1: (33.33, 3.33, 10 / 3), 2: (0.0, 0.0, 0.0), 4: (0.0, 0.0, 0.0)}


def test_outstanding_refresh_is_stable(spark, rows):
    cols = "pk_id string, qty double, t int"
    stored = spark.createDataFrame([("a", 1.0, 1), ("b", 1.0, 5), ("c", 1.0, 9)], cols)
    source = spark.createDataFrame([("a", 1.0, 1), ("c", 1.0, 9), ("d", 2.0, 12)], cols)
    once = O.refresh_outstanding(source, stored, "pk_id", "t")
    assert rows(once, "pk_id") == [("a",), ("c",), ("d",)]
    assert rows(O.refresh_outstanding(source, once, "pk_id", "t")) == rows(once)
    assert rows(O.newer_than_mark(source, stored.limit(0), "t"), "pk_id") == [("a",), ("c",), ("d",)]


def test_comparison(spark, rows):
    a = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "k", 3.0)], T)
    b = spark.createDataFrame([(1, "y", 1.05), (2, None, 2.5), (4, "n", 4.0)], T)
    d = Q.cell_diff(a, b, ["id"], ["a", "b"])
    gap, status = Q.tolerance_status("left_value", "right_value")
    got = rows(d.withColumn("s", status), "id", "column_name", "s")
    assert got == [(1, "a", "OK"), (1, "b", "OK"), (2, "b", "Not OK"), (3, "a", "OK"), (3, "b", "OK"), (4, "a", "OK"), (4, "b", "OK")]
    assert rows(Q.keyed_compare(a, b, ["id"], ["b"])) == [(1, 1.0, 1.05), (2, 2.0, 2.5)]
    assert d.limit(0).count() == 0 and Q.cell_diff(a, a, ["id"], ["a", "b"]).count() == 0


def test_fill_from_siblings_keeps_the_row_count(spark, rows):
    df = spark.createDataFrame([(1, "n", None, "s"), (2, "n", "f", "s"), (3, "n", "g", "t"), (4, None, None, None)],
                               "id int, name string, fit string, st string")
    assert rows(Q.fill_from_siblings(df, "name", ["fit", "st"]), "id", "fit", "st") == [(1, "g", "s"), (2, "f", "s"), (3, "g", "t"), (4, None, None)]


def test_naming_rule(spark):
    df = spark.createDataFrame([(1, "x", 1.239, dt.date(2024, 1, 1))], "fn_id long, name string, fm_price double, fd_day date")
    assert Q.prefix_names(df.drop("fm_price")).columns == ["fn_id", "fv_name", "fd_day"]
    assert Q.schema_by_prefix(df).dtypes == [("fn_id", "int"), ("name", "string"), ("fm_price", "decimal(15,2)"), ("fd_day", "timestamp_ntz")]


def test_store_master_keeps_all_customers(spark, rows):
    wh = spark.createDataFrame([(7, 1), (8, 99)], "store_id int, cust_id int")
    cus = spark.createDataFrame([(1, "a"), (2, "b")], "cust_id int, name string")
    assert rows(M.store_master(wh, cus), "cust_id", "store_id") == [(1, 7), (2, None)]


def test_no_personal_names_or_secrets():
    text = "".join(p.read_text() for p in Path(__file__).resolve().parent.parent.glob("hangtally/**/*.py"))
    assert "password" not in text.lower()
