"""Plan shapes that matter at scale."""

import re
from pathlib import Path

import pytest

from hangtally.catalog import QUERIES
from hangtally.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
RUNS_JOBS = {"month_snapshot_chain", "demand_features", "demand_linear_coefficients", "demand_forecast", "intraday_ledger_stream", "snapshot_files_union"}


def plan(spark, name, mode="simple"):
    df = QUERIES[name](spark, FOLDER)
    return df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in RUNS_JOBS])
def test_no_python_no_pair_joins(spark, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|MapInPandas", plan(spark, name))


@pytest.mark.parametrize("name,want", [
    ("scan_year_partition", "GreaterThanOrEqual(o_orderdate"), ("union_years", "LessThan(l_shipdate"),
    ("sales_window_sum", "GreaterThanOrEqual(l_shipdate"), ("returns_by_year", "EqualTo(l_returnflag,R)"),
    ("warehouse_counts", "EqualTo(l_linestatus,F)")])
def test_filters_reach_the_scan(spark, name, want):
    assert want in plan(spark, name, "formatted")


def test_columns_are_pruned(spark):
    read = re.search(r"ReadSchema: (struct<.*?>)", plan(spark, "union_years", "formatted")).group(1)
    assert read == "struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>"


@pytest.mark.parametrize("name", ["size_pivot", "size_run_status", "ledger_net"])
def test_one_shuffle_and_hash_aggregate(spark, name):
    text = plan(spark, name)
    assert len(re.findall("Exchange hashpartitioning", text)) == 1 and "SortAggregate" not in text


@pytest.mark.parametrize("name,most", [
    ("stock_at_month_end", 0), ("ledger_range_by_store", 0), ("stock_on_date", 0), ("free_stock", 1), ("incremental_outstanding", 0), ("sell_through_table", 1),
    ("article_size_report_store", 0), ("article_size_report_total", 0), ("stock_detail", 3), ("return_candidates", 3), ("category_summary", 3),
    ("stock_mobile", 2), ("stock_future", 2)])
def test_line_table_is_scanned_few_times(spark, name, most):
    assert len(re.findall(r"FileScan[^\n]*lineitem", plan(spark, name))) <= most


def test_marts_shuffle_few_times(spark):
    assert len(re.findall("Exchange hashpartitioning", plan(spark, "sales_mart"))) <= 10


@pytest.mark.parametrize("name", ["stock_at_month_end", "ledger_range_by_store"])
def test_windows_prune_the_months_of_the_ledger(spark, name):
    scan = next(x for x in plan(spark, name, "formatted").split("\n\n") if "PartitionFilters" in x and "month" in x)
    assert "dynamicpruning" in scan


def test_facts_of_the_margin_joins_are_not_shuffled_for_small_rates(spark):
    text = plan(spark, "asof_margin")
    facts = text[:text.index("FileScan")]   # above the first leaf: both joins (closed and open spans), no exchange
    assert facts.count("BroadcastHashJoin") == 2 and facts.count("LeftOuter") == 2 and "Exchange" not in facts


def test_no_forced_broadcasts_and_no_driver_collects():
    root = Path(__file__).resolve().parent.parent / "hangtally"
    for p in root.rglob("*.py"):
        if p.parent.name == "llm":   # bounded fits; it has tests of its own
            continue
        text = p.read_text()
        listed = [] if p.name == "versions.py" else [".collect()"]   # its lists have one row per part
        for word in ("broadcast(", *listed, ".toPandas(", ".toLocalIterator(", "localCheckpoint", "crossJoin", "@F.udf", "pandas_udf"):
            assert word not in text, f"{word} in {p}"


def test_scratch_path_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(named) and scratch_path(spark, "x") != scratch_path(spark, "x")
