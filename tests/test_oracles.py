"""Every registered query against its SQL on the smallest data."""

import pytest
from compare import compare, connect

from hangtally.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {"demand_linear_coefficients", "demand_forecast"}
MAY_BE_EMPTY = {"ledger_extract"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql_or_is_a_model():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    problems = compare(spark, duck, FOLDER, name, QUERIES[name], ORACLES.get(name))
    if problems == ["no rows"] and name in MAY_BE_EMPTY:   # both sides are empty on so little data
        problems = []
    assert not problems


@pytest.mark.parametrize("name, order", [
    ("sort_report", lambda r: r["store_name"]), ("top_n_frequency", lambda r: (-r["n"], r["sku"])), ("value_frequency", lambda r: -r["n"]),
    ("category_summary", lambda r: -r["sales_contrib"])])
def test_sorted_reports_come_in_order(spark, name, order):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert len(rows) > 1 and [order(r) for r in rows] == sorted(order(r) for r in rows)
