"""Every query with an SQL twin against DuckDB, and the driver's entry points."""

import pytest

import __spark_entry__ as entry_module
from compare import connect, differences
from riskfeat.plans.model import GBT_PARAMS, TREE_PARAMS
from riskfeat.plans.oracle import ORACLE
from riskfeat.plans.queries import QUERIES, Tables

SF = "/root/testdata/sf0.001"
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin_or_is_known_to_have_none():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(name, tables, con, monkeypatch):
    monkeypatch.setitem(GBT_PARAMS, "maxIter", 5)  # what is compared holds for any fit
    monkeypatch.setitem(TREE_PARAMS, "trees", 5)
    assert differences(QUERIES[name](tables), con, ORACLE[name]) == []


def test_entry_reports_the_three_splits_in_time_order(spark):
    got = [tuple(r) for r in entry_module.entry(spark).collect()]
    assert [r[0] for r in got] == ["TRAIN", "VAL", "TEST"]
    assert all(r[1] > 0 for r in got)


def test_sketch_features_agree_with_exact_ones_on_small_windows(tables, con):
    got = {r["account_id"]: r for r in QUERIES["stream_velocity_distinct"](tables).collect()}
    exact = con.execute(
        """SELECT CAST(user_id AS VARCHAR), count(DISTINCT event_type),
                  count(DISTINCT json_extract_string(props, '$.k'))
           FROM events WHERE date_trunc('hour', ts) >
                (SELECT date_trunc('hour', max(ts)) - INTERVAL 24 HOUR FROM events)
           GROUP BY 1"""
    ).fetchall()
    assert exact
    for account, banks, receivers in exact:
        assert got[account]["distinct_banks_24h"] == banks
        assert got[account]["distinct_receivers_24h"] == receivers
