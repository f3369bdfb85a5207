import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskfeat import schemas as S
from riskfeat.functions import columns as C
from riskfeat.operators import curate

ACCOUNTS = [
    ("France Bank #12", "012", "A1", "E1", "Corporation #33"),
    ("Crytpo Bank #7", "007", "A2", "E2", "Sole Proprietorship #9"),
    ("First Community Bank", "100", "A3", "E3", "Partnership"),
    (None, "101", "A4", "E4", None),
    ("Zed Bank #1", "012", "A5", "E5", "Individual #5 #6"),
]


def txn(stamp, fb, fa, tb, ta, amount, fmt="Wire", pay="USD", recv="USD", label=0):
    return (stamp, fb, fa, tb, ta, amount, recv, amount, pay, fmt, label)


@pytest.fixture
def accounts(spark):
    return spark.createDataFrame(ACCOUNTS, S.ACCOUNT_SCHEMA)


@pytest.fixture
def banks(accounts):
    return curate.bank_dim(accounts)


def test_bank_country_rules(banks, rows):
    assert rows(banks, "bank_id", "bank_country") == [
        ("007", "CRYPTO"),
        ("012", "FRANCE"),
        ("100", "US"),
        ("101", "US"),
    ]


def test_account_dim_strips_only_the_last_number(accounts, banks, rows):
    got = rows(curate.account_dim(accounts, banks), "account_id", "bank_country", "entity_type")
    assert ("012_A5", "FRANCE", "Individual #5") in got
    assert ("012_A1", "FRANCE", "Corporation") in got
    assert ("100_A3", "US", "Partnership") in got
    assert ("101_A4", "US", None) in got


@pytest.fixture
def events(spark, banks):
    txns = [
        txn("2022/09/01 00:10", "012", "A1", "007", "A2", 10.0, "Bitcoin", "EUR", "USD"),
        txn("2022/09/02 08:00", "012", "A1", "100", "A3", 30.0, "ACH"),
        txn("2022/09/10 23:59", "999", "X", "100", "A3", 5.0, "Cash", None, "USD"),
        txn("2022/09/11 00:00", "012", "A1", "100", "A3", 99.0),
        txn("2022/09/03 08:00", None, "A9", "999", "A3", 7.0, None, label=1),
    ]
    return curate.txn_events(spark.createDataFrame(txns, S.TXN_SCHEMA), banks)


def test_events_flags_countries_and_cutoff(events, rows):
    got = {r[0]: r[1:] for r in rows(
        events, "amount_paid", "account_id", "is_cross_currency", "is_cross_bank",
        "is_high_risk_format", "from_country", "to_country", "is_cross_border",
    )}
    assert set(got) == {10.0, 30.0, 5.0, 7.0}
    assert got[10.0] == ("012_A1", 1, 1, 1, "FRANCE", "CRYPTO", 1)
    assert got[30.0] == ("012_A1", 0, 1, 0, "FRANCE", "US", 1)
    # An unknown bank has no country but counts as US, and a NULL currency is no difference.
    assert got[5.0] == ("999_X", 0, 1, 1, None, "US", 0)
    # A NULL bank gives a NULL account and no flags.
    assert got[7.0] == (None, 0, 0, 0, None, None, 0)


def test_dimension_join_beyond_the_broadcast_limit_gives_the_same(spark, accounts, banks, rows, monkeypatch):
    expected = rows(curate.account_dim(accounts, banks))
    monkeypatch.setattr("riskfeat.operators.joins.fits_broadcast", lambda dim: False)
    assert rows(curate.account_dim(accounts, banks)) == expected


def test_history_of_single_payment_and_null_account(events, accounts, banks):
    owners = curate.account_dim(accounts, banks)
    got = {r["account_id"]: r for r in curate.account_history(events, owners).collect()}
    assert set(got) == {"012_A1", "999_X", None}
    one = got["999_X"]
    assert (one["hist_txn_count"], one["hist_std_amount"], one["entity_type"]) == (1, 0.0, None)
    busy = got["012_A1"]
    assert busy["hist_avg_amount"] == 20.0
    assert busy["hist_std_amount"] == pytest.approx(14.142135, abs=1e-5)
    assert busy["hist_distinct_receivers"] == 2
    assert busy["hist_distinct_countries"] == 2
    assert busy["hist_foreign_ccy_share"] == 0.5
    assert busy["last_activity_ts"] == dt.datetime(2022, 9, 2, 8)
    assert (busy["entity_type"], busy["home_country"]) == ("Corporation", "FRANCE")


def test_a_repeated_account_row_does_not_inflate_history(spark, events, accounts, banks, rows):
    owners = curate.account_dim(accounts, banks)
    twice = owners.unionByName(owners)
    assert rows(curate.account_history(events, twice)) == rows(curate.account_history(events, owners))


def test_approximate_history_has_the_same_columns(events, accounts, banks):
    owners = curate.account_dim(accounts, banks)
    exact, approx = curate.account_history(events, owners), curate.account_history(events, owners, approx=True)
    assert exact.columns == approx.columns
    assert approx.count() == exact.count()


def test_bad_timestamp_fails_the_load(spark, banks):
    txns = spark.createDataFrame([txn("01.09.2022", "012", "A1", "100", "A3", 1.0)], S.TXN_SCHEMA)
    with pytest.raises(PySparkException):
        curate.txn_events(txns, banks).collect()


def test_to_number_matches_what_counts_as_a_number(spark):
    texts = ["1", " 2.5 ", "1e3", "-4", "abc", "", None, "1d", "2F", "nan", "0x10", "inf"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["n"] for r in df.select("i", C.to_number(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got == [1.0, 2.5, 1000.0, -4.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, float("inf")]


def test_safe_div_and_json(spark):
    df = spark.createDataFrame([(1, 0, '{"a": "7"}'), (1, 4, "broken"), (1, None, None)], "x int, y int, j string")
    got = df.select(C.safe_div(F.col("x"), F.col("y")), C.json_number(F.col("j"), "$.a")).collect()
    assert [tuple(r) for r in got] == [(None, 7.0), (0.25, None), (None, None)]


def test_a_time_is_parsed_once(spark, banks):
    rows = [txn("2022/09/01 00:10", "012", "A1", "007", "A2", 10.0)]
    events = curate.txn_events(spark.createDataFrame(rows, S.TXN_SCHEMA), banks, "2022-09-11")
    assert events._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp(") == 1
