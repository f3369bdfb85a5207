"""DuckDB SQL that must return the same rows as the query of the same name."""

from __future__ import annotations

from riskfeat import schemas as S
from riskfeat.plans import queries as Q
from riskfeat.sources.fixture import CUTOFF

TXNS = """txns AS (
    SELECT strftime(o.o_orderdate + to_hours(CAST(l.l_orderkey % 24 AS INTEGER))
                    + to_minutes(CAST((l.l_linenumber * 7 + l.l_suppkey) % 60 AS INTEGER)),
                    '%Y/%m/%d %H:%M') AS txn_timestamp,
           CAST(c.c_nationkey AS VARCHAR) AS from_bank,
           'C' || c.c_custkey AS from_account,
           CAST(s.s_nationkey AS VARCHAR) AS to_bank,
           'S' || s.s_suppkey AS to_account,
           l.l_extendedprice * (1 - l.l_discount) AS amount_received,
           CAST(sn.n_regionkey AS VARCHAR) AS receiving_currency,
           l.l_extendedprice AS amount_paid,
           CAST(cn.n_regionkey AS VARCHAR) AS payment_currency,
           CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Wire' WHEN '2-HIGH' THEN 'Credit Card'
                WHEN '3-MEDIUM' THEN 'ACH' WHEN '4-NOT SPECIFIED' THEN 'Cash'
                ELSE 'Bitcoin' END AS payment_format,
           CASE WHEN l.l_returnflag = 'R' AND l.l_discount >= 0.10 AND l.l_quantity >= 45
                THEN 1 ELSE 0 END AS is_laundering,
           concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                     CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR),
                     CAST(l.l_extendedprice AS VARCHAR)) AS event_key,
           l.l_orderkey
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation cn ON c.c_nationkey = cn.n_nationkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation sn ON s.s_nationkey = sn.n_nationkey
)"""

ACCOUNTS = """accounts AS (
    SELECT CASE WHEN n_nationkey = 7 THEN 'Crytpo Bank #7'
                WHEN n_nationkey % 5 = 0 THEN 'First Community Bank'
                ELSE n_name || ' Bank #' || n_nationkey END AS bank_name,
           CAST(n_nationkey AS VARCHAR) AS bank_id, account_number, entity_id, entity_name
    FROM (
        SELECT c_nationkey AS home, 'C' || c_custkey AS account_number,
               CAST(c_custkey AS VARCHAR) AS entity_id, c_mktsegment || ' #' || c_custkey AS entity_name
        FROM customer
        UNION ALL
        SELECT s_nationkey, 'S' || s_suppkey, CAST(s_suppkey AS VARCHAR), 'Supplier #' || s_suppkey
        FROM supplier
    ) holders JOIN nation ON home = n_nationkey
)"""

BANKS = """banks AS (
    SELECT bank_id, bank_name,
           CASE country WHEN 'CRYTPO' THEN 'CRYPTO' WHEN '' THEN 'US' ELSE country END AS bank_country
    FROM (
        SELECT bank_id, bank_name,
               CASE WHEN regexp_full_match(bank_name, '.+ Bank #[0-9]+')
                    THEN upper(regexp_extract(bank_name, '^(.*) Bank #[0-9]+$', 1))
                    ELSE 'US' END AS country
        FROM (SELECT bank_id, min(bank_name) AS bank_name FROM accounts GROUP BY bank_id) named
    ) placed
)"""

OWNERS = r"""owners AS (
    SELECT a.bank_id || '_' || a.account_number AS account_id, a.bank_id, b.bank_country, a.entity_id,
           trim(regexp_replace(a.entity_name, '\s*#[0-9]+$', '')) AS entity_type
    FROM accounts a LEFT JOIN banks b ON a.bank_id = b.bank_id
)"""

EVENTS = f"""events_in AS (
    SELECT t.from_bank || '_' || t.from_account AS account_id,
           t.to_bank || '_' || t.to_account AS receiver_account_id,
           t.to_bank AS receiver_bank,
           strptime(t.txn_timestamp, '%Y/%m/%d %H:%M') AS event_ts,
           t.amount_paid, t.payment_currency, t.receiving_currency, t.payment_format,
           CAST(t.receiving_currency <> t.payment_currency AS INTEGER) AS is_cross_currency,
           CAST(t.from_bank <> t.to_bank AS INTEGER) AS is_cross_bank,
           CAST(t.payment_format IN ('Bitcoin', 'Wire', 'Cash') AS INTEGER) AS is_high_risk_format,
           f.bank_country AS from_country, r.bank_country AS to_country,
           CAST(coalesce(f.bank_country, 'US') <> coalesce(r.bank_country, 'US') AS INTEGER)
               AS is_cross_border,
           t.is_laundering, t.event_key
    FROM txns t
    LEFT JOIN banks f ON t.from_bank = f.bank_id
    LEFT JOIN banks r ON t.to_bank = r.bank_id
    WHERE strptime(t.txn_timestamp, '%Y/%m/%d %H:%M') < TIMESTAMP '{CUTOFF}'
)"""

HISTORY = """stats AS (
    SELECT account_id, count(*) AS hist_txn_count, avg(amount_paid) AS hist_avg_amount,
           coalesce(stddev_samp(amount_paid), 0) AS hist_std_amount,
           max(amount_paid) AS hist_max_amount,
           count(DISTINCT receiver_account_id) AS hist_distinct_receivers,
           count(DISTINCT receiver_bank) AS hist_distinct_receiver_banks,
           count(DISTINCT to_country) AS hist_distinct_countries,
           avg(is_cross_currency) AS hist_foreign_ccy_share,
           avg(is_high_risk_format) AS hist_high_risk_share,
           max(event_ts) AS last_activity_ts
    FROM events_in GROUP BY account_id
), history AS (
    SELECT s.*, o.entity_type, o.bank_country AS home_country
    FROM stats s LEFT JOIN owners o ON s.account_id = o.account_id
)"""

THRESHOLDS = """thresholds AS (
    SELECT quantile_cont(epoch(event_ts), 0.6) AS p_train, quantile_cont(epoch(event_ts), 0.8) AS p_val
    FROM events_in
)"""

ABT = """abt AS (
    SELECT e.account_id, e.event_ts, e.amount_paid, e.payment_currency, e.receiving_currency,
           e.payment_format, e.is_cross_currency, e.is_cross_border, e.is_high_risk_format,
           e.to_country, e.amount_paid / nullif(h.hist_avg_amount, 0) AS amount_to_avg_ratio,
           e.is_laundering,
           CASE WHEN epoch(e.event_ts) <= p_train THEN 'TRAIN'
                WHEN epoch(e.event_ts) <= p_val THEN 'VAL' ELSE 'TEST' END AS split,
           e.event_key
    FROM events_in e CROSS JOIN thresholds LEFT JOIN stats h ON e.account_id = h.account_id
)"""

RISK = """risk AS (
    SELECT account_id, hist_std_amount / nullif(hist_avg_amount, 0) AS hist_amount_cv,
           CAST(hist_distinct_receivers AS DOUBLE) / nullif(hist_txn_count, 0) AS hist_receiver_fanout
    FROM stats
)"""

# Sample the negatives by the order of their hash.
SAMPLE = f"""sample AS (
    SELECT event_key, account_id, split, is_laundering FROM (
        SELECT *, row_number() OVER (PARTITION BY is_laundering ORDER BY md5(event_key), event_key) AS place
        FROM abt
    ) ranked WHERE is_laundering = 1 OR place <= {Q.SAMPLE_NEGATIVES}
)"""

DAILY = """daily AS (
    SELECT account_id, max(event_ts) AS event_ts, count(*) AS day_txn_count,
           max(amount_paid) AS day_max_amount
    FROM events_in GROUP BY account_id, CAST(event_ts AS DATE)
)"""

PAYMENTS = """payments AS (
    SELECT event_id, CAST(user_id AS VARCHAR) AS account_id, ts AS event_ts, value AS amount_paid,
           json_extract_string(props, '$.k') AS receiver_account_id, event_type AS receiver_bank,
           CAST(event_type = 'error' AS BIGINT) AS is_cross_currency,
           CAST(event_type = 'purchase' AS BIGINT) AS is_high_risk_format
    FROM events
)"""

CURATED = [TXNS, ACCOUNTS, BANKS, OWNERS, EVENTS]
WITH_HISTORY = [*CURATED, HISTORY]
WITH_ABT = [*WITH_HISTORY, THRESHOLDS, ABT]

PROFILE_COLUMNS = """hist_txn_count, round(round(hist_avg_amount, 8), 4) AS hist_avg_amount,
    round(round(hist_std_amount, 8), 4) AS hist_std_amount, hist_max_amount, hist_distinct_receivers,
    hist_distinct_receiver_banks, hist_distinct_countries,
    round(round(hist_foreign_ccy_share, 8), 4) AS hist_foreign_ccy_share,
    round(round(hist_high_risk_share, 8), 4) AS hist_high_risk_share"""


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ", ".join(parts) + "\n" + select


def _feature(name: str) -> str:
    if name.startswith(S.ONE_HOT_PREFIX):
        code = name.removeprefix(S.ONE_HOT_PREFIX)
        return f"CAST(lower(replace(a.payment_format, ' ', '_')) = '{code}' AS DOUBLE)"
    if name in S.REQUEST_FEATURES:
        return f"coalesce(CAST(a.{name} AS DOUBLE), 0)"
    if name in S.PROFILE_FEATURES:
        return f"coalesce(CAST(h.{name} AS DOUBLE), 0)"
    if name in S.RISK_FEATURES:
        return f"coalesce(r.{name}, 0)"
    return "0"


def _scored(scorecard, source: str, name: str) -> list[str]:
    weights, intercept = scorecard
    z = " + ".join([str(intercept), *[f"{_feature(n)} * ({w})" for n, w in weights.items()]])
    return [
        f"""{name} AS (
    SELECT a.event_key, a.account_id, a.event_ts, a.payment_format, a.is_laundering AS label,
           round(1 / (1 + exp(-({z}))), 6) AS fraud_score
    FROM {source} a
    LEFT JOIN stats h ON a.account_id = h.account_id
    LEFT JOIN risk r ON a.account_id = r.account_id
)"""
    ]


TEST = ["test_rows AS (SELECT * FROM abt WHERE split = 'TEST')"]
SLICE = ["slice AS (SELECT * FROM abt WHERE event_ts >= (SELECT max(event_ts) FROM abt) - INTERVAL 1 DAY)"]
SCORED_TEST = [*WITH_ABT, RISK, *TEST, *_scored(Q.SCORECARD_V2, "test_rows", "scored")]
SCORED_SLICE = [*WITH_ABT, RISK, *SLICE, *_scored(Q.SCORECARD_V2, "slice", "scored")]


def _metrics(scored: str, name: str) -> list[str]:
    """Step metrics and the ranked recall of one scored set, as CTEs ending in ``name``."""
    return [
        f"""{name}_steps AS (
    SELECT fraud_score, count(*) AS n, sum(label) AS pos,
           sum(count(*)) OVER (ORDER BY fraud_score DESC) AS n_upto,
           sum(sum(label)) OVER (ORDER BY fraud_score DESC) AS pos_upto
    FROM {scored} GROUP BY fraud_score
)""",
        f"""{name}_ranked AS (
    SELECT label, row_number() OVER (ORDER BY fraud_score DESC, md5(event_key), event_key) AS place,
           count(*) OVER () AS total
    FROM {scored}
)""",
        f"""{name} AS (
    SELECT (SELECT sum(pos * CAST(pos_upto AS DOUBLE) / n_upto) / sum(pos) FROM {name}_steps) AS pr_auc,
           (SELECT sum((n - pos) * (pos_upto - pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos))
            FROM {name}_steps) AS roc_auc,
           (SELECT CAST(sum(CASE WHEN place <= greatest(1, floor(total * {S.RECALL_FRACTION}))
                                 THEN label ELSE 0 END) AS DOUBLE) / sum(label)
            FROM {name}_ranked) AS recall_at_k,
           (SELECT avg(label) FROM {scored}) AS base_rate
)""",
    ]


def _over(hours: int) -> str:
    return (
        "OVER (PARTITION BY account_id ORDER BY event_ts "
        f"RANGE BETWEEN INTERVAL {hours} HOUR PRECEDING AND CURRENT ROW)"
    )


def _score_matrix() -> str:
    codes = ["ach", "bitcoin", "cash", "credit_card", "wire"]
    names = [
        *S.REQUEST_FEATURES,
        *S.PROFILE_FEATURES,
        *S.RISK_FEATURES,
        *[S.ONE_HOT_PREFIX + c for c in codes],
    ]
    features = ", ".join(f"round(round({_feature(n)}, 8), 4) AS {n}" for n in names)
    return _with(
        [*WITH_ABT, RISK],
        f"""SELECT a.event_key, a.is_laundering, {features} FROM abt a
    LEFT JOIN stats h ON a.account_id = h.account_id
    LEFT JOIN risk r ON a.account_id = r.account_id""",
    )


def _asof(comparison: str) -> str:
    return _with(
        [*CURATED, DAILY],
        f"""SELECT e.event_key, e.account_id, e.event_ts, e.is_laundering, d.day_txn_count, d.day_max_amount
    FROM events_in e ASOF LEFT JOIN daily d
      ON e.account_id = d.account_id AND e.event_ts {comparison} d.event_ts""",
    )


TILES = """SELECT account_id, date_trunc('hour', event_ts) AS hour, count(amount_paid) AS count_amount_paid,
    round(sum(amount_paid), 4) AS sum_amount_paid,
    CAST(sum(is_cross_currency) AS BIGINT) AS sum_is_cross_currency,
    CAST(sum(is_high_risk_format) AS BIGINT) AS sum_is_high_risk_format
    FROM payments GROUP BY account_id, date_trunc('hour', event_ts)"""

ROLLED = """SELECT account_id, count(amount_paid) FILTER (WHERE age < 1) AS txn_count_1h,
           count(amount_paid) FILTER (WHERE age < 24) AS txn_count_24h,
           round(sum(amount_paid) FILTER (WHERE age < 24), 4) AS amt_sum_24h,
           round(sum(amount_paid) FILTER (WHERE age < 48), 4) AS amt_sum_48h,
           CAST(sum(is_cross_currency) FILTER (WHERE age < 24) AS BIGINT) AS cross_ccy_cnt_24h,
           CAST(sum(is_high_risk_format) FILTER (WHERE age < 24) AS BIGINT) AS high_risk_cnt_24h
    FROM (SELECT *, date_diff('hour', date_trunc('hour', event_ts),
                              (SELECT date_trunc('hour', max(event_ts)) FROM payments)) AS age
          FROM payments) aged
    WHERE age < 48 GROUP BY account_id"""

PREDICTIONS = "SELECT event_key, account_id, event_ts, payment_format, label, fraud_score"

VELOCITY = _with(
    [PAYMENTS],
    f"""SELECT event_id, account_id, event_ts, amount_paid,
       count(amount_paid) {_over(1)} AS txn_count_1h, count(amount_paid) {_over(24)} AS txn_count_24h,
       round(sum(amount_paid) {_over(24)}, 4) AS amt_sum_24h,
       round(sum(amount_paid) {_over(48)}, 4) AS amt_sum_48h,
       CAST(sum(is_cross_currency) {_over(24)} AS BIGINT) AS cross_ccy_cnt_24h,
       CAST(sum(is_high_risk_format) {_over(24)} AS BIGINT) AS high_risk_cnt_24h
    FROM payments""",
)

ORACLE: dict[str, str] = {
    "landing_transactions": _with([TXNS], "SELECT * EXCLUDE (event_key, l_orderkey) FROM txns"),
    "landing_accounts": _with([ACCOUNTS], "SELECT * FROM accounts"),
    **dict.fromkeys(("pattern_edges", "patterns_table"), _with(
        [TXNS],
        """SELECT dense_rank() OVER (ORDER BY l_orderkey) AS pattern_id,
           CASE l_orderkey % 4 WHEN 0 THEN 'FAN-OUT' WHEN 1 THEN 'FAN-IN' WHEN 2 THEN 'CYCLE'
                ELSE 'GATHER-SCATTER' END AS pattern_type,
           txn_timestamp AS event_ts, from_bank || '_' || from_account AS from_account_id,
           to_bank || '_' || to_account AS to_account_id, amount_paid, payment_currency
    FROM txns
    WHERE l_orderkey IN (SELECT l_orderkey FROM txns GROUP BY l_orderkey HAVING count(*) > 1)""",
    )),
    "readiness": "SELECT * FROM (VALUES ('view NEVER/V1'), ('model LAUNDERING_RISK/V1')) AS lacking(lacking)",
    "bank_dim": _with([ACCOUNTS, BANKS], "SELECT * FROM banks"),
    "account_dim": _with([ACCOUNTS, BANKS, OWNERS], "SELECT * FROM owners"),
    "txn_events": _with(CURATED, "SELECT * FROM events_in"),
    **dict.fromkeys(
        ("account_history", "history_incremental"),
        _with(
            WITH_HISTORY,
            f"SELECT account_id, {PROFILE_COLUMNS}, last_activity_ts, entity_type, home_country FROM history",
        ),
    ),
    "dup_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "split_thresholds": _with(
        [*CURATED, THRESHOLDS], "SELECT round(p_train, 3) AS p_train, round(p_val, 3) AS p_val FROM thresholds"
    ),
    "abt": _with(
        WITH_ABT,
        "SELECT * REPLACE (round(amount_to_avg_ratio, 6) AS amount_to_avg_ratio) FROM abt",
    ),
    "quality_report": _with(
        WITH_ABT,
        f"""SELECT count(*) AS n_events, CAST(sum(is_laundering) AS BIGINT) AS n_positives,
           min(event_ts) AS first_ts, max(event_ts) AS last_ts,
           (SELECT count(*) FROM abt) AS n_abt, (SELECT count(DISTINCT split) FROM abt) AS n_splits,
           max(event_ts) < TIMESTAMP '{CUTOFF}' AS tail_trimmed,
           CAST(5000 AS BIGINT) AS n_expected, count(*) >= 5000 AS rows_expected,
           count(*) = (SELECT count(*) FROM abt) AS rows_kept,
           (SELECT count(DISTINCT split) FROM abt) = 3 AS splits_complete
    FROM events_in""",
    ),
    "split_summary": _with(
        WITH_ABT,
        """SELECT split, count(*) AS n, CAST(sum(is_laundering) AS BIGINT) AS positives
    FROM abt GROUP BY split ORDER BY min(event_ts)""",
    ),
    "abt_totals": _with(
        WITH_ABT,
        """SELECT count(*) AS n, CAST(sum(is_laundering) AS BIGINT) AS positives,
           round(CAST(100.0 * sum(is_laundering) AS DOUBLE) / count(*), 3) AS positive_pct,
           count(DISTINCT split) AS n_splits
    FROM abt""",
    ),
    "class_balance": _with(
        CURATED,
        """SELECT count(*) AS n_txns, CAST(sum(is_laundering) AS BIGINT) AS n_laundering,
           round(CAST(100.0 * sum(is_laundering) AS DOUBLE) / count(*), 3) AS laundering_pct,
           min(event_ts) AS first_ts, max(event_ts) AS last_ts
    FROM events_in""",
    ),
    "rate_by_format": _with(
        CURATED,
        """SELECT payment_format, count(*) AS n, CAST(sum(is_laundering) AS BIGINT) AS fraud,
           round(CAST(100.0 * sum(is_laundering) AS DOUBLE) / count(*), 4) AS fraud_pct
    FROM events_in GROUP BY payment_format ORDER BY n DESC, payment_format""",
    ),
    "account_profile": _with(WITH_HISTORY, f"SELECT account_id, {PROFILE_COLUMNS} FROM stats"),
    "account_risk": _with(
        [*WITH_HISTORY, RISK],
        """SELECT account_id, round(round(hist_amount_cv, 8), 4) AS hist_amount_cv,
           round(round(hist_receiver_fanout, 8), 4) AS hist_receiver_fanout FROM risk""",
    ),
    "training_set": _with(
        [*WITH_ABT, RISK],
        f"""SELECT a.event_key, a.account_id, a.event_ts, a.split, a.is_laundering, {PROFILE_COLUMNS},
           round(round(r.hist_amount_cv, 8), 4) AS hist_amount_cv,
           round(round(r.hist_receiver_fanout, 8), 4) AS hist_receiver_fanout
    FROM abt a LEFT JOIN stats h ON a.account_id = h.account_id
    LEFT JOIN risk r ON a.account_id = r.account_id""",
    ),
    "asof_training_set": _asof(">"),
    "asof_training_set_inclusive": _asof(">="),
    "latest_profile": _with(WITH_HISTORY, f"SELECT account_id, {PROFILE_COLUMNS}, last_activity_ts FROM stats"),
    "latest_lookup": _with(
        WITH_HISTORY,
        f"""SELECT o.account_id, {PROFILE_COLUMNS}, last_activity_ts
    FROM owners o LEFT JOIN stats s ON o.account_id = s.account_id""",
    ),
    "versioned_table": _with(
        [ACCOUNTS, BANKS],
        """SELECT 1 AS version, bank_id, bank_name, bank_country FROM banks
    UNION ALL SELECT 2, bank_id, upper(bank_name), bank_country FROM banks""",
    ),
    "landing_reload": _with([TXNS], "SELECT * EXCLUDE (event_key, l_orderkey) FROM txns"),
    "view_refresh": _with(WITH_HISTORY, f"SELECT account_id, {PROFILE_COLUMNS} FROM stats"),
    "train_sample": _with([*WITH_ABT, SAMPLE], "SELECT * FROM sample"),
    "class_weights": _with(
        [*WITH_ABT, SAMPLE],
        """SELECT n_pos, n_neg, round(CAST(n_neg AS DOUBLE) / greatest(1, n_pos), 4) AS pos_weight FROM (
        SELECT count(*) FILTER (WHERE is_laundering = 1) AS n_pos,
               count(*) FILTER (WHERE is_laundering <> 1) AS n_neg
        FROM sample WHERE split = 'TRAIN') counted""",
    ),
    "numeric_coerce": """SELECT event_id,
           coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0) AS k_number,
           coalesce(try_cast(event_type AS DOUBLE), 0) AS type_number,
           coalesce(try_cast(props AS DOUBLE), 0) AS props_number
    FROM events""",
    "json_path": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events",
    "score_matrix": _score_matrix(),
    "daily_slice": _with(
        [*WITH_ABT, *SLICE], "SELECT event_key, account_id, event_ts, is_laundering FROM slice"
    ),
    "daily_scores": _with(SCORED_SLICE, f"{PREDICTIONS} FROM scored"),
    "predictions_table": _with(
        SCORED_SLICE,
        f"""{PREDICTIONS}, TIMESTAMP '2001-07-02 06:00:00' AS scored_at, CAST(CAST(event_ts AS DATE) AS VARCHAR) AS event_date
    FROM scored""",
    ),
    "predictions_two_runs": _with(
        [
            *WITH_ABT,
            RISK,
            "early AS (SELECT * FROM abt WHERE event_ts <= (SELECT max(event_ts) FROM abt) - INTERVAL 18 HOUR)",
            """both_runs AS (
    SELECT *, TIMESTAMP '2001-07-02 06:00:00' AS scored_at FROM abt
    WHERE event_ts >= (SELECT max(event_ts) FROM abt) - INTERVAL 1 DAY
    UNION ALL
    SELECT *, TIMESTAMP '2001-07-01 06:00:00' FROM early
    WHERE event_ts >= (SELECT max(event_ts) FROM early) - INTERVAL 1 DAY
      AND event_ts < (SELECT max(event_ts) FROM abt) - INTERVAL 1 DAY
)""",
            *_scored(Q.SCORECARD_V2, "both_runs", "scored"),
        ],
        f"{PREDICTIONS}, scored_at FROM scored JOIN (SELECT event_key AS k, scored_at FROM both_runs) ON event_key = k",
    ),
    "test_sample_scores": _with(
        SCORED_TEST,
        f"{PREDICTIONS} FROM scored ORDER BY fraud_score DESC, event_key LIMIT {Q.TOP_K}",
    ),
    "top_risk": _with(
        SCORED_SLICE, f"{PREDICTIONS} FROM scored ORDER BY fraud_score DESC, event_key LIMIT {Q.TOP_K}"
    ),
    "score_separation": _with(
        SCORED_TEST,
        """SELECT CASE WHEN label = 1 THEN 'fraud' ELSE 'normal' END AS class, count(*) AS n,
           round(avg(fraud_score), 3) AS avg_score
    FROM scored GROUP BY 1 ORDER BY 1""",
    ),
    "score_separation_wide": _with(
        SCORED_TEST,
        """SELECT count(*) AS n, round(avg(fraud_score) FILTER (WHERE label = 1), 3) AS avg_fraud,
           round(avg(fraud_score) FILTER (WHERE label = 0), 3) AS avg_normal
    FROM scored""",
    ),
    "pr_auc": _with([*SCORED_TEST, *_metrics("scored", "m")], "SELECT round(pr_auc, 6) AS pr_auc FROM m"),
    "roc_auc": _with([*SCORED_TEST, *_metrics("scored", "m")], "SELECT round(roc_auc, 6) AS roc_auc FROM m"),
    "recall_at_k": _with(
        [*SCORED_TEST, *_metrics("scored", "m")], "SELECT round(recall_at_k, 6) AS recall_at_k FROM m"
    ),
    "model_metrics": _with(
        [*SCORED_TEST, *_metrics("scored", "m")],
        """SELECT round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc,
           round(base_rate, 6) AS base_rate, round(recall_at_k, 6) AS recall_at_k FROM m""",
    ),
    "run_compare": _with(
        [
            *WITH_ABT,
            RISK,
            *TEST,
            *_scored(Q.SCORECARD_V1, "test_rows", "scored_a"),
            *_scored(Q.SCORECARD_V2, "test_rows", "scored_b"),
            *_metrics("scored_a", "ma"),
            *_metrics("scored_b", "mb"),
        ],
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, round(ma.{m}, 6) AS a, round(mb.{m}, 6) AS b, "
            f"round(mb.{m} - ma.{m}, 6) AS delta FROM ma, mb"
            for m in ("pr_auc", "roc_auc", "base_rate", "recall_at_k")
        ),
    ),
    "run_log": _with(
        [
            *WITH_ABT,
            RISK,
            *TEST,
            *_scored(Q.SCORECARD_V1, "test_rows", "scored_a"),
            *_scored(Q.SCORECARD_V2, "test_rows", "scored_b"),
            *_metrics("scored_a", "ma"),
            *_metrics("scored_b", "mb"),
        ],
        " UNION ALL ".join(
            f"SELECT '{run}' AS run, '{m}' AS metric, round({m}, 6) AS value FROM {source}"
            for run, source in (("train_V1", "ma"), ("train_V2", "mb"))
            for m in ("pr_auc", "roc_auc", "base_rate", "recall_at_k")
        ),
    ),
    **{
        name: _with(
            WITH_ABT, "SELECT event_key, is_laundering AS label, true AS is_probability FROM abt WHERE split = 'TEST'"
        )
        for name in ("train_scores", "spark_tree_scores", "monotone_scores")
    },
    **{
        name: _with(
            WITH_ABT,
            f"""SELECT feature, (SELECT count(*) FROM abt WHERE split = 'TEST') AS n_rows, CAST(0 AS BIGINT) AS n_decreases
        FROM (VALUES {", ".join(f"('{name}')" for name in S.MONOTONE_FEATURES)}) AS audited(feature)""",
        )
        for name in ("monotone_audit", "tree_audit")
    },
    "velocity": VELOCITY,
    "velocity_distinct": _with(
        [PAYMENTS],
        f"""SELECT event_id, account_id, event_ts, receiver_bank, receiver_account_id,
           count(DISTINCT receiver_bank) {_over(24)} AS distinct_banks_24h,
           count(DISTINCT receiver_account_id) {_over(24)} AS distinct_receivers_24h
    FROM payments""",
    ),
    "velocity_as_of": _with(
        [PAYMENTS, "newest AS (SELECT max(event_ts) AS ts FROM payments)"],
        """SELECT account_id,
           count(amount_paid) FILTER (WHERE event_ts >= ts - INTERVAL 1 HOUR) AS txn_count_1h,
           count(amount_paid) FILTER (WHERE event_ts >= ts - INTERVAL 24 HOUR) AS txn_count_24h,
           round(sum(amount_paid) FILTER (WHERE event_ts >= ts - INTERVAL 24 HOUR), 4) AS amt_sum_24h,
           round(sum(amount_paid), 4) AS amt_sum_48h,
           count(DISTINCT receiver_bank) FILTER (WHERE event_ts >= ts - INTERVAL 24 HOUR)
               AS distinct_banks_24h,
           count(DISTINCT receiver_account_id) FILTER (WHERE event_ts >= ts - INTERVAL 24 HOUR)
               AS distinct_receivers_24h,
           CAST(sum(is_cross_currency) FILTER (WHERE event_ts >= ts - INTERVAL 24 HOUR) AS BIGINT)
               AS cross_ccy_cnt_24h,
           CAST(sum(is_high_risk_format) FILTER (WHERE event_ts >= ts - INTERVAL 24 HOUR) AS BIGINT)
               AS high_risk_cnt_24h
    FROM payments, newest WHERE event_ts >= ts - INTERVAL 48 HOUR GROUP BY account_id""",
    ),
    "velocity_asof_tiles": _with(
        [PAYMENTS],
        """SELECT e.event_id, e.account_id, e.event_ts, count(p.amount_paid) FILTER (WHERE age < 1) AS txn_count_1h,
           count(p.amount_paid) FILTER (WHERE age < 24) AS txn_count_24h,
           round(sum(p.amount_paid) FILTER (WHERE age < 24), 4) AS amt_sum_24h,
           round(sum(p.amount_paid) FILTER (WHERE age < 48), 4) AS amt_sum_48h,
           CAST(sum(p.is_cross_currency) FILTER (WHERE age < 24) AS BIGINT) AS cross_ccy_cnt_24h,
           CAST(sum(p.is_high_risk_format) FILTER (WHERE age < 24) AS BIGINT) AS high_risk_cnt_24h
    FROM payments e JOIN payments p ON p.account_id = e.account_id,
        LATERAL (SELECT date_diff('hour', date_trunc('hour', p.event_ts), date_trunc('hour', e.event_ts)) AS age) a
    WHERE age BETWEEN 0 AND 47 GROUP BY ALL""",
    ),
    "hour_tiles": _with([PAYMENTS], TILES),
    "stream_hour_tiles": _with([PAYMENTS], TILES),
    "stream_backfill": _with([PAYMENTS], TILES),
    **{name: _with([PAYMENTS], TILES) for name in ("stream_backfill_late", "stream_compaction", "stream_late")},
    "stream_transform": _with([PAYMENTS], TILES.replace("FROM payments", "FROM payments WHERE is_high_risk_format = 0")),
    "stream_burst": _with(
        [
            PAYMENTS,
            """burst AS (SELECT * FROM payments WHERE account_id =
                (SELECT account_id FROM payments GROUP BY account_id ORDER BY count(*) DESC, account_id LIMIT 1))""",
        ],
        ROLLED.replace("payments", "burst"),
    ),
    "stream_velocity_distinct": _with(
        [PAYMENTS],
        """SELECT account_id, count(DISTINCT receiver_bank) AS distinct_banks_24h,
           count(DISTINCT receiver_account_id) AS distinct_receivers_24h
    FROM payments
    WHERE date_trunc('hour', event_ts) > (SELECT date_trunc('hour', max(event_ts)) - INTERVAL 24 HOUR FROM payments)
    GROUP BY account_id""",
    ),
    "stream_velocity": _with([PAYMENTS], ROLLED),
    "stream_event_features": VELOCITY,
    "stream_source": _with(
        [PAYMENTS],
        """SELECT * EXCLUDE (event_id) FROM payments
    QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY event_ts DESC, amount_paid DESC NULLS LAST,
        receiver_account_id DESC NULLS LAST, receiver_bank DESC NULLS LAST) = 1""",
    ),
    "model_versions": _with(
        CURATED,
        f"""SELECT environment, version, is_default, n + (SELECT count(DISTINCT payment_format) FROM events_in) AS n_features
    FROM (VALUES ('dev', 'V1', false, {len(S.REQUEST_FEATURES) + len(S.PROFILE_FEATURES)}),
                 ('dev', 'V2', true, {len(S.REQUEST_FEATURES) + len(S.PROFILE_FEATURES) + len(S.RISK_FEATURES)}),
                 ('prod', 'V2', true, {len(S.REQUEST_FEATURES) + len(S.PROFILE_FEATURES) + len(S.RISK_FEATURES)})
         ) AS v(environment, version, is_default, n)""",
    ),
    "promoted_scores": _with(
        [*WITH_ABT, *SLICE], "SELECT event_key, is_laundering AS label, true AS is_probability FROM slice"
    ),
    "stream_latest": _with(
        [PAYMENTS],
        """SELECT * FROM payments
    QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY event_ts DESC, event_id DESC) = 1""",
    ),
}
