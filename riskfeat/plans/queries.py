"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskfeat import schemas as S
from riskfeat.functions import columns as C
from riskfeat.operators import abt as A
from riskfeat.operators import curate, history, metrics, quality, rolling, sampling, summaries
from riskfeat.operators import features as V
from riskfeat.operators.joins import latest_by_key, lookup
from riskfeat.operators.matrix import assemble, history_features, signature
from riskfeat.plans import model as M
from riskfeat.plans import pipeline as P
from riskfeat.plans.pipeline import daily_scores
from riskfeat.plans.registry import Registry
from riskfeat.session import scratch_dir
from riskfeat.sources import files, fixture, patterns, streams
from riskfeat.streaming import velocity

#: Labelled rows of the negative class that a model is fitted on.
SAMPLE_NEGATIVES = 20_000
TOP_K = 10
ADDITIVE = [f for f in rolling.VELOCITY_FEATURES if f.agg != "distinct"]
DISTINCT = [f for f in rolling.VELOCITY_FEATURES if f.agg == "distinct"]

# A logistic model with fixed weights: what a fitted one looks like once exported as SQL.
SCORECARD_V1 = (
    {
        "amount_paid": 0.00002,
        "is_cross_currency": 0.4,
        "is_cross_border": 0.3,
        "is_high_risk_format": 0.5,
        "amount_to_avg_ratio": 0.6,
        "hist_txn_count": -0.01,
        "hist_foreign_ccy_share": 0.7,
        "hist_high_risk_share": 0.9,
        "payment_format_ach": 0.2,
        "payment_format_wire": 0.1,
        "payment_format_teleport": 5.0,
    },
    -4.0,
)
SCORECARD_V2 = (
    {**SCORECARD_V1[0], "hist_amount_cv": 0.8, "hist_receiver_fanout": 0.5},
    -5.0,
)


class Tables:
    """The derived tables of one scale factor.

    Properties are lazy plans; those named ``*_table`` are written once to the scratch
    folder, as the jobs of ``plans.pipeline`` do between stages.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._scored: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return fixture.table(self.spark, self.sf_dir, name)

    @cached_property
    def txns(self) -> DataFrame:
        return fixture.transactions(self.spark, self.sf_dir)

    @cached_property
    def accounts(self) -> DataFrame:
        return fixture.accounts(self.spark, self.sf_dir)

    @cached_property
    def banks(self) -> DataFrame:
        return files.staged(curate.bank_dim(self.accounts), "bank-dim")

    @cached_property
    def owners(self) -> DataFrame:
        return curate.account_dim(self.accounts, self.banks)

    @cached_property
    def events(self) -> DataFrame:
        return curate.txn_events(self.txns, self.banks, fixture.CUTOFF)

    @cached_property
    def events_table(self) -> DataFrame:
        return files.staged(self.events, "txn-events")

    def events_with(self, *columns: str | Column) -> DataFrame:
        """All events, written with some columns only."""
        return files.staged(self.events.select(*columns), "txn-events")

    @cached_property
    def history(self) -> DataFrame:
        return curate.account_history(self.events, self.owners)

    @cached_property
    def history_table(self) -> DataFrame:
        return files.staged(curate.account_history(self.events_table, self.owners), "account-history")

    @cached_property
    def heavy(self) -> DataFrame:
        return A.heavy_accounts(self.history_table)

    @cached_property
    def thresholds(self) -> DataFrame:
        return files.staged(A.split_thresholds(self.events_table), "split-thresholds")

    def abt_of(self, events: DataFrame, features: DataFrame | None = None) -> DataFrame:
        """Rows of the base table for some of the events; the periods are those of all."""
        return A.build_abt(events, self.history_table, self.thresholds, self.heavy, features)

    @cached_property
    def abt(self) -> DataFrame:
        return self.abt_of(self.events_table)

    @cached_property
    def abt_table(self) -> DataFrame:
        return files.staged(self.abt, "abt")

    @cached_property
    def test_rows(self) -> DataFrame:
        """TEST rows with their history; only these events meet it, and once."""
        events = A.with_split(self.events_table, self.thresholds).where(F.col("split") == "TEST").drop("split")
        return self.abt_of(events, history_features(self.history_table))

    def scored(self, scorecard=None) -> DataFrame:
        scorecard = scorecard or SCORECARD_V2
        return _rounded_score(M.scored_rows(self.test_rows, list(scorecard[0]), scorecard))

    def scored_table(self, scorecard=None) -> DataFrame:
        """Scored once for each scorecard, however many runs ask for it."""
        name = repr(scorecard)
        if name not in self._scored:
            kept = self.scored(scorecard).select("event_key", "label", "fraud_score")
            self._scored[name] = files.staged(kept, "scored")
        return self._scored[name]

    @cached_property
    def predictions(self) -> DataFrame:
        names = list(SCORECARD_V2[0])
        newest = self.abt_of(A.last_days(self.events_table, "event_ts"))
        return _rounded_score(daily_scores(newest, self.history_table, names, SCORECARD_V2))

    @cached_property
    def payments(self) -> DataFrame:
        return fixture.payment_events(self.raw("events"))

    @cached_property
    def sample(self) -> DataFrame:
        candidates = sampling.sample_candidates(self.events_table, SAMPLE_NEGATIVES)
        return sampling.train_sample(files.staged(self.abt_of(candidates), "candidates"), SAMPLE_NEGATIVES)

    @cached_property
    def sample_table(self) -> DataFrame:
        return files.staged(self.sample, "abt-sample")

    @cached_property
    def environments(self) -> tuple[str, str]:
        """A dev root with two trained versions, and a prod root to which the second was promoted."""
        root = scratch_dir(self.spark, "environments")
        dev, prod = f"{root}/dev", f"{root}/prod"
        files.write_version(self.events, prod, "txn_events")
        events = files.read_version(self.spark, prod, "txn_events")
        files.write_version(curate.account_history(events, self.owners), prod, "account_history")
        P.build_abt(self.spark, prod, dev, fixture.CUTOFF)
        for version, views in (("V1", [V.PROFILE_VIEW]), ("V2", [V.PROFILE_VIEW, V.RISK_VIEW])):
            P.train_version(self.spark, prod, dev, version, views, "monotone_lr", n_neg=SAMPLE_NEGATIVES)
        P.promote(self.spark, dev, prod, "2001-07-02 06:00:00", "v2", fixture.CUTOFF)
        return dev, prod

    def payment_stream(self) -> DataFrame:
        stream = (
            self.spark.readStream.schema(self.raw("events").schema)
            .option("pathGlobFilter", "events.parquet")
            .parquet(self.sf_dir)
        )
        return fixture.payment_events(stream)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _steady(df: DataFrame, *columns: str) -> DataFrame:
    """Four digits, by way of eight: a mean of cents often ends in an exact half of the last
    digit, and the order of addition must not decide where it goes."""
    return df.withColumns({c: F.round(F.round(c, 8), 4) for c in columns})


def _rounded_score(df: DataFrame) -> DataFrame:
    return _rounded(df, 6, "fraud_score")


# --- curation ---


def landing_transactions(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "transactions-csv")
    t.txns.select(S.TXN_SCHEMA.names).write.option("header", True).csv(path)
    return files.read_transactions(t.spark, path)


def landing_accounts(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "accounts-csv")
    t.accounts.write.option("header", True).csv(path)
    return files.read_accounts(t.spark, path)


def pattern_edges(t: Tables) -> DataFrame:
    """Orders with several line items, rendered as pattern text and parsed again."""
    return _edges(t, scratch_dir(t.spark, "patterns"))


def _edges(t: Tables, path: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("FAN-OUT", "FAN-IN", "CYCLE", "GATHER-SCATTER")])
    blocks = (
        fixture.transactions(t.spark, t.sf_dir, ["l_orderkey"])
        .withColumnRenamed("l_orderkey", "block")
        .withColumn("kind", F.element_at(kinds, (F.pmod("block", F.lit(4)) + 1).cast("int")))
    )
    patterns.write_patterns(blocks, path, "block", "event_key", "kind", least=2)
    return patterns.parse_patterns(t.spark, path)


def patterns_table(t: Tables) -> DataFrame:
    """The parsed patterns, written as a version of their table and read back."""
    root, text = scratch_dir(t.spark, "patterns"), scratch_dir(t.spark, "patterns")
    files.write_version(_edges(t, text), root, "laundering_patterns")
    files.remove(t.spark, text)
    return files.read_version(t.spark, root, "laundering_patterns")


def account_history(t: Tables) -> DataFrame:
    return _steady(
        t.history,
        "hist_avg_amount",
        "hist_std_amount",
        "hist_foreign_ccy_share",
        "hist_high_risk_share",
    )


def history_incremental(t: Tables) -> DataFrame:
    """The account history after three loads, each merged into what the ones before left."""
    root = scratch_dir(t.spark, "history")
    names = ["account_id", *history.DISTINCT, "amount_paid", *history.FLAGS, "event_ts"]
    events = t.events_with(*names, (F.crc32("event_key") % 3).alias("load"))
    for load in range(3):
        history.add_load(t.spark, root, events.where(F.col("load") == load).drop("load"))
    return _steady(
        history.current(t.spark, root, t.owners),
        "hist_avg_amount",
        "hist_std_amount",
        "hist_foreign_ccy_share",
        "hist_high_risk_share",
    )


# --- features and training ---


def account_profile(t: Tables) -> DataFrame:
    return _steady(
        V.PROFILE_VIEW.rows(t.history),
        "hist_avg_amount",
        "hist_std_amount",
        "hist_foreign_ccy_share",
        "hist_high_risk_share",
    )


def training_set(t: Tables) -> DataFrame:
    spine = with_split(t).select("event_key", "account_id", "event_ts", "split", "is_laundering")
    views = [V.PROFILE_VIEW.rows(t.history_table), V.RISK_VIEW.rows(t.history_table)]
    joined = V.training_set(spine, views, ["is_laundering"], heavy=t.heavy)
    return _steady(
        joined,
        "hist_avg_amount",
        "hist_std_amount",
        "hist_foreign_ccy_share",
        "hist_high_risk_share",
        *S.RISK_FEATURES,
    )


def asof_training_set(t: Tables, strict: bool = True) -> DataFrame:
    names = ["event_key", "account_id", "event_ts", "is_laundering"]
    events = t.events_with(*names, "amount_paid")
    spine, activity = events.select(names), V.ACTIVITY_VIEW.rows(events)
    return V.asof_training_set(spine, activity, "account_id", "event_ts", strict)


def latest_profile(t: Tables) -> DataFrame:
    """The online profile: the newest row of every account."""
    return _steady(
        latest_by_key(V.ONLINE_PROFILE_VIEW.rows(t.history), "account_id", "last_activity_ts"),
        "hist_avg_amount",
        "hist_std_amount",
        "hist_foreign_ccy_share",
        "hist_high_risk_share",
    )


def latest_lookup(t: Tables) -> DataFrame:
    """All accounts, paying or not, looked up in the online profile."""
    return lookup(latest_profile(t), t.owners.select("account_id"), "account_id")


def with_split(t: Tables) -> DataFrame:
    return A.with_split(t.events_table, t.thresholds)


def class_weights(t: Tables) -> DataFrame:
    weights = sampling.class_weights(t.sample.where(F.col("split") == "TRAIN"))
    return _rounded(weights, 4, "pos_weight")


def numeric_coerce(t: Tables) -> DataFrame:
    return t.raw("events").select(
        "event_id",
        C.to_number(F.get_json_object("props", "$.k")).alias("k_number"),
        C.to_number(F.col("event_type")).alias("type_number"),
        C.to_number(F.col("props")).alias("props_number"),
    )


def score_matrix(t: Tables) -> DataFrame:
    names = signature(t.events_table, with_risk=True)
    rows = t.abt_of(t.events_table, history_features(t.history_table))
    return _steady(assemble(rows, names, ["event_key", "is_laundering"]), *names)


# --- predictions and metrics ---


def test_sample_scores(t: Tables) -> DataFrame:
    """The highest scores of all TEST rows."""
    return summaries.top_risk(t.scored(), TOP_K)


def predictions_table(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "predictions")
    files.write_predictions(t.predictions, path, "2001-07-02 06:00:00")
    written = files.read_predictions(t.spark, path)
    return written.withColumn("event_date", F.col("event_date").cast("string"))


def predictions_two_runs(t: Tables) -> DataFrame:
    """The newest day scored, and the day before it by an earlier run; the newest score of every event."""
    path = scratch_dir(t.spark, "predictions")
    events = t.abt_table
    newest = events.agg(F.max("event_ts").alias("ts")).first()["ts"]
    earlier = events.where(F.col("event_ts") <= F.lit(newest - dt.timedelta(hours=18)))
    for rows, as_of in ((earlier, "2001-07-01 06:00:00"), (events, "2001-07-02 06:00:00"), (events, "2001-07-02 06:00:00")):
        names = list(SCORECARD_V2[0])
        scores = _rounded_score(daily_scores(rows, t.history_table, names, SCORECARD_V2))
        files.write_predictions(scores, path, as_of)
    return files.read_predictions(t.spark, path).drop("event_date")


def run_compare(t: Tables) -> DataFrame:
    runs = None
    for name, scorecard in (("train_V1", SCORECARD_V1), ("train_V2", SCORECARD_V2)):
        row = metrics.model_metrics(t.scored_table(scorecard))
        pairs = [x for c in row.columns for x in (F.lit(c), F.col(c))]
        run = row.select(F.lit(name).alias("run"), F.create_map(*pairs).alias("metrics"))
        runs = run if runs is None else runs.unionByName(run)
    return _rounded(metrics.compare_runs(runs, "train_V1", "train_V2"), 6, "a", "b", "delta")


# --- velocity ---


def velocity_features(t: Tables) -> DataFrame:
    keep = t.payments.select(
        "event_id", "account_id", "event_ts", "amount_paid", "is_cross_currency", "is_high_risk_format"
    )
    rolled = rolling.rolling_features(keep, "account_id", "event_ts", ADDITIVE)
    return _rounded(
        rolled.drop("is_cross_currency", "is_high_risk_format"), 4, "amt_sum_24h", "amt_sum_48h"
    )


def velocity_distinct(t: Tables) -> DataFrame:
    keep = t.payments.select(
        "event_id", "account_id", "event_ts", "receiver_bank", "receiver_account_id"
    )
    return rolling.rolling_features(keep, "account_id", "event_ts", DISTINCT)


def velocity_as_of(t: Tables) -> DataFrame:
    newest = t.payments.agg(F.max("event_ts").alias("ts")).select("ts").scalar()
    looked_up = rolling.features_as_of(t.payments, "account_id", "event_ts", newest)
    return _rounded(looked_up, 4, "amt_sum_24h", "amt_sum_48h")


def _plain_tiles(tiles: DataFrame) -> DataFrame:
    kept = [c for c in tiles.columns if not c.startswith("sketch_")]
    plain = tiles.select(kept).withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    return _rounded(plain, 4, "sum_amount_paid")


def hour_tiles(t: Tables) -> DataFrame:
    return _plain_tiles(rolling.hour_tiles(t.payments, "account_id", "event_ts"))


def _stream_tiles(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "velocity")
    velocity.start_velocity(
        t.payment_stream(), path, trigger={"availableNow": True}
    ).awaitTermination()
    return velocity.read_tiles(t.spark, path)


def stream_hour_tiles(t: Tables) -> DataFrame:
    return _plain_tiles(_stream_tiles(t))


def stream_event_features(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "event-features")
    stream = t.payment_stream().drop("receiver_bank", "receiver_account_id")
    velocity.start_event_features(
        stream, path, features=ADDITIVE, trigger={"availableNow": True}
    ).awaitTermination()
    written = velocity.read_event_features(t.spark, path)
    return _rounded(
        written.drop("is_cross_currency", "is_high_risk_format"), 4, "amt_sum_24h", "amt_sum_48h"
    )


def stream_backfill(t: Tables) -> DataFrame:
    """Tiles of a backfill of the first half, and of a stream that brings all events again."""
    path = scratch_dir(t.spark, "velocity")
    first, last = t.payments.agg(F.min("event_ts"), F.max("event_ts")).first()
    velocity.backfill(t.payments.where(F.col("event_ts") <= F.lit(first + (last - first) / 2)), path)
    velocity.start_velocity(
        t.payment_stream(), path, trigger={"availableNow": True}
    ).awaitTermination()
    velocity.compact_tiles(t.spark, path)
    return _plain_tiles(velocity.read_tiles(t.spark, path))


def velocity_asof_tiles(t: Tables) -> DataFrame:
    """Every event with its features at tile grain, from the tiles that a stream has kept."""
    spine = t.payments.select("event_id", "account_id", "event_ts")
    rolled = rolling.roll_up_at(_stream_tiles(t), spine, "account_id", "event_ts", ADDITIVE)
    return _rounded(rolled, 4, "amt_sum_24h", "amt_sum_48h")


def _past(t: Tables) -> Column:
    """Whether an event lies in the first half of the time."""
    first, last = t.payments.agg(F.min("event_ts"), F.max("event_ts")).first()
    return F.col("event_ts") <= F.lit(first + (last - first) / 2)


def _landed(t: Tables, path: str, events: DataFrame, **options) -> None:
    """Events land in the stream's folder, and the stream takes what is new there."""
    streams.land_events(events, f"{path}/in")
    velocity.start_velocity(
        streams.read_event_stream(t.spark, f"{path}/in"), path, trigger={"availableNow": True}, **options
    ).awaitTermination()


def _as_stream(events: DataFrame) -> DataFrame:
    return events.select(*[F.col(f.name).cast(f.dataType) for f in S.EVENT_SCHEMA.fields])


def stream_compaction(t: Tables) -> DataFrame:
    """A stream that first brings what was backfilled, so nothing is written; compacted, then the rest, compacted again."""
    path, past = scratch_dir(t.spark, "velocity"), _past(t)
    velocity.backfill(_as_stream(t.payments.where(past)), path)
    for part in (t.payments.where(past), t.payments.where(~past)):
        _landed(t, path, part)
        velocity.compact_tiles(t.spark, path)
    return _plain_tiles(velocity.read_tiles(t.spark, path))


def stream_backfill_late(t: Tables) -> DataFrame:
    """A backfill that misses every other event of the first half; the stream brings all events."""
    path = scratch_dir(t.spark, "velocity")
    velocity.backfill(_as_stream(t.payments.where(_past(t) & (F.col("event_id") % 2 == 0))), path)
    _landed(t, path, t.payments)
    return _plain_tiles(velocity.read_tiles(t.spark, path))


def stream_late(t: Tables) -> DataFrame:
    """The second half of the time comes first, and the first half late."""
    path, past = scratch_dir(t.spark, "velocity"), _past(t)
    for part in (t.payments.where(~past), t.payments.where(past)):
        _landed(t, path, part)
    return _plain_tiles(velocity.read_tiles(t.spark, path))


def stream_transform(t: Tables) -> DataFrame:
    """Tiles of the events that a transform of the stream lets pass."""
    path = scratch_dir(t.spark, "velocity")
    _landed(t, path, t.payments, transform=lambda df: df.where(F.col("is_high_risk_format") == 0))
    return _plain_tiles(velocity.read_tiles(t.spark, path))


def stream_burst(t: Tables) -> DataFrame:
    """All events of the busiest account land one file after the other, then its counters at their end."""
    path = scratch_dir(t.spark, "velocity")
    counts = t.payments.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    busiest = counts.orderBy(F.desc("n"), "account_id").limit(1).select("account_id")
    _landed(t, path, t.payments.join(F.broadcast(busiest), "account_id", "left_semi"))
    tiles = velocity.read_tiles(t.spark, path)
    newest = tiles.agg(F.max("hour").alias("hour")).select("hour").scalar()
    return _rounded(rolling.roll_up(tiles, newest, "account_id", ADDITIVE), 4, "amt_sum_24h", "amt_sum_48h")


def _stream_features(t: Tables, features: list[rolling.Feature]) -> DataFrame:
    tiles = _stream_tiles(t)
    newest = tiles.agg(F.max("hour").alias("hour")).select("hour").scalar()
    return rolling.roll_up(tiles, newest, "account_id", features)


def stream_velocity(t: Tables) -> DataFrame:
    return _rounded(_stream_features(t, ADDITIVE), 4, "amt_sum_24h", "amt_sum_48h")


def stream_source(t: Tables) -> DataFrame:
    """Events landed in two batches, read back as a stream of the declared schema; the latest per account."""
    path = scratch_dir(t.spark, "stream-source")
    for part in (0, 1):
        streams.land_events(t.payments.where(F.col("event_id") % 2 == part), f"{path}/in")
    velocity.start_latest(
        streams.read_event_stream(t.spark, f"{path}/in"), f"{path}/out", "account_id", "event_ts", {"availableNow": True}
    ).awaitTermination()
    latest = velocity.read_latest(t.spark, f"{path}/out", "account_id", "event_ts")
    return latest.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def stream_latest(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "latest")
    velocity.start_latest(
        t.payment_stream(), path, "account_id", "event_ts", {"availableNow": True}
    ).awaitTermination()
    return velocity.read_latest(t.spark, path, "account_id", "event_ts")


# --- versions, views, runs ---


def versioned_table(t: Tables) -> DataFrame:
    """Two versions of a table, the second made from the first."""
    root = scratch_dir(t.spark, "versions")
    files.write_version(t.banks, root, "banks")
    first = files.read_version(t.spark, root, "banks")
    files.write_version(first.withColumn("bank_name", F.upper("bank_name")), root, "banks")
    both = [files.read_version(t.spark, root, "banks", v).withColumn("version", F.lit(v)) for v in (1, 2)]
    return both[0].unionByName(both[1])


def landing_reload(t: Tables) -> DataFrame:
    """Transactions that land in two parts, loaded after each and once more."""
    root = scratch_dir(t.spark, "landing")
    odd = F.crc32("event_key") % 2
    for part in (0, 1, None):
        if part is not None:
            rows = t.txns.where(odd == part).select(S.TXN_SCHEMA.names)
            rows.write.mode("append").option("header", True).csv(f"{root}/landing")
        files.load_new(
            t.spark, f"{root}/landing", f"{root}/raw", lambda new, load: files.read_transactions(t.spark, new)
        )
    return files.loaded(t.spark, f"{root}/raw")


def view_refresh(t: Tables) -> DataFrame:
    """A registered view, refreshed, as it is read by name and version."""
    registry = Registry(t.spark, scratch_dir(t.spark, "registry"))
    registry.register(V.PROFILE_VIEW, t.history_table.limit(0))
    registry.refresh(V.PROFILE_VIEW, t.history_table)
    return _steady(
        registry.view(V.PROFILE_VIEW.name, V.PROFILE_VIEW.version),
        "hist_avg_amount",
        "hist_std_amount",
        "hist_foreign_ccy_share",
        "hist_high_risk_share",
    )


def run_log(t: Tables) -> DataFrame:
    """Logged runs of both scorecards, one row per metric."""
    registry = Registry(t.spark, scratch_dir(t.spark, "registry"))
    for name, scorecard in (("train_V1", SCORECARD_V1), ("train_V2", SCORECARD_V1), ("train_V2", SCORECARD_V2)):
        registry.log_run(name, {}, metrics.model_metrics(t.scored_table(scorecard)).first().asDict())
    return _rounded(registry.runs().select("run", F.explode("metrics").alias("metric", "value")), 6, "value")


def model_versions(t: Tables) -> DataFrame:
    """Versions of both environments, their defaults and the length of their signatures."""
    found = None
    for name, root in zip(("dev", "prod"), t.environments):
        registry = Registry(t.spark, root)
        rows = registry.entries("model").select(
            F.lit(name).alias("environment"),
            "version",
            (F.col("version") == registry.default(P.MODEL)).alias("is_default"),
            F.size("signature").cast("long").alias("n_features"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def readiness(t: Tables) -> DataFrame:
    """What a run would still need in prod, where one version was promoted."""
    views = [(v.name, v.version) for v in (V.PROFILE_VIEW, V.RISK_VIEW)]
    lacking = Registry(t.spark, t.environments[1]).missing([*views, ("NEVER", "V1")], [(P.MODEL, "V1"), (P.MODEL, "V2")])
    return t.spark.createDataFrame([(x,) for x in lacking], "lacking string")


def promoted_scores(t: Tables) -> DataFrame:
    """Predictions of the promoted version for the newest day."""
    scores = files.read_predictions(t.spark, f"{t.environments[1]}/predictions")
    return _checked_scores(scores)


# --- fitted models: scores depend on the optimizer; what must hold of them is compared ---


def _training_frame(t: Tables) -> tuple[DataFrame, list[str]]:
    views = [V.PROFILE_VIEW.rows(t.history_table), V.RISK_VIEW.rows(t.history_table)]
    frame = V.training_set(t.sample_table, views, ["is_laundering"], heavy=t.heavy)
    return files.staged(frame, "training"), signature(t.events_table, with_risk=True)


def _checked_scores(scored: DataFrame) -> DataFrame:
    return scored.select("event_key", "label", F.col("fraud_score").between(0, 1).alias("is_probability"))


def train_scores(t: Tables) -> DataFrame:
    frame, names = _training_frame(t)
    model = M.train(frame, names, "monotone_gbt")
    return _checked_scores(M.scored_rows(t.test_rows, names, model))


def spark_tree_scores(t: Tables) -> DataFrame:
    frame, names = _training_frame(t)
    return _checked_scores(M.scored_rows(t.test_rows, names, M.train(frame, names, "gbt")))


def monotone_scores(t: Tables) -> DataFrame:
    frame, names = _training_frame(t)
    model = M.train(frame, names, "monotone_lr")
    return _checked_scores(M.scored_rows(t.test_rows, names, model))


def _audit(t: Tables, kind: str) -> DataFrame:
    frame, names = _training_frame(t)
    model = M.train(frame, names, kind)
    matrix = assemble(t.test_rows, names, [])
    return M.monotone_audit(model, matrix, names, [0.5, 1.0, 10.0, 1000.0])


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "landing_transactions": landing_transactions,
    "landing_accounts": landing_accounts,
    "pattern_edges": pattern_edges,
    "patterns_table": patterns_table,
    "bank_dim": lambda t: t.banks,
    "account_dim": lambda t: t.owners,
    "txn_events": lambda t: t.events,
    "account_history": account_history,
    "history_incremental": history_incremental,
    "dup_keys": lambda t: quality.dup_keys(t.raw("lineitem"), ["l_orderkey", "l_linenumber"]),
    "split_thresholds": lambda t: _rounded(A.split_thresholds(t.events), 3, "p_train", "p_val"),
    "abt": lambda t: _rounded(t.abt, 6, "amount_to_avg_ratio"),
    "quality_report": lambda t: quality.quality_report(t.events_table, t.abt_table, fixture.CUTOFF, 5000),
    "split_summary": lambda t: summaries.split_summary(with_split(t)),
    "abt_totals": lambda t: summaries.abt_totals(with_split(t)),
    "class_balance": lambda t: summaries.class_balance(t.events),
    "rate_by_format": lambda t: summaries.rate_by(t.events, "payment_format"),
    "account_profile": account_profile,
    "account_risk": lambda t: _steady(V.RISK_VIEW.rows(t.history), *S.RISK_FEATURES),
    "training_set": training_set,
    "asof_training_set": asof_training_set,
    "asof_training_set_inclusive": lambda t: asof_training_set(t, strict=False),
    "latest_profile": latest_profile,
    "latest_lookup": latest_lookup,
    "train_sample": lambda t: t.sample.select("event_key", "account_id", "split", "is_laundering"),
    "class_weights": class_weights,
    "numeric_coerce": numeric_coerce,
    "json_path": lambda t: t.raw("events").select(
        "event_id", C.json_number(F.col("props"), "$.k").alias("k")
    ),
    "score_matrix": score_matrix,
    "daily_slice": lambda t: A.last_days(t.abt_table, "event_ts").select(
        "event_key", "account_id", "event_ts", "is_laundering"
    ),
    "daily_scores": lambda t: t.predictions,
    "predictions_table": predictions_table,
    "predictions_two_runs": predictions_two_runs,
    "test_sample_scores": test_sample_scores,
    "top_risk": lambda t: summaries.top_risk(t.predictions, TOP_K),
    "score_separation": lambda t: summaries.score_separation(t.scored()),
    "score_separation_wide": lambda t: summaries.score_separation(t.scored(), wide=True),
    "pr_auc": lambda t: _rounded(metrics.average_precision(t.scored_table()), 6, "pr_auc"),
    "roc_auc": lambda t: _rounded(metrics.roc_auc(t.scored_table()), 6, "roc_auc"),
    "recall_at_k": lambda t: _rounded(metrics.recall_at_k(t.scored_table()), 6, "recall_at_k"),
    "model_metrics": lambda t: _rounded(
        metrics.model_metrics(t.scored_table()), 6, "pr_auc", "roc_auc", "recall_at_k", "base_rate"
    ),
    "run_compare": run_compare,
    "velocity": velocity_features,
    "velocity_distinct": velocity_distinct,
    "velocity_as_of": velocity_as_of,
    "velocity_asof_tiles": velocity_asof_tiles,
    "hour_tiles": hour_tiles,
    "stream_hour_tiles": stream_hour_tiles,
    "stream_backfill": stream_backfill,
    "stream_backfill_late": stream_backfill_late,
    "stream_compaction": stream_compaction,
    "stream_late": stream_late,
    "stream_transform": stream_transform,
    "stream_burst": stream_burst,
    "stream_velocity": stream_velocity,
    "stream_velocity_distinct": lambda t: _stream_features(t, DISTINCT),
    "stream_event_features": stream_event_features,
    "stream_source": stream_source,
    "stream_latest": stream_latest,
    "versioned_table": versioned_table,
    "landing_reload": landing_reload,
    "view_refresh": view_refresh,
    "run_log": run_log,
    "model_versions": model_versions,
    "promoted_scores": promoted_scores,
    "readiness": readiness,
    "train_scores": train_scores,
    "monotone_scores": monotone_scores,
    "spark_tree_scores": spark_tree_scores,
    "monotone_audit": lambda t: _audit(t, "monotone_lr"),
    "tree_audit": lambda t: _audit(t, "monotone_gbt"),
}


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Tables(spark, sf_dir))

    return {name: bind(query) for name, query in QUERIES.items()}
