import gzip
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier

import pytest

from riskfeat import schemas as S
from riskfeat import session
from riskfeat.plans import queries
from riskfeat.session import scratch_dir
from riskfeat.sources import commits, files, fixture, patterns

HEADER = "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,Payment Currency,Payment Format,Is Laundering"
LINES = [
    '2022/09/01 00:20,010,8000EBD30,010,8000EBD30,3697.34,US Dollar,3697.34,"US, Dollar",Reinvestment,0',
    "2022/09/01 00:21,03208,8000F4580,001,8000F5340,0.01,Euro,,Euro,,1",
]


def test_csv_by_position_with_quotes_and_empty_fields(spark, tmp_path):
    path = tmp_path / "t.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write("\n".join([HEADER, *LINES]) + "\n")
    got = files.read_transactions(spark, str(path)).collect()
    assert got[0]["from_bank"] == "010"
    assert got[0]["payment_currency"] == "US, Dollar"
    assert got[0]["is_laundering"] == 0
    assert (got[1]["amount_paid"], got[1]["payment_format"], got[1]["amount_received"]) == (None, None, 0.01)


def test_malformed_csv_row_aborts(spark, tmp_path):
    (tmp_path / "t.csv").write_text(HEADER + "\n" + LINES[1].replace("0.01", "many") + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_transactions(spark, str(tmp_path / "t.csv")).collect()


def test_accounts_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Bank Name,Bank ID,Account Number,Entity ID,Entity Name\nX Bank #1,001,A,E,Person #2\n")
    assert files.read_accounts(spark, str(tmp_path / "a.csv")).collect() == [("X Bank #1", "001", "A", "E", "Person #2")]


def test_every_landing_file_is_loaded_once_whenever_it_arrives(spark, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()
    make = lambda new, load: files.with_row_key(spark.read.text(new), load)
    load = lambda: files.load_new(spark, str(landing), path, make)
    assert not load()
    (landing / "a.txt").write_text("1\n2\n")
    assert load() and not load()
    (landing / "b.txt").write_text("3\n")
    (landing / "_SUCCESS").write_text("")
    # A load that died before its manifest entry leaves rows that do not count.
    spark.range(1).selectExpr("'lost' AS value", "'x' AS event_key").write.parquet(f"{path}/rows/load=1")
    assert sorted(r["value"] for r in files.loaded(spark, path).collect()) == ["1", "2"]
    assert load() and not load()
    rows = files.loaded(spark, path).collect()
    assert sorted(r["value"] for r in rows) == ["1", "2", "3"]
    assert len({r["event_key"] for r in rows}) == 3


def test_versions_can_read_what_they_replace(spark, tmp_path):
    root = str(tmp_path)
    assert files.current_version(spark, root, "t") == 0
    files.write_version(spark.range(3), root, "t")
    old = files.read_version(spark, root, "t")
    assert files.write_version(old.unionByName(old), root, "t") == 2
    assert files.read_version(spark, root, "t").count() == 6
    assert files.read_version(spark, root, "t", 1).count() == 3
    # A version whose writer died before the last step is not current, and is written anew.
    spark.range(1).write.parquet(f"{root}/t/v=3-lost")
    assert files.read_version(spark, root, "t").count() == 6
    assert files.write_version(spark.range(8), root, "t") == 3
    assert files.read_version(spark, root, "t").count() == 8


def test_no_run_takes_predictions_of_another(spark, tmp_path):
    path = str(tmp_path / "p")

    def write(ids, as_of):
        rows = f"SELECT id AS event_key, timestamp_ntz'2024-01-01' + make_dt_interval(0, 6 * cast(id AS int)) AS event_ts, '{as_of}' AS run_of FROM range({ids})"
        files.write_predictions(spark.sql(rows), path, as_of)

    write("2, 7", "2024-01-02 06:00:00")
    for _ in range(2):
        write("6, 11", "2024-01-03 06:00:00")
    got = {r["event_key"]: r["run_of"] for r in files.read_predictions(spark, path).collect()}
    assert got == {i: f"2024-01-0{2 if i < 6 else 3} 06:00:00" for i in range(2, 11)}
    assert spark.read.parquet(path).count() == 10


def test_two_writers_of_one_version_keep_their_rows_apart(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(files, "current_version", lambda *_: 0)
    files.write_version(spark.range(3), root, "t")
    files.write_version(spark.range(5), root, "t")
    assert files.read_version(spark, root, "t", 1).count() in (3, 5)


def test_a_writer_that_was_overtaken_gets_the_next_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    last, overtaken = commits.CommitLog.last, []

    def slow(log):
        number = last(log)
        if not overtaken:  # another writer commits after the number was chosen
            overtaken.append(True)
            assert files.write_version(spark.range(5), root, "t") == 1
        return number

    monkeypatch.setattr(commits.CommitLog, "last", slow)
    assert files.write_version(spark.range(3), root, "t") == 2
    assert [files.read_version(spark, root, "t", v).count() for v in (1, 2)] == [5, 3]


def test_many_threads_commit_every_entry_once(spark, tmp_path):
    log = commits.CommitLog(spark, str(tmp_path / "log"))
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: log.append(lambda _: {"i": i})["number"], range(80)))
    assert sorted(numbers) == list(range(1, 81))
    assert sorted(e["i"] for e in log.entries()) == list(range(80))
    assert [e["number"] for e in log.entries()] == list(range(1, 81)) and log.last() == 80
    assert len(list((tmp_path / "log").glob("*.snapshot"))) == 2
    (tmp_path / "log" / "000000000003.commit").unlink()  # the snapshots hold it
    assert len(log.entries()) == 80


def test_two_loaders_at_once_load_every_file_once(spark, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()
    (landing / "a.txt").write_text("1\n2\n")
    tried = []

    def make(new, load):
        tried.append(sorted(f.rsplit("/", 1)[1] for f in new))
        if len(tried) == 1:  # while this load runs, another one does all there is
            assert files.load_new(spark, str(landing), path, make)
            (landing / "b.txt").write_text("3\n")
        return files.with_row_key(spark.read.text(new), load)

    assert files.load_new(spark, str(landing), path, make)
    assert tried == [["a.txt"], ["a.txt"], ["b.txt"]]
    rows = files.loaded(spark, path).collect()
    assert sorted(r["value"] for r in rows) == ["1", "2", "3"] and len({r["event_key"] for r in rows}) == 3
    assert len(list(Path(path, "rows").iterdir())) == 2


def test_scratch_lies_below_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert scratch_dir(spark, "x").startswith(base)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def edge(n, fields=11):
    return ",".join(["2022/09/01 00:0" + str(n), "01", f"A{n}", "02", f"B{n}", "1.5", "Euro", f"{n}.25", "Yen", "ACH", "1"][:fields])


PATTERN_TEXT = [
    "noise, before, any, block, " + edge(0),
    "BEGIN LAUNDERING ATTEMPT - FAN-OUT:  Max 16-degree Fan-Out",
    "  " + edge(1) + "  ",
    edge(2, fields=8),
    edge(3) + ",extra",
    "",
    "END LAUNDERING ATTEMPT - FAN-OUT",
    edge(4),
    "BEGIN LAUNDERING ATTEMPT - CYCLE",
    "END LAUNDERING ATTEMPT - CYCLE",
    "BEGIN LAUNDERING ATTEMPT",
    edge(5),
    "BEGIN LAUNDERING ATTEMPT - gather scatter: 3",
    edge(6),
    "END LAUNDERING ATTEMPT",
]
EXPECTED = [
    (1, "FAN-OUT", "01_A1", "02_B1", 1.25),
    (1, "FAN-OUT", "01_A3", "02_B3", 3.25),
    (3, "UNKNOWN", "01_A5", "02_B5", 5.25),
    (4, "GATHER SCATTER", "01_A6", "02_B6", 6.25),
]
COLUMNS = ["pattern_id", "pattern_type", "from_account_id", "to_account_id", "amount_paid"]


def test_pattern_text_in_one_file(spark, tmp_path, rows):
    (tmp_path / "p.txt").write_text("\n".join(PATTERN_TEXT) + "\n")
    df = patterns.parse_patterns(spark, str(tmp_path / "p.txt"))
    assert rows(df, *COLUMNS) == EXPECTED
    assert df.first()["payment_currency"] == "Yen"


def test_pattern_text_cut_into_many_splits(spark, tmp_path, rows):
    (tmp_path / "p.txt").write_text("\n".join(PATTERN_TEXT) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = patterns.parse_patterns(spark, str(tmp_path / "p.txt"))
        assert spark.read.text(str(tmp_path / "p.txt")).rdd.getNumPartitions() > 5
        assert rows(df, *COLUMNS) == EXPECTED
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_pattern_that_runs_over_files(spark, tmp_path, rows):
    # Eleven files: the name order must be by number, not by text.
    for i in range(0, len(PATTERN_TEXT)):
        (tmp_path / f"part-{i}.txt").write_text(PATTERN_TEXT[i] + "\n")
    assert rows(patterns.parse_patterns(spark, str(tmp_path)), *COLUMNS) == EXPECTED


def test_written_patterns_read_back(spark, tmp_path, rows):
    data = [
        (block, line, f"FAN-{'IN' if block % 2 else 'OUT'}", "2022/09/01 00:01", "01", f"A{line}", "02", "B", 1.0, "E", float(line), "Y", "ACH", 1)
        for block in range(4)
        for line in range(block + 1)
    ]
    schema = "block int, line int, kind string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.TXN_SCHEMA.fields)
    patterns.write_patterns(spark.createDataFrame(data, schema), str(tmp_path / "x"), "block", "line", "kind")
    got = rows(patterns.parse_patterns(spark, str(tmp_path / "x")), "pattern_id", "pattern_type", "amount_paid")
    assert got == sorted((b + 1, k, float(n)) for b, n, k, *_ in data)


def test_blocks_of_too_few_payments_are_left_out(spark, tmp_path, rows):
    line = ("2022/09/01 00:01", "1", "A", "2", "B", 5.0, "USD", 6.5, "EUR", "Wire", 1)
    data = [(b, str(k), "CYCLE", *line) for b, k in ((1, 1), (2, 2), (2, 3), (None, 4), (None, 5), (3, 6), (3, 7), (3, 8))]
    schema = "block long, line string, kind string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.TXN_SCHEMA)
    path = str(tmp_path / "x")
    patterns.write_patterns(spark.createDataFrame(data, schema), path, "block", "line", "kind", least=2)
    assert rows(patterns.parse_patterns(spark, path).groupBy("pattern_id").count()) == [(1, 2), (2, 3)]


def test_patterns_move_as_parsed_payments(spark, tmp_path):
    """Whole lines were shuffled, and split into fields after that."""
    (tmp_path / "p.txt").write_text("BEGIN LAUNDERING ATTEMPT - CYCLE:\nx\n")
    plan = patterns.parse_patterns(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "split" not in plan[: plan.index("Window")] and "split" in window


def test_lines_are_shuffled_by_their_order_only(spark):
    """Customers met the lines, and cost them a shuffle of their own."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, value in zip(names, ("-1", "false")):
            spark.conf.set(n, value)
        df = fixture.transactions(spark, "/root/testdata/sf0.001", ["l_orderkey"])
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "o_custkey" in joins[1]


def test_a_scorecard_is_scored_once(spark, monkeypatch):
    """Two runs of one scorecard computed the same table twice."""
    from riskfeat.plans import queries

    t, made = queries.Tables(spark, "unused"), []
    frame = spark.createDataFrame([("e", 1, 0.5, 2)], "event_key string, label int, fraud_score double, x int")
    monkeypatch.setattr(queries.Tables, "scored", lambda self, card=None: made.append(card) or frame)
    for card in (queries.SCORECARD_V1, queries.SCORECARD_V1, queries.SCORECARD_V2):
        assert t.scored_table(card).columns == ["event_key", "label", "fraud_score"]
    assert len(made) == 2


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = manager.getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


@pytest.mark.parametrize("write", ["staged", "write_version", "write_patterns"])
def test_shuffle_files_go_when_a_table_is_written(spark, tmp_path, write):
    """They stayed until the driver happened to collect its garbage."""
    payments = spark.createDataFrame([(i // 3, f"{i}", "CYCLE", *["1"] * 11) for i in range(60)], ["block", "key", "kind", *S.TXN_SCHEMA.names])
    moved = payments.repartition(3, "key")
    before = _shuffle_files(spark)
    if write == "staged":
        files.staged(moved, "moved")
    elif write == "write_version":
        files.write_version(moved, str(tmp_path), "moved")
    else:
        patterns.write_patterns(moved, str(tmp_path), "block", "key", "kind", least=2)
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) != "true"


def test_writers_of_several_threads_leave_the_setting_as_it_was(spark):
    both, before = Barrier(2), spark.conf.get(session.SHUFFLE_CLEANUP, None)

    def enter(late):
        with session.shuffles_dropped(spark):
            both.wait(30)
            time.sleep(0.3 * late)
            return spark.conf.get(session.SHUFFLE_CLEANUP)

    with ThreadPoolExecutor() as pool:
        assert list(pool.map(enter, (0, 1))) == ["true", "true"]
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before


def test_a_held_table_goes_with_its_block(spark):
    with files.held(spark.range(5), "held") as kept:
        path = kept.inputFiles()[0].removeprefix("file:")
        assert kept.count() == 5 and Path(path).exists()
    with pytest.raises(ZeroDivisionError), files.held(spark.range(5), "held") as kept:
        other = kept.inputFiles()[0].removeprefix("file:")
        1 / 0
    assert not Path(path).exists() and not Path(other).exists()


@pytest.fixture
def scratch(spark, tmp_path, monkeypatch):
    """Where tables of a query go, in a folder of the test."""
    monkeypatch.setattr(session, "scratch_dir", lambda spark, purpose: f"{tmp_path}/{purpose}-{uuid.uuid4().hex}")
    for module in (files, queries):
        monkeypatch.setattr(module, "scratch_dir", session.scratch_dir)
    return lambda: {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}


def test_only_the_environments_are_left_on_disk(spark, scratch, tmp_path):
    """Events and history were written twice; frames, scores and their counts stayed, beside all shuffle files."""
    dev, prod = queries.Tables(spark, "/root/testdata/sf0.001").environments
    assert scratch() == {"bank-dim", "environments"}
    for root, name in ((prod, "txn_events"), (prod, "account_history"), (dev, "abt"), (prod, "abt"), (dev, "abt_sample")):
        assert files.read_version(spark, root, name).count()
    assert {f.name.split(".")[-2] for f in Path(prod, "abt").rglob("part-*.parquet")} == {"zstd"}


def test_only_the_table_of_patterns_is_left_on_disk(spark, scratch, tmp_path):
    """Their text stayed beside it."""
    found = queries.callables()["patterns_table"](spark, "/root/testdata/sf0.001")
    assert found.count() > 1000 and {p.name for d in tmp_path.iterdir() for p in d.iterdir()} == {"laundering_patterns"}
