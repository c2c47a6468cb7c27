"""Progress that outlives the driver, lag that can be merged, and the ledger of filled times."""

import random
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import FeatureEngine, FeatureTable, Field, OnlineTable, Source, files, ingest_stream
from tidemark.operators.ledger import IntervalLedger, in_intervals, united, without
from tidemark.operators.metrics import RANK_ERROR, lag_sketches, merged_lag
from tidemark.operators.sinks import append_to_batch_store
from tidemark.sources.stream import read_files
from tidemark.streaming.progress import IngestMetrics, ProgressListener, ProgressTable

T0 = datetime(2022, 11, 3)
FERRY = FeatureTable("ferry", (Field("boat", "STRING"),), (Field("cars", "INT32"),), source=Source(event_timestamp="at"))
SCHEMA = "boat string, cars int, at timestamp_ntz"


def _minute(n):
    return T0 + timedelta(minutes=n)


def _crossings(spark, rows):
    return spark.createDataFrame([(b, c, _minute(t)) for b, c, t in rows], SCHEMA)


def _run(spark, folder, online, **options):
    run = ingest_stream(
        read_files(spark, f"{folder}/in", T.StructType.fromDDL(SCHEMA), files_per_trigger=1),
        FERRY, online, checkpoint=f"{folder}/checkpoint", trigger={"availableNow": True}, message_time="at", **options,
    )
    run.awaitTermination()
    return run


def test_totals_survive_restarts_and_folding(spark, folder):
    """More batches than Spark keeps in `recentProgress`, over several drivers' worth of objects."""
    online, path = OnlineTable(spark, f"{folder}/online", FERRY), f"{folder}/progress"
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for part in range(2):
            for i in range(4):
                n = 10 * part + i
                rows = [("a", n, n), ("b", n, n + 100), (None, 0, n)]
                _crossings(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            progress = ProgressTable(spark, path, fold_after=3)
            listener = ProgressListener(progress)
            spark.streams.addListener(listener)
            try:
                run = _run(spark, folder, online, progress=progress, dead_letters=f"{folder}/dead")
                spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
            finally:
                spark.streams.removeListener(listener)
            assert len(run.recentProgress) <= 3
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    later = ProgressTable(spark, path)
    (total,) = later.totals().collect()
    assert (total["n_batches"], total["n_read"], total["n_stored"], total["n_deadletter"]) == (8, 24, 16, 8)
    assert total["run"] == str(run.id) and total["latest_message"] == _minute(113)
    assert later._state()["folder"] and files.names_in(spark, f"{path}/folded")
    lag = merged_lag(later.batches()).first()
    assert lag["n"] == 24 and lag["min_lag_us"] <= lag["p50_lag_us"] <= lag["max_lag_us"]
    assert lag["max_lag_us"] - lag["min_lag_us"] >= 100 * 60_000_000
    reports = later.reports().filter("input_rows > 0")
    assert reports.agg(F.sum("input_rows")).first()[0] == 24 and reports.count() == 8


def test_a_replayed_batch_counts_once(spark, folder):
    table = ProgressTable(spark, f"{folder}/progress", fold_after=10**9)
    assert table.totals().collect() == [] and table.batches().collect() == [] and table.reports().collect() == []
    row = {"n_read": 5, "n_stored": 4, "n_deadletter": 1, "latest_message": datetime(2022, 11, 3, 4, tzinfo=UTC)}
    for run, batch in (("r/1", 0), ("r/1", 1), ("r/1", 1), ("r 2", 0)):
        table.record(run, batch, row)
    count = lambda: {r["run"]: (r["n_batches"], r["n_read"]) for r in table.totals().collect()}
    assert count() == {"r/1": (2, 10), "r 2": (1, 5)}
    for batch in range(2, 5):
        table.fold()
        assert count() == {"r/1": (batch, 5 * batch), "r 2": (1, 5)}
        table.record("r/1", batch, row)
    table.record("r/1", 4, {**row, "n_read": 6})
    assert count() == {"r/1": (5, 26), "r 2": (1, 5)}
    assert table.totals().filter("run = 'r/1'").first()["latest_message"] == datetime(2022, 11, 3, 4)
    assert len(files.names_in(spark, f"{folder}/progress/folded")) <= 2


def test_a_batch_that_was_stored_before_a_failure_is_still_counted(spark, folder):
    """The upsert is recognised as applied, so nothing runs that the counters could watch."""
    online = OnlineTable(spark, f"{folder}/online", FERRY)
    _crossings(spark, [("a", 1, 1)]).write.parquet(f"{folder}/in")
    online.upsert(_crossings(spark, [("a", 1, 1)]).withColumnRenamed("at", "event_timestamp"), batch_id=0, writer=f"{folder}/checkpoint")
    progress, metrics = ProgressTable(spark, f"{folder}/progress"), IngestMetrics()
    _run(spark, folder, online, progress=progress, metrics=metrics)
    assert progress.totals().first()["n_read"] == metrics.total("n_read") == 1


# ------------------------------------------------------------------------------------- lag


def test_quantiles_of_merged_sketches_are_near(spark, folder):
    draw = random.Random(3)
    waits = [int(draw.expovariate(1 / 5e6)) for _ in range(60_000)]
    rows = spark.createDataFrame([(i % 2, i % 50, w) for i, w in enumerate(waits)], "side int, batch int, wait long")
    rows = rows.withColumn("event_timestamp", F.lit(T0).cast("timestamp_ntz") - F.make_dt_interval(secs=F.col("wait") / 1e6))
    for batch in range(0, 50, 10):
        part = rows.filter(F.col("batch").between(batch, batch + 9))
        lag_sketches(part, T0, ["side", "batch"]).write.mode("append").parquet(f"{folder}/lag")
    stored = spark.read.parquet(f"{folder}/lag")
    assert stored.count() == 50
    for by, groups in (([], {None: waits}), (["side"], {s: waits[s::2] for s in (0, 1)})):
        for row in merged_lag(stored, by, [0.01, 0.5, 0.9, 0.99]).collect():
            values = sorted(groups[row["side"] if by else None])
            assert row["n"] == len(values) and abs(row["min_lag_us"] - values[0]) <= 1 and abs(row["max_lag_us"] - values[-1]) <= 1
            for q in (0.01, 0.5, 0.9, 0.99):
                below = sum(v < row[f"p{round(q * 100)}_lag_us"] - 1 for v in values) / len(values)
                upto = sum(v <= row[f"p{round(q * 100)}_lag_us"] + 1 for v in values) / len(values)
                assert below <= q + RANK_ERROR and upto >= q - RANK_ERROR
    none = rows.filter("side = 9")
    assert lag_sketches(none, T0).collect() == [] and merged_lag(lag_sketches(none, T0)).collect() == []


# ---------------------------------------------------------------------------------- ledger


def test_interval_arithmetic_matches_sets_of_minutes():
    draw = random.Random(5)
    spans = lambda n: [(a, a + draw.randint(0, 6)) for a in (draw.randint(0, 40) for _ in range(n))]
    as_set = lambda intervals: {m for a, b in intervals for m in range(a, b)}
    for _ in range(300):
        left, gone = spans(draw.randint(0, 6)), spans(draw.randint(0, 6))
        assert as_set(united(left)) == as_set(left) and as_set(without(left, gone)) == as_set(left) - as_set(gone)
        for found in (united(left), without(left, gone)):
            assert all(a[1] < b[0] for a, b in zip(found, found[1:])) and all(a < b for a, b in found)


def _engine(spark, folder):
    source = Source(path=f"{folder}/store", event_timestamp="at", date_partition="date")
    return FeatureEngine(spark, [FeatureTable("ferry", FERRY.entities, FERRY.features, source=source)], online_root=f"{folder}/online")


def _days(spark, first, last, seed):
    draw = random.Random(seed)
    rows = [(draw.choice("abcdef"), draw.randint(0, 99), draw.randint(first * 1440, last * 1440 - 1)) for _ in range(120)]
    return _crossings(spark, rows)


def _state(online):
    return {r.boat: (r.event_timestamp, r.cars) for r in online.rows().collect()}


def test_a_run_reads_only_what_earlier_runs_have_not(spark, folder):
    engine = _engine(spark, folder)
    append_to_batch_store(_days(spark, 0, 10, 1), f"{folder}/store", "at")
    day = lambda n: T0 + timedelta(days=n)
    assert engine.materialize_missing(day(2), day(4)) == {"ferry": [(day(2), day(4))]}
    assert engine.materialize_missing(day(3), day(6)) == {"ferry": [(day(4), day(6))]}
    assert engine.materialize_missing(day(1), day(8)) == {"ferry": [(day(1), day(2)), (day(6), day(8))]}
    version = engine.online_table("ferry").version
    assert engine.materialize_missing(day(1), day(8)) == {"ferry": []} and engine.online_table("ferry").version == version
    whole = OnlineTable(spark, f"{folder}/whole", engine.table("ferry"))
    rows = spark.read.parquet(f"{folder}/store").withColumnRenamed("at", "event_timestamp")
    inside = (F.col("event_timestamp") >= F.lit(day(1)).cast("timestamp_ntz")) & (F.col("event_timestamp") < F.lit(day(8)).cast("timestamp_ntz"))
    whole.upsert(rows.filter(inside))
    assert _state(engine.online_table("ferry")) == _state(whole)
    # Late rows: their days are read again, and no others.
    late = _days(spark, 5, 7, 2)
    append_to_batch_store(late, f"{folder}/store", "at")
    assert engine.ledger("ferry").reopen_days(late, "at") == 2
    assert engine.materialize_missing(day(1), day(8)) == {"ferry": [(day(5), day(7))]}
    whole.upsert(late.withColumnRenamed("at", "event_timestamp"))
    assert _state(engine.online_table("ferry")) == _state(whole)


def test_other_days_are_not_in_the_plan(spark, folder):
    append_to_batch_store(_days(spark, 0, 10, 3), f"{folder}/store", "at")
    day = lambda n: T0 + timedelta(days=n)
    rows = in_intervals(spark.read.parquet(f"{folder}/store"), "at", [(day(1), day(2)), (day(6), day(7) + timedelta(hours=1))], "date")
    assert {r.date for r in rows.select("date").distinct().collect()} <= {date(2022, 11, 4), date(2022, 11, 9), date(2022, 11, 10)}
    assert len(rows.inputFiles()) >= 1 and rows.count() > 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(((date#" in plan or "PartitionFilters: [((date#" in plan
    assert in_intervals(spark.read.parquet(f"{folder}/store"), "at", [], "date").count() == 0


def test_times_reopened_during_a_run_stay_open(spark, folder):
    ledger = IntervalLedger(spark, f"{folder}/t")
    day = lambda n: T0 + timedelta(days=n)
    opened = ledger.opened()
    ledger.reopen(day(1), day(2))
    assert not ledger.cover([(day(0), day(5))], opened) and ledger.intervals() == []
    assert ledger.cover([(day(0), day(5))], ledger.opened())
    ledger.reopen(date(2022, 11, 4), date(2022, 11, 5))
    assert ledger.missing(day(0), day(6)) == [(day(1), day(2)), (day(5), day(6))]
