"""Batch and stream ingestion, layouts, sinks, metrics, the engine and the jobs."""

import json
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import (
    FeatureEngine,
    FeatureTable,
    Field,
    OnlineTable,
    SchemaError,
    Source,
    Suite,
    expect_between,
    expect_in_set,
    ingest_batch,
    ingest_stream,
    push,
)
from tidemark.jobs import ingest as ingest_job
from tidemark.jobs import retrieve as retrieve_job
from tidemark.operators.latest import compact, latest_per_key
from tidemark.operators.layouts import (
    column_layout,
    kv_layout,
    read_wide,
    register_schemas,
    schema_registry_rows,
    storage_name,
    wide_layout,
)
from tidemark.operators.metrics import counters_frame, lag_summary, row_counters
from tidemark.operators.sinks import (
    append_to_batch_store,
    dataset_bounds,
    save_dataset,
    times_as_seconds,
    write_dead_letters,
    write_in_batches,
    write_result,
)
from tidemark.operators.validate import with_validity
from tidemark.plans.lineage import cut_lineage, scratch_path, shared_folder
from tidemark.sources.datasets import read_dead_letters, read_saved_dataset
from tidemark.sources.stream import read_files
from tidemark.streaming.ingest import json_message
from tidemark.streaming.progress import IngestMetrics, progress_frame

T0 = datetime(2023, 5, 17)
TABLE = FeatureTable(
    "gauges",
    (Field("station", "STRING"),),
    (Field("level", "INT32"), Field("flow", "FLOAT")),
    source=Source(event_timestamp="at"),
)
SCHEMA = "station string, level int, flow float, at timestamp_ntz"


def hour(n):
    return T0 + timedelta(hours=n)


def frame(spark, rows):
    return spark.createDataFrame([(c, a, b, None if t is None else hour(t)) for c, a, b, t in rows], SCHEMA)


def stored(online):
    return {r.station: (r.level, r.flow, r.event_timestamp) for r in online.rows().collect()}


def test_batch_load_dead_letters_and_counters(spark, folder):
    df = frame(
        spark,
        [("a", 1, 0.5, 1), ("a", 2, 0.25, 5), ("b", 3, 0.5, 2), (None, 4, 0.5, 3), ("c", 5, 0.5, 100), ("d", 500, 0.5, 4)],
    )
    online = OnlineTable(spark, f"{folder}/online", TABLE)
    suite = Suite((expect_between("level", 0, 100),))
    report = ingest_batch(
        spark, TABLE, online, T0, hour(50), df=df, suite=suite, dead_letters=f"{folder}/dead", run_id="r1"
    )
    assert (report.n_read, report.n_stored, report.n_deadletter) == (5, 3, 2)
    assert report.latest_event == hour(5)
    assert stored(online) == {"a": (2, 0.25, hour(5)), "b": (3, 0.5, hour(2))}
    # The same run again: the table stays, dead letters are appended.
    ingest_batch(spark, TABLE, online, T0, hour(50), df=df, suite=suite, dead_letters=f"{folder}/dead", run_id="r2")
    assert stored(online) == {"a": (2, 0.25, hour(5)), "b": (3, 0.5, hour(2))}
    assert read_dead_letters(spark, f"{folder}/dead").count() == 4
    reasons = read_dead_letters(spark, f"{folder}/dead", "r1").select(F.explode("_failed_checks")).collect()
    assert sorted(r[0] for r in reasons) == ["entity_null", "expect_column_values_to_be_between(level, max_value=100, min_value=0)"]


def test_flagged_rows_are_stored_and_dead_lettered(spark, folder):
    df = frame(spark, [("a", 500, 0.5, 1), (None, 1, 0.5, 1), ("b", 1, 0.5, 1)])
    online = OnlineTable(spark, f"{folder}/online", TABLE)
    report = ingest_batch(
        spark, TABLE, online, df=df, suite=Suite((expect_between("level", 0, 100),)), on_invalid="flag",
        dead_letters=f"{folder}/dead",
    )
    assert (report.n_read, report.n_stored, report.n_deadletter) == (3, 2, 2)
    assert set(stored(online)) == {"a", "b"}
    assert read_dead_letters(spark, f"{folder}/dead").count() == 2
    with pytest.raises(ValueError):
        ingest_batch(spark, TABLE, online, df=df, on_invalid="keep")


def test_stale_batch_is_ignored_and_nulls_do_not_erase(spark, folder):
    online = OnlineTable(spark, f"{folder}/online", TABLE)
    ingest_batch(spark, TABLE, online, df=frame(spark, [("a", 1, 0.5, 10)]))
    ingest_batch(spark, TABLE, online, df=frame(spark, [("a", 9, 0.75, 9)]))
    assert stored(online) == {"a": (1, 0.5, hour(10))}
    ingest_batch(spark, TABLE, online, df=frame(spark, [("a", None, 0.25, 11)]))
    assert stored(online) == {"a": (1, 0.25, hour(11))}


def test_mapping_expressions_and_type_errors(spark, folder):
    mapped = FeatureTable(
        "m", TABLE.entities, (Field("plus", "INT32"), Field("mix", "DOUBLE")),
        source=Source(event_timestamp="at", field_mapping={"plus": "level + 1", "mix": "level + double(flow) * 2"}),
    )
    online = OnlineTable(spark, f"{folder}/m", mapped)
    ingest_batch(spark, mapped, online, df=frame(spark, [("a", 1, 0.5, 1)]))
    assert online.rows().select("plus", "mix").first() == (2, 2.0)
    wrong = FeatureTable("w", TABLE.entities, (Field("level", "INT64"),), source=Source(event_timestamp="at"))
    with pytest.raises(SchemaError, match="declared bigint but is int"):
        ingest_batch(spark, wrong, OnlineTable(spark, f"{folder}/w", wrong), df=frame(spark, []))


def test_created_time_breaks_ties_during_ingestion(spark, folder):
    tied = FeatureTable("t", TABLE.entities, TABLE.features[:1], source=Source(event_timestamp="at", created_timestamp="made"))
    df = frame(spark, [("a", 9, 0.5, 1), ("a", 1, 0.5, 1)]).withColumn(
        "made", F.when(F.col("level") == 1, F.lit("2023-05-19")).otherwise(F.lit("2023-05-18")).cast("timestamp_ntz")
    )
    online = OnlineTable(spark, f"{folder}/t", tied)
    ingest_batch(spark, tied, online, df=df)
    assert online.rows().first().level == 1


# --------------------------------------------------------------------------------- streams


def write_messages(spark, folder, name, texts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").parquet(
        f"{folder}/messages"
    )


def message(station, value, at):
    return json.dumps({"station": station, "level": value, "flow": 0.5, "at": hour(at).isoformat()})


STREAM_TABLE = FeatureTable(
    "gauges", TABLE.entities, TABLE.features, source=Source(event_timestamp="at")
)


def run_stream(spark, folder, online, **options):
    stream = read_files(spark, f"{folder}/messages", "value string", files_per_trigger=1)
    query = ingest_stream(
        stream,
        STREAM_TABLE,
        online,
        message=json_message(T.StructType.fromDDL(SCHEMA)),
        checkpoint=f"{folder}/checkpoint",
        dead_letters=f"{folder}/dead",
        trigger={"availableNow": True},
        **options,
    )
    query.awaitTermination()
    return query


def test_stream_upserts_rejects_and_restarts(spark, folder):
    online = OnlineTable(spark, f"{folder}/online", STREAM_TABLE, compact_after=2)
    metrics = IngestMetrics()
    write_messages(spark, folder, 1, [message("a", 1, 5), message("b", 2, 1), "invalid", message(None, 3, 1)])
    write_messages(spark, folder, 2, [message("a", 7, 4), message("b", 8, 2)])
    query = run_stream(spark, folder, online, metrics=metrics)
    assert stored(online) == {"a": (1, 0.5, hour(5)), "b": (8, 0.5, hour(2))}
    assert metrics.total("n_read") == 6 and metrics.total("n_deadletter") == 2 and metrics.total("n_stored") == 4
    assert metrics.frame(spark).count() == 2
    progress = progress_frame(spark, query)
    assert progress.agg(F.sum("input_rows")).first()[0] == 6
    bad = spark.read.parquet(f"{folder}/dead")
    assert sorted(r[0] for r in bad.select(F.explode("_failed_checks")).collect()) == [
        "entity_null", "entity_null", "event_timestamp_null", "malformed",
    ]
    # A restart from the same checkpoint sees only what is new.
    version = online.version
    write_messages(spark, folder, 3, [message("c", 1, 1)])
    run_stream(spark, folder, online, metrics=metrics)
    assert set(stored(online)) == {"a", "b", "c"}
    assert online.version > version
    assert metrics.total("n_read") == 7


def test_dead_letters_of_all_runs_stay_and_are_read_by_run(spark, folder):
    """Two stream runs and a batch run into one folder; run ids that look like numbers stay text."""
    write_messages(spark, folder, 1, [message("a", 1, 5), "invalid", message(None, 3, 1)])
    for number in (1, 2):
        online = OnlineTable(spark, f"{folder}/online{number}", STREAM_TABLE)
        stream = read_files(spark, f"{folder}/messages", "value string")
        ingest_stream(
            stream, STREAM_TABLE, online, message=json_message(T.StructType.fromDDL(SCHEMA)),
            checkpoint=f"{folder}/checkpoint{number}", dead_letters=f"{folder}/dead", trigger={"availableNow": True},
        ).awaitTermination()
    rows = frame(spark, [("a", 1, 0.5, 1), (None, 4, 0.5, 3)])
    ingest_batch(spark, TABLE, OnlineTable(spark, f"{folder}/o", TABLE), df=rows, dead_letters=f"{folder}/dead", run_id="007")
    dead = read_dead_letters(spark, f"{folder}/dead")
    assert sorted(r["count"] for r in dead.groupBy("run_id").count().collect()) == [1, 2, 2]
    assert read_dead_letters(spark, f"{folder}/dead", "007").count() == 1


def test_totals_count_every_batch_once():
    metrics = IngestMetrics(keep=10)
    for batch in range(1500):
        metrics.add(batch, {"n_read": 2, "latest_message": None})
    metrics.add(1499, {"n_read": 3, "latest_message": None})  # replayed
    metrics.add(3, {"n_read": 2, "latest_message": None})
    assert metrics.total("n_read") == 1499 * 2 + 3


def test_a_misspelled_check_is_reported(spark, folder):
    online = OnlineTable(spark, f"{folder}/online", TABLE)
    suite = Suite((expect_between("levle", 0, 1),))
    rows = frame(spark, [("a", 1, 0.5, 1)])
    report = ingest_batch(spark, TABLE, online, df=rows, suite=suite)
    assert report.skipped_checks == (suite.expectations[0].name,) and report.n_stored == 1
    with pytest.raises(SchemaError):
        ingest_batch(spark, TABLE, online, df=rows, suite=suite, strict=True)


def test_replayed_micro_batch_changes_nothing(spark, folder):
    """Without its commit record Spark replays the last batch with the same id."""
    online = OnlineTable(spark, f"{folder}/online", STREAM_TABLE)
    write_messages(spark, folder, 1, [message("a", 1, 5), "invalid"])
    run_stream(spark, folder, online)
    version, rows = online.version, stored(online)
    import os

    for name in os.listdir(f"{folder}/checkpoint/commits"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    run_stream(spark, folder, online)
    assert online.version == version and stored(online) == rows
    assert spark.read.parquet(f"{folder}/dead").count() == 1


def test_stream_suite_modes_and_type_error(spark, folder):
    online = OnlineTable(spark, f"{folder}/online", STREAM_TABLE)
    write_messages(spark, folder, 1, [message("a", 500, 5), message("b", 1, 5), "invalid"])
    suite = Suite((expect_between("level", 0, 100), expect_in_set("station", ("a", "b"))))
    run_stream(spark, folder, online, suite=suite, on_invalid="flag")
    assert set(stored(online)) == {"a", "b"}
    assert spark.read.parquet(f"{folder}/dead").count() == 2
    stream = read_files(spark, f"{folder}/messages", "value string")
    wrong = FeatureTable("w", STREAM_TABLE.entities, (Field("level", "STRING"),), source=Source(event_timestamp="at"))
    with pytest.raises(SchemaError):
        ingest_stream(stream, wrong, online, message=json_message(T.StructType.fromDDL(SCHEMA)), checkpoint=f"{folder}/other")


def test_stream_with_pandas_validation(spark, folder):
    def in_range(batch: pd.DataFrame) -> pd.Series:
        return batch["level"].between(0, 10)

    online = OnlineTable(spark, f"{folder}/online", STREAM_TABLE)
    write_messages(spark, folder, 1, [message(f"c{i}", i, 1) for i in range(21)])
    metrics = IngestMetrics()
    run_stream(spark, folder, online, suite=Suite(function=in_range), metrics=metrics)
    assert metrics.total("n_stored") == 11 and metrics.total("n_deadletter") == 10
    assert len(stored(online)) == 11


# --------------------------------------------------------------------- layouts and sinks

NOWISH = datetime(2024, 1, 1)
PAIR = FeatureTable(
    "moorings", (Field("vessel", "STRING"), Field("berth", "STRING")), (Field("a", "INT32"), Field("b", "STRING")),
    timedelta(seconds=600), project="p",
)


def pair_rows(spark):
    return spark.createDataFrame(
        [("d", "c", 1, None, NOWISH), ("e", "f", 2, "x", NOWISH)],
        "vessel string, berth string, a int, b string, event_timestamp timestamp_ntz",
    )


def test_layouts(spark):
    wide = {r.key: r for r in wide_layout(pair_rows(spark), PAIR).collect()}
    assert set(wide) == {"c#d", "f#e"}
    assert json.loads(bytes(wide["f#e"].value)[4:]) == {"a": 2, "b": "x"}
    assert bytes(wide["c#d"].value)[:4].hex() == wide["c#d"].schema_ref
    schema = T.StructType.fromDDL("a int, b string")
    back = read_wide(wide_layout(pair_rows(spark), PAIR), schema)
    assert sorted(tuple(r) for r in back.select("key", "a").collect()) == [("c#d", 1), ("f#e", 2)]
    with pytest.raises(Exception, match="value of schema"):
        read_wide(wide_layout(pair_rows(spark), PAIR), T.StructType.fromDDL("a int")).collect()
    columns = column_layout(pair_rows(spark), PAIR)
    assert columns.columns == ["key", "moorings", "moorings__schema_ref", "write_time", "ttl"]
    assert {(r.ttl, r.write_time) for r in columns.collect()} == {(600, 1704067200000000)}
    entries = {(r.entity_key, r.field): r.value for r in kv_layout(pair_rows(spark), PAIR).collect()}
    assert entries == {
        ("p#berth#vessel#c#d", "moorings:a"): "1",
        ("p#berth#vessel#c#d", "_ts:moorings"): "2024-01-01 00:00:00",
        ("p#berth#vessel#c#d", "_ex:moorings"): "2024-01-01 00:10:00",
        ("p#berth#vessel#f#e", "moorings:a"): "2",
        ("p#berth#vessel#f#e", "moorings:b"): "x",
        ("p#berth#vessel#f#e", "_ts:moorings"): "2024-01-01 00:00:00",
        ("p#berth#vessel#f#e", "_ex:moorings"): "2024-01-01 00:10:00",
    }
    assert storage_name(PAIR) == "p__berth__vessel"
    alike = spark.createDataFrame(
        [("b", "a#x", 1, None, NOWISH), ("x#b", "a", 2, None, NOWISH), ("\\#b", "a", 3, None, NOWISH)],
        pair_rows(spark).schema,
    )
    assert len({r.key for r in wide_layout(alike, PAIR).collect()}) == 3
    single = FeatureTable("s", (Field("station", "STRING"),), (Field("a", "INT32"),))
    empty = spark.createDataFrame([("", 1, NOWISH), ("k", 2, NOWISH)], "station string, a int, event_timestamp timestamp_ntz")
    assert [r.key for r in wide_layout(empty, single).collect()] == ["k"]


def test_schema_registry_puts_once(spark, folder):
    rows = schema_registry_rows(pair_rows(spark), [PAIR, PAIR.with_features(["a"])])
    refs = {r.schema_ref for r in rows.collect()}
    assert {r.schema_ref for r in wide_layout(pair_rows(spark), PAIR).select("schema_ref").distinct().collect()} <= refs
    for _ in range(2):
        assert {r.schema_ref for r in register_schemas(spark, f"{folder}/r", rows).collect()} == refs
    assert spark.read.parquet(f"{folder}/r").count() == 2


def test_result_sinks(spark, folder):
    df = pair_rows(spark)
    write_result(df, f"{folder}/r")
    write_result(df.limit(1), f"{folder}/r")
    assert spark.read.parquet(f"{folder}/r").count() == 1
    write_result(df, f"{folder}/j", "json")
    assert spark.read.json(f"{folder}/j").count() == 2
    assert times_as_seconds(df).first().event_timestamp == 1704067200
    save_dataset(df, f"{folder}/d", single_file=True)
    assert dataset_bounds(df) == (NOWISH, NOWISH)
    got = read_saved_dataset(
        spark, f"{folder}/d", ["x:a"], ["vessel"], full_feature_names=False, start=NOWISH, end=NOWISH
    )
    assert got.columns == ["vessel", "a", "event_timestamp"] and got.count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        save_dataset(df, f"{folder}/d")


def test_batched_writer_sees_every_row_once(spark, folder):
    out = f"{folder}/sent"
    import os

    os.mkdir(out)

    def send(rows):
        import uuid

        with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(str(r.id) for r in rows))

    seen = []
    assert write_in_batches(spark.range(0, 1000, 1, 3), send, 100, seen.append) == 1000
    texts = [open(f"{out}/{n}").read().splitlines() for n in os.listdir(out)]
    assert max(len(t) for t in texts) <= 100
    assert sorted(int(x) for t in texts for x in t) == list(range(1000))
    assert seen == [1000]


def test_dead_letters_and_batch_store_partitions(spark, folder):
    df = frame(spark, [("a", 1, 0.5, 1), ("a", 1, 0.5, 30)])
    append_to_batch_store(df, f"{folder}/s", "at")
    append_to_batch_store(df, f"{folder}/s", "at")
    back = spark.read.parquet(f"{folder}/s")
    assert back.groupBy("date").count().filter("count = 2").count() == 2
    write_dead_letters(df, f"{folder}/d", "one")
    write_dead_letters(df, f"{folder}/d", "two")
    assert read_dead_letters(spark, f"{folder}/d", "one").count() == 2


def test_metrics(spark):
    df = frame(spark, [("a", 1, 0.5, 1), (None, 1, 0.5, 2)]).withColumnRenamed("at", "event_timestamp")
    counted = row_counters(with_validity(df, TABLE)).first()
    assert tuple(counted) == (2, 1, 1)
    labelled = counters_frame(df, TABLE, counted.asDict()).first()
    assert tuple(labelled) == ("default", "gauges", 2, 1, 1)
    lag = lag_summary(df, hour(3)).first()
    assert (lag.n, lag.min_lag_us, lag.max_lag_us) == (2, 3_600_000_000, 7_200_000_000)
    assert lag.p50_lag_us in (3_600_000_000, 7_200_000_000)


def test_latest_without_keys_and_with_nulls(spark):
    df = frame(spark, [("a", 1, 0.5, 1), ("b", None, 0.5, 2)]).withColumnRenamed("at", "event_timestamp")
    assert tuple(latest_per_key(df, [], ["station", "level"]).first()) == ("b", None, hour(2))
    assert latest_per_key(df.limit(0), [], ["station"]).count() == 0
    assert compact(df, TABLE).columns == ["station", "event_timestamp", "level", "flow"]
    plan = latest_per_key(df, ["station"], ["level"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_checkpoint_folder_without_a_setting(spark):
    """A local session gets its own folder, once; a cluster must name a shared one."""
    from types import SimpleNamespace

    def session(master):
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_checkpoint_folder_comes_from_the_session(spark, folder):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.count() == 5
    assert "x" in df.columns and "Range" not in df._jdf.queryExecution().logical().toString()


# ----------------------------------------------------------------------- engine and jobs


def engine_for(spark, folder):
    rows = frame(spark, [("a", 1, 0.5, 1), ("a", 2, 0.5, 5), ("b", 3, 0.5, 2)])
    other = spark.createDataFrame([("a", 9, hour(0))], "station string, score int, at timestamp_ntz")
    scores = FeatureTable("scores", TABLE.entities, (Field("score", "INT32"),), source=Source(event_timestamp="at"))
    fs = FeatureTable("river", TABLE.entities, TABLE.features, timedelta(hours=2), source=Source(event_timestamp="at"))
    return FeatureEngine(
        spark, [fs, scores], frames={"river": rows, "scores": other}, online_root=f"{folder}/online", buckets=4
    )


def test_engine_history(spark, folder):
    engine = engine_for(spark, folder)
    spine = pd.DataFrame({"station": ["a", "b", "z"], "event_timestamp": [hour(6), hour(6), hour(6)]})
    got = engine.get_historical_features(
        spine,
        ["scores:score", "river:level", "river:flow"],
        on_demand_features={"total": "scores__score + river__level"},
        reduce_by_spine=True,
    )
    assert got.columns == ["station", "event_timestamp", "scores__score", "river__level", "river__flow", "total"]
    assert {r.station: (r.scores__score, r.river__level, r.total) for r in got.collect()} == {
        "a": (9, 2, 11), "b": (None, None, None), "z": (None, None, None),
    }
    with pytest.raises(SchemaError):
        engine.get_historical_features(spine, ["nope:x"])
    assert engine.describe().count() == 3


def test_engine_online(spark, folder):
    engine = engine_for(spark, folder)
    engine.materialize(T0, hour(4))
    keys = [{"station": "b"}, {"station": "z"}, {"station": "a"}]
    refs = ["river:level", "scores:score"]

    def answers(**options):
        found = engine.get_online_features(keys, refs, **options)
        return [(r["river__level"], r["scores__score"]) for r in found]

    assert answers() == [(None, None), (None, None), (None, 9)]  # the river's two hours are long over
    assert answers(as_of=hour(3)) == [(3, None), (None, None), (None, 9)]
    assert answers(include_expired=True) == [(3, None), (None, None), (1, 9)]
    engine.push("river", frame(spark, [("z", 7, 0.5, 9)]))
    found = engine.get_online_features(
        spark.createDataFrame([("z",), ("a",)], "station string"), ["river:level"], full_feature_names=False,
        include_expired=True,
    )
    assert {tuple(r) for r in found.collect()} == {("z", 7), ("a", 1)}
    report = engine.ingest("river", T0, hour(50))
    assert report.n_stored == 3
    assert engine.update_online(["scores"]) == ["river"]


def test_push_through_mapping(spark, folder):
    spend = FeatureTable("s", TABLE.entities, (Field("x", "INT32"),), source=Source(event_timestamp="at", field_mapping={"x": "level * 2"}))
    online = OnlineTable(spark, f"{folder}/s", spend)
    push(spend, online, frame(spark, [("a", 4, 0.5, 1)]))
    assert online.rows().first().x == 8


def test_retrieval_job(spark, folder):
    frame(spark, [("a", 1, 0.5, 1), ("b", 2, 0.5, 1)]).write.parquet(f"{folder}/src")
    spark.createDataFrame([("a", hour(2))], "id string, event_timestamp timestamp_ntz").write.parquet(f"{folder}/spine")
    file = {"format": {"json_class": "ParquetFormat"}, "path": f"{folder}/src", "event_timestamp_column": "at"}
    spine = {**file, "path": f"{folder}/spine", "event_timestamp_column": "event_timestamp", "field_mapping": {"station": "id"}}
    config = {
        "tables": [
            {
                "name": "river",
                "entities": [{"name": "station", "type": "STRING"}],
                "features": [{"name": "level", "type": "INT32"}],
                "max_age": 86400,
                "source": {"file": file},
            }
        ],
        "spine": {"file": spine},
        "features": ["river:level"],
        "output": {"format": "parquet", "path": f"{folder}/out"},
    }
    assert retrieve_job.run(spark, config) == f"{folder}/out"
    assert [tuple(r) for r in spark.read.parquet(f"{folder}/out").collect()] == [("a", hour(2), 1)]


def test_ingestion_job(spark, folder):
    frame(spark, [("a", 1, 0.5, 1), ("b", 200, 0.5, 1)]).write.parquet(f"{folder}/src")
    config = {
        "mode": "offline",
        "table": {
            "name": "river",
            "entities": [{"name": "station", "type": "STRING"}],
            "features": [{"name": "level", "type": "INT32"}],
            "max_age": 60,
            "labels": {"gcThresholdSec": "7200"},
            "source": {"file": {"format": "parquet", "path": f"{folder}/src", "event_timestamp_column": "at"}},
        },
        "online": {"path": f"{folder}/online", "buckets": 2},
        "start": "2023-05-17T00:00:00",
        "suite": [{"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "level", "max_value": 100}}],
    }
    report = ingest_job.run(spark, config)
    assert (report.n_read, report.n_stored) == (2, 1)
    online = OnlineTable(spark, f"{folder}/online", TABLE)
    assert online.rows().select("station", "expiry_timestamp").first() == ("a", hour(3))
    write_messages(spark, folder, 1, [message("c", 5, 1)])
    streaming = {
        **config,
        "mode": "online",
        "stream": {"format": "parquet", "path": f"{folder}/messages", "schema": "value string"},
        "message": {"format": "json", "column": "value", "schema": SCHEMA},
        "checkpoint": f"{folder}/checkpoint",
        "trigger_seconds": "once",
    }
    ingest_job.run(spark, streaming).awaitTermination()
    assert {r.station for r in online.rows().collect()} == {"a", "c"}
    with pytest.raises(ValueError):
        ingest_job.run(spark, {**config, "mode": "sideways"})


def test_ingestion_job_with_a_stored_function(spark, folder):
    from tidemark.functions.shipped import load_function, save_function

    limit = 10

    def small(batch):
        return batch["level"] < limit

    save_function(spark, small, f"{folder}/small.pickle")
    with pytest.raises(FileExistsError):
        save_function(spark, small, f"{folder}/small.pickle")
    assert load_function(spark, f"{folder}/small.pickle")(pd.DataFrame({"level": [1, 20]})).tolist() == [True, False]
    frame(spark, [("a", 1, 0.5, 1), ("b", 200, 0.5, 1)]).write.parquet(f"{folder}/src")
    config = {
        "mode": "offline",
        "table": {
            "name": "river",
            "entities": [{"name": "station", "type": "STRING"}],
            "features": [{"name": "level", "type": "INT32"}],
            "source": {"file": {"format": "parquet", "path": f"{folder}/src", "event_timestamp_column": "at"}},
        },
        "online": {"path": f"{folder}/online"},
        "validation_function": f"{folder}/small.pickle",
    }
    assert ingest_job.run(spark, config).n_stored == 1


def test_on_demand_pandas(spark):
    from tidemark.operators.sinks import on_demand_pandas

    def ratio(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ratio": rows["level"] / rows["flow"], "twice": rows["level"] * 2})

    out = on_demand_pandas(frame(spark, [("a", 1, 0.5, 1), ("b", 3, 0.5, 1)]), ratio, "ratio double, twice long")
    assert {(r.station, r.ratio, r.twice) for r in out.collect()} == {("a", 2.0, 2), ("b", 6.0, 6)}
