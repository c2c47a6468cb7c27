"""Snapshots and key bitmaps: the same results from less history and fewer feature rows."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import CommitConflict, FeatureEngine, FeatureInput, FeatureTable, Field, SchemaError, SnapshotStore, Source, multi_as_of
from tidemark.operators import reduce
from tidemark.operators.reduce import semi_reduce, sketch_reduce
from tidemark.operators.sinks import append_to_batch_store
from tidemark.plans import bounds as bounds_module
from tidemark.plans.bounds import measure_spine
from tidemark.plans.keyset import LEAST_WORDS, KeySet, key_hash, words_for

T0 = datetime(2024, 3, 1)
KEYS = (Field("boat", "STRING"), Field("berth", "INT32"))
FEATURES = (Field("depth", "DOUBLE"), Field("crew", "INT64"), Field("note", "STRING"))
ROWS = "boat string, berth int, depth double, crew long, note string, event_timestamp timestamp_ntz, created_timestamp timestamp_ntz, stop int"


def _table(max_age=None, features=FEATURES, name="logbook"):
    return FeatureTable(name, KEYS, features, max_age, tie_break=("stop",))


def _log(n, seed, first=0, last=20):
    """Log lines with few keys and few times, so that many tie in all but their values."""
    draw = random.Random(seed)
    hours = lambda: T0 + timedelta(hours=6 * draw.randint(4 * first, 4 * last))
    return [
        (
            draw.choice(["ann", "bea", None]), draw.randint(0, 2), draw.choice([1.5, 2.5, None]), draw.randint(0, 3),
            draw.choice(["x", "y", None]), hours() if draw.random() < 0.95 else None,
            draw.choice([T0, T0 + timedelta(days=1), None]), draw.choice([0, 1, None]),
        )
        for _ in range(n)
    ]


def _spine(spark, first, n=60):
    draw = random.Random(7)
    rows = [(i, draw.choice(["ann", "bea", "cat"]), draw.randint(0, 2), T0 + timedelta(hours=draw.randint(24 * first, 24 * 22))) for i in range(n)]
    return spark.createDataFrame(rows, "id int, boat string, berth int, at timestamp_ntz")


def _same(left, right):
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.mark.parametrize("max_age", [None, timedelta(days=3), timedelta(days=9)])
@pytest.mark.parametrize("features", [FEATURES, FEATURES[2:], FEATURES[1::-1]])
def test_a_snapshot_stands_for_the_history_before_it(spark, folder, max_age, features):
    log = spark.createDataFrame(_log(400, 1), ROWS)
    store = SnapshotStore(spark, f"{folder}/s", _table(), created=True)
    for cut in (date(2024, 3, 4), date(2024, 3, 10), datetime(2024, 3, 7, 12)):
        store.build(log, cut)
    assert store.cuts() == [datetime(2024, 3, 5), datetime(2024, 3, 7, 12), datetime(2024, 3, 11)]
    table = _table(max_age, features)
    # Only rows from the cut on are offered besides: what was before can not be read.
    for first, cut in ((12, datetime(2024, 3, 11)), (6, datetime(2024, 3, 5)), (3, None)):
        spine = _spine(spark, first)
        expected = multi_as_of(spine, "at", [FeatureInput(table, log)])
        oldest = measure_spine(spine, "at").first - (max_age or timedelta(days=999))
        rest = log if cut is None or oldest >= cut else log.filter(F.col("event_timestamp") >= F.lit(cut).cast("timestamp_ntz"))
        _same(multi_as_of(spine, "at", [FeatureInput(table, rest, snapshots=store)]), expected)


def test_late_rows_reach_all_snapshots_after_them(spark, folder):
    log, late = spark.createDataFrame(_log(200, 2), ROWS), spark.createDataFrame(_log(80, 3, 0, 8), ROWS)
    store = SnapshotStore(spark, f"{folder}/s", _table(), created=True)
    assert store.absorb(late) == 0
    for day in (2, 6, 12):
        store.build(log, T0 + timedelta(days=day))
    assert store.absorb(late) == 3
    assert store.absorb(spark.createDataFrame(_log(9, 4, 7, 8), ROWS).limit(0)) == 0
    spine = _spine(spark, 13)
    expected = multi_as_of(spine, "at", [FeatureInput(_table(), log.union(late))])
    _same(multi_as_of(spine, "at", [FeatureInput(_table(), log.union(late), snapshots=store)]), expected)


def test_a_store_of_other_rows_is_left_alone(spark, folder):
    log = spark.createDataFrame(_log(50, 5), ROWS)
    store = SnapshotStore(spark, f"{folder}/s", _table(), created=True, origin={"path": "a"})
    store.build(log, T0 + timedelta(days=5))
    first = T0 + timedelta(days=9)
    assert store.before(first, _table(), True) and store.before(first, _table(features=FEATURES[:1]), True)
    assert store.before(T0 + timedelta(days=4), _table(), True) is None
    assert store.before(first, _table(), False) is None
    assert store.before(first, _table(features=(*FEATURES, Field("new", "INT64"))), True) is None
    assert store.before(first, _table(features=(Field("depth", "FLOAT"),)), True) is None
    other = SnapshotStore(spark, f"{folder}/s", _table(), created=True, origin={"path": "b"})
    assert other.before(first, _table(), True) is None
    with pytest.raises(SchemaError, match="another source"):
        other.build(log, T0 + timedelta(days=6))
    with pytest.raises(SchemaError, match="lack"):
        SnapshotStore(spark, f"{folder}/s", _table(features=(*FEATURES, Field("new", "INT64"))), created=True, origin={"path": "a"}).build(log, first)


def test_a_snapshot_of_a_changed_one_is_not_committed(spark, folder, monkeypatch):
    log = spark.createDataFrame(_log(50, 6), ROWS)
    store, rival = (SnapshotStore(spark, f"{folder}/s", _table(), created=True) for _ in range(2))
    store.build(log, T0 + timedelta(days=3))
    write = store._write

    def slow(rows):
        monkeypatch.setattr(store, "_write", write)
        rival.absorb(log)
        return write(rows)

    monkeypatch.setattr(store, "_write", slow)
    with pytest.raises(CommitConflict):
        store.build(log, T0 + timedelta(days=8))
    assert len(store.cuts()) == 1
    store.build(log, T0 + timedelta(days=8))
    store.keep_last(1)
    store.vacuum(retain=timedelta(0))
    assert store.cuts() == [T0 + timedelta(days=8)]
    assert store.before(T0 + timedelta(days=8), _table(), True).rows.count() > 0


def test_days_before_the_snapshot_are_not_in_the_plan(spark, folder):
    log = spark.createDataFrame(_log(300, 8), ROWS).na.drop(subset=["event_timestamp"])
    append_to_batch_store(log, f"{folder}/store")
    source = Source(path=f"{folder}/store", event_timestamp="event_timestamp", created_timestamp="created_timestamp", date_partition="date")
    table = FeatureTable("logbook", KEYS, FEATURES, source=source, tie_break=("stop",))
    plain = FeatureEngine(spark, [table])
    engine = FeatureEngine(spark, [table], snapshot_root=f"{folder}/snapshots")
    engine.snapshot(date(2024, 3, 6))
    engine.snapshot(date(2024, 3, 10))
    spine, refs = _spine(spark, 12), ["logbook:depth", "logbook:note"]
    got = engine.get_historical_features(spine, refs, spine_ts="at")
    plan = got._jdf.queryExecution().explainString(got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "date#" in plan and ">= 2024-03-11" in plan[plan.index("PartitionFilters") :]
    assert ">= 2024-03-11" not in plain.get_historical_features(spine, refs, spine_ts="at")._jdf.queryExecution().toString()
    _same(got, plain.get_historical_features(spine, refs, spine_ts="at"))


# ------------------------------------------------------------------------------ key bitmaps


def test_a_bitmap_loses_no_row_and_passes_few_others(spark):
    rows = spark.range(60_000).select(F.col("id").alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    rows = rows.union(spark.createDataFrame([(None, "1"), (3, None)], "a long, b string"))
    spine = rows.filter("a % 10 = 3").union(rows.filter("a = 3"))
    possible = sketch_reduce(rows, spine, ["a", "b"])
    exact = semi_reduce(rows, spine, ["a", "b"])
    assert possible.columns == rows.columns
    assert semi_reduce(possible, spine, ["a", "b"]).exceptAll(exact).count() == exact.exceptAll(possible).count() == 0
    assert possible.count() - exact.count() < 0.03 * rows.count()
    plan = possible._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_bitmap_is_bounded_whatever_the_keys(spark):
    assert words_for(0) == LEAST_WORDS and words_for(10**12, 256) == 256 and words_for(1000) == 256
    keys = spark.range(50_000).select(F.col("id").alias("k"))
    full = KeySet.of(keys, key_hash(["k"]), 50_000, most=64)
    assert full.bitmap.count() <= 64
    assert full.keep_possible(keys, key_hash(["k"])).count() == 50_000
    assert KeySet.of(keys.limit(0), key_hash(["k"]), 0).keep_possible(keys, key_hash(["k"])).count() == 0


def test_keys_are_broadcast_by_their_measured_bytes(spark, monkeypatch):
    spine = spark.range(2_000).select(F.repeat(F.lit("k"), 1_000).alias("wide"), F.col("id").alias("narrow"), F.lit(T0).cast("timestamp_ntz").alias("at"))
    measured = measure_spine(spine, "at", ["wide", "narrow"])
    assert measured.key_bytes["wide"] == 2_000_000 and measured.rows == 2_000
    monkeypatch.setattr(bounds_module, "_ROW_BYTES", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        assert measured.keys_fit(spark, ["narrow"]) and not measured.keys_fit(spark, ["wide", "narrow"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("few", [True, False])
def test_joins_by_bitmap_give_the_same_rows(spark, monkeypatch, few):
    from tidemark.operators import asof

    log = spark.createDataFrame(_log(300, 9), ROWS)
    spine = _spine(spark, 2)
    expected = multi_as_of(spine, "at", [FeatureInput(_table(), log)], reduce_by_spine=False)
    monkeypatch.setattr(bounds_module.SpineBounds, "keys_fit", lambda *args: False)
    if not few:
        monkeypatch.setattr(asof, "SKETCH_KEYS", 0)
    got = multi_as_of(spine, "at", [FeatureInput(_table(), log)])
    assert ("__tm_word" in got._jdf.queryExecution().toString()) == few
    _same(got, expected)
    assert reduce.SKETCH_KEYS >= 1_000_000
