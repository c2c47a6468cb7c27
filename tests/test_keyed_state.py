"""Keyed stream state against plain Python and against the online table's fold."""

import random
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import FeatureTable, Field, fold_batches
from tidemark.sources.stream import read_files
from tidemark.streaming import state as keyed
from tidemark.streaming.state import EXPIRED, _rank, keep_state, state_rows

T0 = datetime(2021, 6, 1)
SCHEMA = "lane int, side string, event_timestamp timestamp_ntz, speed double, plate string, seen long"
KEYS = (Field("lane", "INT32"), Field("side", "STRING"))
FEATURES = (Field("speed", "DOUBLE"), Field("plate", "STRING"))


def _table(age=None):
    return FeatureTable("road", KEYS, FEATURES, age, tie_break=("seen",))


def _batches(n, size, seed):
    draw = random.Random(seed)
    pick = lambda *values: draw.choice(values)
    return [
        [
            (
                pick(1, 2, 3, None), pick("n", "s"), T0 + timedelta(minutes=draw.randint(0, 40) + 15 * i, microseconds=draw.randint(0, 3)),
                pick(None, 1.0, 2.0, float("nan")), pick(None, "é", "z"), pick(None, 1, 2),
            )
            for _ in range(size)
        ]
        for i in range(n)
    ]


def _stream(spark, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.01)  # files are taken in the order of their times
    return read_files(spark, f"{folder}/in", T.StructType.fromDDL(SCHEMA), files_per_trigger=1, latestFirst="false")


def _state(df):
    return {(r.lane, r.side): (r.event_timestamp, str(r.speed), r.plate) for r in df.collect()}


def test_state_is_the_fold_of_the_batches(spark, folder):
    batches, changes = _batches(3, 25, 1), []
    stream = _stream(spark, folder, batches)
    sink = lambda batch, number: changes.append((number, batch.collect()))
    run = keep_state(stream, _table(), checkpoint=f"{folder}/c", sink=sink, trigger={"availableNow": True}, partitions=2)
    run.awaitTermination()
    complete = [[r for r in rows if r[0] is not None] for rows in batches]
    folded = fold_batches([spark.createDataFrame(rows, SCHEMA) for rows in complete], _table())
    got = state_rows(spark, f"{folder}/c", _table())
    assert got.columns == ["lane", "side", "event_timestamp", "speed", "plate", "expiry_timestamp"]
    assert _state(got) == _state(folded)
    # The changes lead to the same state.
    last = {(r.lane, r.side): (r.event_timestamp, str(r.speed), r.plate) for _, rows in sorted(changes) for r in rows}
    assert last == _state(folded) and not any(r[EXPIRED] for _, rows in changes for r in rows)


def test_values_leave_with_the_clock_of_the_events(spark, folder):
    """Also those of keys that send nothing more, and what comes later than the age."""
    age = timedelta(minutes=30)
    rows = lambda lane, minute, speed: (lane, "n", T0 + timedelta(minutes=minute), speed, None, 1)
    batches = [[rows(1, 0, 1.0), rows(2, 20, 2.0)], [rows(2, 45, 3.0), rows(3, 44, 3.5)], [rows(1, 5, 9.0), rows(3, 40, 9.0)]]
    expired = []

    def sink(batch, number):
        expired.extend((r.lane, r.speed) for r in batch.collect() if r[EXPIRED])

    run = keep_state(_stream(spark, folder, batches), _table(age), checkpoint=f"{folder}/c", sink=sink, trigger={"availableNow": True}, partitions=2)
    run.awaitTermination()
    assert {lane for lane, _ in expired} == {1}
    found = {k[0]: v[:2] for k, v in _state(state_rows(spark, f"{folder}/c", _table(age))).items()}
    assert found == {2: (T0 + timedelta(minutes=45), "3.0"), 3: (T0 + timedelta(minutes=44), "3.5")}
    at = lambda minutes, micros=0: T0 + timedelta(minutes=minutes, microseconds=micros)
    left = lambda as_of: {k[0] for k in _state(state_rows(spark, f"{folder}/c", _table(age), as_of))}
    assert (left(at(74, -1)), left(at(74)), left(at(75))) == ({2, 3}, {2}, set())


def test_values_leave_with_the_clock_of_the_machine(spark, folder):
    table = _table(timedelta(seconds=4))
    stream = _stream(spark, folder, [[(1, "n", T0, 1.0, "a", 1)]])
    with pytest.raises(ValueError, match="processing time"):
        keep_state(stream, table, checkpoint=f"{folder}/c", clock="machine", trigger={"availableNow": True})
    seen = []
    sink = lambda batch, number: seen.extend(batch.collect())
    run = keep_state(stream, table, checkpoint=f"{folder}/c", sink=sink, clock="machine", trigger={"processingTime": "1 second"}, partitions=1)
    try:
        until = time.time() + 90
        while time.time() < until and not seen:
            time.sleep(0.5)
        assert [(r.lane, r.speed) for r in seen] == [(1, 1.0)]
        time.sleep(6)
    finally:
        run.stop()
    # Its time is over: a read of the state leaves it out.
    assert state_rows(spark, f"{folder}/c", table, datetime(2030, 1, 1)).collect() == []


def test_ranks_order_as_spark_does():
    values = [None, -1.0, 0.5, float("inf"), float("nan")]
    assert sorted(reversed(values), key=_rank)[:4] == values[:4]
    assert _rank([None, 1]) < _rank([0, 1]) < _rank([0, 1, 0]) and _rank(b"a") < _rank(bytearray(b"b"))
    with pytest.raises(ValueError, match="clock"):
        keep_state(None, _table(), checkpoint="c", clock="sundial")


def test_many_keys_in_a_group_are_the_fold_as_well(spark, folder):
    batches = [[(draw * 7 % 40, *row[1:]) for draw, row in enumerate(rows)] for rows in _batches(2, 150, 2)]
    run = keep_state(_stream(spark, folder, batches), _table(), checkpoint=f"{folder}/c", trigger={"availableNow": True}, partitions=2, groups=2)
    run.awaitTermination()
    folded = fold_batches([spark.createDataFrame(rows, SCHEMA) for rows in batches], _table())
    got = _state(state_rows(spark, f"{folder}/c", _table()))
    assert got == _state(folded) and len(got) > 60
    assert spark.read.format("statestore").option("stateVarName", "current").load(f"{folder}/c").count() <= 2


class _Store:
    """A state handle in memory that counts its calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def listTimers(self):
        self.calls += 1
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def getCurrentWatermarkInMs(self):
        return self.clock


def _processor(store, age):
    entry = T.StructType.fromDDL(f"lane int, {keyed._AT} long, speed double")
    processor = keyed.LatestValues(["lane"], ["speed"], entry, age, age is not None)
    processor.init(store)
    return processor


def _row(lane, at, speed):
    return Row("lane", keyed._AT, keyed._TIES, "speed")(lane, at, (0,), speed)


def test_calls_to_the_store_do_not_grow_with_the_keys():
    for age in (None, 16_000_000):
        store = _Store()
        store.clock = 0
        processor = _processor(store, age)
        for batch in range(2):
            list(processor.handleInputRows((0,), iter([_row(lane, 1_000_000 + batch, 1.0) for lane in range(500)]), store))
        assert len(store.value[0]) == 500 and store.calls <= 8


def test_neighbours_of_what_leaves_stay():
    store, at = _Store(), 1_000_000
    store.clock = 0
    processor = _processor(store, 16_000_000)
    list(processor.handleInputRows((0,), iter([_row(1, at, 1.0), _row(2, 9 * at, 2.0), _row(3, at, 3.0)]), store))
    assert store.timers == {2_000, 10_000}
    store.clock = 1_500  # no timer yet, but what is past its age gives nothing to newer rows
    changes = [(r.lane, r.speed, r[EXPIRED]) for r in processor.handleInputRows((0,), iter([_row(1, 8 * at, None)]), store)]
    assert changes == [(1, None, False), (3, 3.0, True)]
    store.clock = 9_000
    assert [(r.lane, r[EXPIRED]) for r in processor.handleExpiredTimer((0,), store, None)] == [(1, True)]
    assert store.value == ([(2, 9 * at, 2.0)],)
    assert list(processor.handleExpiredTimer((0,), store, None)) == []


def test_tasks_hold_more_keys_than_rows_at_a_time(monkeypatch):
    """However many keys: each leaves a task with its newest row only, while they fit its memory."""
    monkeypatch.setattr(keyed, "HELD_ROWS", 100)
    rows = [(i % 90, i) for i in range(900)]
    kept = []

    class Batches:
        schema = None

        def mapInArrow(self, function, schema):
            table = pa.table({"lane": [r[0] for r in rows], keyed._AT: [r[1] for r in rows]})
            for batch in function(iter(table.to_batches(max_chunksize=30))):
                kept.extend(batch.to_pylist())

    keyed._newest_of_task(Batches(), ["lane"])
    assert sorted((r["lane"], r[keyed._AT]) for r in kept) == [(i, 810 + i) for i in range(90)]


def test_tie_breaks_decide_between_rows_of_one_time(spark, folder):
    """Not the features' values, also where the keys are lists."""
    rows = [(1, "n", T0, 9.0, "a", 1), (1, "n", T0, 1.0, "z", 2), (2, "n", T0, 9.0, "z", None), (2, "n", T0, 1.0, "a", -1)]
    for name, keys in (("plain", KEYS), ("lists", (Field("lane", "INT32_LIST"), KEYS[1]))):
        stream = _stream(spark, f"{folder}/{name}", [rows])
        table = FeatureTable("road", keys, FEATURES, None, tie_break=("seen",))
        stream = stream.withColumn("lane", F.array("lane")) if name == "lists" else stream
        keep_state(stream, table, checkpoint=f"{folder}/{name}/c", trigger={"availableNow": True}, partitions=1).awaitTermination()
        assert sorted((r.speed, r.plate) for r in state_rows(spark, f"{folder}/{name}/c", table).collect()) == [(1.0, "a"), (1.0, "z")]


def test_a_group_has_its_next_timers_only_and_is_read_once_for_those_due():
    store = _Store()
    store.clock = 0
    processor = _processor(store, 16_000_000)
    list(processor.handleInputRows((0,), iter([_row(lane, 50_000 * lane, 1.0) for lane in range(300)]), store))
    assert len(store.timers) == 2 and store.calls <= 5
    left = []
    for clock in range(2_000, 20_000, 2_000):
        store.clock, calls = clock, store.calls
        due = sorted(t for t in store.timers if t <= clock)
        for timer in due:
            left += [r.lane for r in processor.handleExpiredTimer((0,), store, None)]
            store.timers.discard(timer)
        assert store.calls - calls <= 4 and left == [lane for lane in range(300) if 50 * lane + 1 <= clock]
    assert store.value is None and not store.timers


def test_rows_past_their_age_are_passed_over():
    store = _Store()
    store.clock = 0
    processor = _processor(store, 16_000_000)
    list(processor.handleInputRows((0,), iter([_row(1, 2_000_000, 1.0)]), store))
    store.clock = 5_000
    changes = processor.handleInputRows((0,), iter([_row(1, 3_000_000, 2.0), _row(2, 3_000_000, 2.0)]), store)
    assert [(r.lane, r.speed, r[EXPIRED]) for r in changes] == [(1, 1.0, True)] and store.value is None


def test_lists_have_all_rows_of_their_group(monkeypatch):
    monkeypatch.setattr(keyed, "PACKED", 4)
    groups = [i * 7 % 5 for i in range(60)] + [9]
    batch = pa.RecordBatch.from_pydict({"lane": list(range(61)), keyed._AT: [i * 11 % 61 for i in range(61)], keyed._GROUP: groups})
    lists = keyed._pack(batch).to_pylist()
    assert len(lists) == 16 and all(1 <= len(r[keyed._ROWS]) <= 4 for r in lists)
    assert all(r[keyed._AT] == max(v[keyed._AT] for v in r[keyed._ROWS]) for r in lists)
    assert sorted((v["lane"], r[keyed._GROUP]) for r in lists for v in r[keyed._ROWS]) == list(enumerate(groups))
