"""Current values as keyed stream state: what a stream has last said of each key.

Keys are dealt into hash groups, and the values of a group's keys are one state of a
`transformWithState` query in RocksDB, next to the task that sees the group: a micro-batch reads and
writes the states of its own keys' groups only, and a row older than its key's values changes
nothing. Every call to the state store costs the same, so a group costs what a key alone would;
what is written again with a changed key are its neighbours, some keys or some dozens with enough
groups. Before that, tasks leave out what is older than another row of its key, in Arrow batches
before and after a shuffle by group, so that the state's tasks get a key's newest rows only, however
many it has in a micro-batch, and get them as lists of some dozens. Values that are past their max
age leave by themselves, by the clock of the events or by that of the machine (timers of the groups;
a group has its next ones only). The state is read as a frame from the query's checkpoint, without
running it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.functions.times import as_time, naive_utc, time_literal
from tidemark.model import EVENT_TS, FeatureTable
from tidemark.operators.online import with_expiry
from tidemark.operators.project import effective_max_age
from tidemark.operators.validate import entities_valid

_AT = "__tm_at"
_TIES = "__tm_ties"
_GROUP = "__tm_group"
_ROWS = "__tm_rows"
_STATE = "current"
_ENTRIES = "entries"
_UNTIL = "__tm_until"
EXPIRED = "expired"
# Spark's settings and its RocksDB provider.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS = "spark.sql.shuffle.partitions"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# What a task holds while it looks for the newest rows: so many rows, or twice as many as it last kept.
HELD_ROWS, HELD_BYTES = 1 << 17, 64 << 20
# Hash groups of keys.
GROUPS = 1 << 13
# Timers that a group can have in a max age, and those that it has at a time.
TIMERS, AHEAD = 16, 2
# Rows of a list: a Python worker gets Arrow batches of many lists.
PACKED = 32


def _rank(value) -> tuple:
    """Orders values as Spark does: null first, NaN last."""
    if value is None:
        return (0,)
    if isinstance(value, float) and math.isnan(value):
        return (2,)
    if isinstance(value, (list, tuple)):
        return (1, tuple(_rank(v) for v in value))
    return (1, bytes(value) if isinstance(value, (bytes, bytearray)) else value)


def _newest(table: pa.Table, keys: list[str]) -> pa.Table:
    """The rows that no other row of their key is younger than; all that tie stay."""
    codes = np.zeros(table.num_rows, np.int64)
    for name in keys:
        column = table[name].combine_chunks().dictionary_encode()
        codes = codes * len(column.dictionary) + column.indices.to_numpy()
        if len(keys) > 1:
            codes = np.unique(codes, return_inverse=True)[1]
    at = table[_AT].to_numpy()
    last = np.full(codes.max(initial=-1) + 1, np.iinfo(np.int64).min)
    np.maximum.at(last, codes, at)
    return table.filter(pa.array(at == last[codes])).combine_chunks()


def _newest_batches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    held, n, size, most = [], 0, 0, HELD_ROWS
    for batch in batches:
        held.append(batch)
        n, size = n + batch.num_rows, size + batch.nbytes
        if n > most or size > HELD_BYTES:
            kept = _newest(pa.Table.from_batches(held), keys)
            held = kept.to_batches()
            if 2 * kept.nbytes > HELD_BYTES:  # many keys: begin again
                yield from held
                held = []
            n, size = sum(b.num_rows for b in held), sum(b.nbytes for b in held)
            most = max(HELD_ROWS, 2 * n)
    if held:
        yield from _newest(pa.Table.from_batches(held), keys).to_batches()


def _newest_of_task(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without those that a younger row of the same key, among what a task holds, makes void."""
    return rows.mapInArrow(lambda batches: _newest_batches(batches, keys), rows.schema)


def _pack(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of each group as lists of at most PACKED, with the newest time of each list."""
    groups = batch.column(_GROUP).to_numpy()
    order = np.argsort(groups, kind="stable")
    batch, groups = batch.take(pa.array(order)), groups[order]
    nth = np.arange(len(groups))
    begins = np.maximum.accumulate(np.where(np.diff(groups, prepend=-1) != 0, nth, 0))
    starts = np.flatnonzero((nth - begins) % PACKED == 0)
    names = [n for n in batch.schema.names if n != _GROUP]
    rows = pa.StructArray.from_arrays([batch.column(n) for n in names], names=names)
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(groups)), pa.int32()), rows)
    newest = np.maximum.reduceat(batch.column(_AT).to_numpy(), starts)
    return pa.RecordBatch.from_arrays([pa.array(groups[starts]), pa.array(newest), lists], names=[_GROUP, _AT, _ROWS])


def _packed(rows: DataFrame, keys: list[str] | None) -> DataFrame:
    """Lists of a group's rows; with keys, of the newest of each among what a task holds."""
    row = T.StructType([f for f in rows.schema if f.name != _GROUP])
    schema = T.StructType([rows.schema[_GROUP], rows.schema[_AT], T.StructField(_ROWS, T.ArrayType(row))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _newest_batches(batches, keys) if keys else batches:
            if batch.num_rows:
                yield _pack(batch)

    return rows.mapInArrow(pack, schema)


class LatestValues(StatefulProcessor):
    """Per key: the newest event time and, for each feature, the last value that was not null.

    The grouping key is a hash group of keys; `entry` is what its state has of each: key, time,
    features and, by the machine's clock, when that leaves. Of a key's rows in a micro-batch only
    the newest counts. `age` in microseconds says how long values stay; `by_events` says by which
    clock.
    """

    def __init__(self, keys: list[str], features: list[str], entry: T.StructType, age: int | None, by_events: bool) -> None:
        self._keys = keys
        self._features = features
        self._schema = T.StructType([T.StructField(_ENTRIES, T.ArrayType(entry))])
        self._age = age
        self._by_events = by_events
        self._time, self._end = len(keys), len(keys) + 1 + len(features)
        self._change = Row(*keys, _AT, *features, EXPIRED)

    def init(self, handle) -> None:
        self._handle = handle
        self._current = handle.getValueState(_STATE, self._schema)
        self._seen: dict[tuple, int] = {}  # groups of the task that have nothing past its age, by the clock

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest: dict[tuple, tuple] = {}
        for row in rows:
            own = tuple([row[k] for k in self._keys])
            name = _name(own)
            if name not in newest or self._order(newest[name][1]) < self._order(row):
                newest[name] = own, row
        clock = self._clock(timerValues)
        entries, gone = self._parted(clock)
        timers = self._timers([*entries, *gone])
        entries = {_name(e[: self._time]): e for e in entries}
        changed = {}
        for name, (own, row) in newest.items():
            before = entries.get(name)
            if before is not None and row[_AT] < before[self._time]:
                continue
            old = [None] * len(self._features) if before is None else before[self._time + 1 : self._end]
            values = [o if row[f] is None else row[f] for f, o in zip(self._features, old)]
            until = [] if self._age is None or self._by_events else [clock + max(1, self._age // 1000)]
            entry = (*own, row[_AT], *values, *until)
            if self._age is None or self._until(entry) > clock:  # else it comes when its time is over
                entries[name] = changed[name] = entry
        if changed or gone:
            self._keep(list(entries.values()), timers)
        if self._age is not None:
            self._seen[tuple(key)] = clock
        yield from (self._row(e, False) for e in changed.values())
        yield from (self._row(e, True) for e in gone if _name(e[: self._time]) not in changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        clock = self._clock(timerValues)
        if self._seen.get(tuple(key)) == clock:  # its rows or an earlier timer have led to the group
            return
        self._seen[tuple(key)] = clock
        entries, gone = self._parted(clock)
        if gone:
            self._keep(entries, self._timers([*entries, *gone]))
            yield from (self._row(e, True) for e in gone)

    def _order(self, row) -> tuple:
        ties = row[_TIES].values() if isinstance(row[_TIES], dict) else row[_TIES]
        return row[_AT], [_rank(v) for v in ties], [_rank(row[f]) for f in self._features]

    def _clock(self, timerValues) -> int | None:
        if self._age is None:
            return None
        return timerValues.getCurrentWatermarkInMs() if self._by_events else timerValues.getCurrentProcessingTimeInMs()

    def _parted(self, clock: int | None) -> tuple[list[tuple], list[tuple]]:
        """The group's entries, and those of them whose time is over."""
        stored = self._current.get()
        entries = [] if stored is None else [tuple(e) for e in stored[0]]
        if clock is None:
            return entries, []
        return [e for e in entries if self._until(e) > clock], [e for e in entries if self._until(e) <= clock]

    def _keep(self, entries: list[tuple], timers: set[int]) -> None:
        """Writes the group's entries; `timers` are those that the entries before have led to."""
        if entries:
            self._current.update((entries,))
        else:
            self._current.clear()
        for timer in self._timers(entries) - timers:
            self._handle.registerTimer(timer)

    def _timers(self, entries: list[tuple]) -> set[int]:
        """The next timers of a group: when the first is due, its entries lead to others."""
        return set() if self._age is None else set(sorted({self._timer(e) for e in entries})[:AHEAD])

    def _until(self, entry: tuple) -> int:
        # The watermark is the age behind the events, so a value leaves when it passes its time.
        return entry[self._time] // 1000 + 1 if self._by_events else entry[-1]

    def _timer(self, entry: tuple) -> int:
        """The first of the group's timers, in milliseconds, by which the entry is to leave."""
        step = max(1, self._age // 1000 // TIMERS)
        return -(-self._until(entry) // step) * step

    def _row(self, entry: tuple, expired: bool) -> Row:
        return self._change(*entry[: self._end], expired)

    def close(self) -> None:
        pass


class _PackedValues(LatestValues):
    """Gets its rows as lists."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from super().handleInputRows(key, (r for row in rows for r in row[_ROWS]), timerValues)


def _name(key) -> tuple:
    """A key as something that equal keys, and no others, have in common."""
    return tuple(_rank(v) for v in key)


def _unsigned(name: str, kind: T.DataType):
    """A key's column; zeros lose their sign, as they do where Spark groups by them."""
    return (F.col(name) + F.lit(0).cast(kind)).alias(name) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(name)


def keep_state(
    stream: DataFrame,
    table: FeatureTable,
    *,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None] | None = None,
    clock: str = "events",
    trigger: dict | None = None,
    partitions: int | None = None,
    groups: int = GROUPS,
) -> StreamingQuery:
    """Keep the state of a stream's keys (canonical columns: keys, event time, tie-break columns,
    features) in the query's checkpoint.

    `sink` gets the changes of each micro-batch: the new values of the keys it changed, and with
    `expired` those that have left. With a max age, `clock` says when that is: "events" when the
    newest event is so much younger, "machine" when the key's values have not changed for so long;
    by the machine's clock a query never runs out of work, so it can not end by itself. What is past
    its age counts no more, and has left the state when a sixteenth of the age more is over. Rows
    without a complete key or event time are passed over. The state lies in `partitions` stores, by
    default as many as shuffles have, and its keys in `groups` hash groups: with some dozens of keys
    in each or fewer, little is written again. These numbers and the clock are fixed by the first
    start.
    """
    if clock not in ("events", "machine"):
        raise ValueError(f"clock is 'events' or 'machine', got {clock!r}")
    trigger = dict(trigger or {"processingTime": "0 seconds"})
    if clock == "machine" and effective_max_age(table) is not None and not trigger.keys() <= {"processingTime"}:
        raise ValueError("values that expire by the machine's clock need a trigger by processing time")
    spark = stream.sparkSession
    age = effective_max_age(table)
    by_events = age is not None and clock == "events"
    rows = stream.filter(entities_valid(table))
    instant = as_time(F.col(EVENT_TS), stream.schema[EVENT_TS].dataType, T.TimestampType())
    ties = [t for t in table.tie_break if t in stream.columns]
    keys = [T.StructField(e.name, e.spark_type) for e in table.entities]
    rows = rows.select(
        *[_unsigned(k.name, k.dataType) for k in keys],
        F.unix_micros(instant).alias(_AT),
        F.struct(*[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)], F.lit(0).alias("last")).alias(_TIES),
        *[f for f in table.feature_names],
    )
    rows = rows.withColumn(_GROUP, F.pmod(F.xxhash64(*table.keys), F.lit(groups)).cast("int"))
    if any(isinstance(rows.schema[k].dataType, T.ArrayType) for k in table.keys):  # lists have no codes
        rows = _packed(rows, None)
    else:
        spread = _newest_of_task(rows, table.keys).repartition(int(spark.conf.get(_PARTITIONS)), _GROUP)
        rows = _packed(spread, table.keys)
    rows = rows.select(_GROUP, F.timestamp_micros(_AT).alias(EVENT_TS), _ROWS)
    features = [T.StructField(f.name, f.spark_type) for f in table.features]
    values = [*keys, T.StructField(_AT, T.LongType()), *features]
    until = [] if age is None or by_events else [T.StructField(_UNTIL, T.LongType())]
    changes = T.StructType([*values, T.StructField(EXPIRED, T.BooleanType())])
    mode = "None" if age is None else "EventTime" if by_events else "ProcessingTime"
    if by_events:
        rows = rows.withWatermark(EVENT_TS, f"{max(1, _micros(age) // 1000)} milliseconds")
    entry = T.StructType([*values, *until])
    processor = _PackedValues(table.keys, table.feature_names, entry, None if age is None else _micros(age), by_events)
    changed = rows.groupBy(_GROUP).transformWithState(processor, changes, "Update", mode)
    changed = changed.select(*table.keys, naive_utc(F.timestamp_micros(_AT)).alias(EVENT_TS), *table.feature_names, EXPIRED)
    writer = changed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(sink) if sink else writer.format("noop")
    settings = {_PROVIDER: _ROCKS, **({_PARTITIONS: str(partitions)} if partitions else {})}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():  # the query takes a copy of the settings when it starts
        spark.conf.set(name, value)
    try:
        return writer.trigger(**trigger).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _micros(age: timedelta) -> int:
    return age // timedelta(microseconds=1)


def state_rows(spark: SparkSession, checkpoint: str, table: FeatureTable, as_of: datetime | None = None) -> DataFrame:
    """The state after the last finished micro-batch: keys, event time (naive UTC), features, expiry.
    With `as_of`, what has expired by then is left out, to the microsecond, whether or not it has
    left the state."""
    stored = spark.read.format("statestore").option("stateVarName", _STATE).load(checkpoint)
    rows = stored.select(F.explode(f"value.{_ENTRIES}").alias("entry")).select("entry.*")
    if _UNTIL in rows.columns:  # by the machine's clock
        rows = rows.filter(F.col(_UNTIL) > F.unix_millis(F.current_timestamp()))
    rows = rows.select(*table.keys, naive_utc(F.timestamp_micros(_AT)).alias(EVENT_TS), *table.feature_names)
    rows = with_expiry(rows, effective_max_age(table))
    if as_of is None:
        return rows
    now = time_literal(as_of, T.TimestampNTZType())
    return rows.filter(F.col("expiry_timestamp").isNull() | (F.col("expiry_timestamp") > now))
