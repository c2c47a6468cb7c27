"""The online table: current feature values per entity key.

A write is the compacted batch (one row per key), appended as a small parquet folder. The
current state is a fold over the batches in write order; because the stored event time is
always the running maximum of the batch times, the fold is one window and one aggregate
and needs no loop. When the batches have grown to a fair share of it, the state is folded
into a base that is bucketed by key, so folds and lookups shuffle only the recent batches
and not the base.

A commit is one new numbered file that lists the folders in force, created whole or not at
all. A writer that finds its number taken reads the new state and commits again: the rows it
has written stay as they are, only their place in the write order is new. Readers that started
on an older commit keep reading their own folders.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.commits import CommitLog
from tidemark.errors import CommitConflict, SchemaError
from tidemark.functions.times import as_time, time_literal
from tidemark.model import EVENT_TS, FeatureTable, Field, output_name
from tidemark.operators.latest import compact
from tidemark.operators.project import effective_max_age
from tidemark.operators.validate import check_fields, check_timestamp, entities_valid
from tidemark.plans.keyset import KeySet, key_hash
from tidemark.plans.skew import SkewOptions, salted_join

SEQ = "_seq"
EXPIRY = "expiry_timestamp"
_RUN = "run"
# A stored table up to this size is read whole: looking for its keys would cost more.
_SMALL_TABLE = 64 << 20
# A spine of so many rows gives its keys as values, which choose buckets, row groups and pages; a
# longer one gives a bitmap of its keys.
_VALUES = 20_000
# The values as so many ranges of the first key, cut at the widest gaps: these reach the scan.
_RANGES = 64
# Strings beyond this length are no bounds of a folder's keys.
_BOUND_LENGTH = 256
# The base is rewritten when recent batches reach this share of its size.
_MERGE_SHARE = 0.25


def fold_upserts(batches: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """State after applying all batches in `_seq` order (one row per key and batch).

    A row at or after the stored event time replaces the values it has; its nulls leave
    stored values alone. An older row changes nothing.
    """
    earlier = (
        Window.partitionBy(*keys).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, -1)
    )
    stored = F.max(EVENT_TS).over(earlier)
    accepted = batches.withColumn(
        "__tm_ok", stored.isNull() | (F.col(EVENT_TS) >= stored)
    )

    def current(feature: str) -> Column:
        turn = F.when(F.col("__tm_ok") & F.col(feature).isNotNull(), F.col(SEQ))
        return F.max_by(feature, turn).alias(feature)

    return accepted.groupBy(*keys).agg(
        F.max(EVENT_TS).alias(EVENT_TS), *[current(f) for f in features]
    )


def _in_step(df: DataFrame, keys: Sequence[str], values: Sequence[str], seq: Column) -> DataFrame:
    """Rows for a union with others of the same layout. The keys are aliased: Spark then
    sees that all branches are partitioned alike when they are, and folds them without
    another shuffle."""
    return df.select(
        *[F.col(k).alias(f"__tm_k{i}") for i, k in enumerate(keys)], *values, seq.alias(SEQ)
    )


def _fold_in_step(rows: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    inner = [f"__tm_k{i}" for i in range(len(keys))]
    return fold_upserts(rows, inner, features).withColumnsRenamed(dict(zip(inner, keys)))


def fold_batches(batches: Sequence[DataFrame], table: FeatureTable) -> DataFrame:
    """State after upserting the given batches one after the other, as one query. Each
    batch is shuffled once, by its own compaction."""
    values = [EVENT_TS, *table.feature_names]
    rows = None
    for i, batch in enumerate(batches):
        part = _in_step(compact(batch, table), table.keys, values, F.lit(i))
        rows = part if rows is None else rows.unionByName(part)
    return _fold_in_step(rows, table.keys, table.feature_names)


def with_expiry(df: DataFrame, max_age: timedelta | None, event_ts: str = EVENT_TS) -> DataFrame:
    """Add `expiry_timestamp` = event time + max age; null means never."""
    if max_age is None:
        expiry = F.lit(None).cast(df.schema[event_ts].dataType)
    else:
        expiry = F.col(event_ts) + F.lit(max_age)
    return df.withColumn(EXPIRY, expiry)


def key_expiry(tables: Iterable[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Expiry of an entity key over all feature tables that share it: the latest one, or
    never (null) when any of them never expires."""
    rows = None
    for df in tables:
        part = df.select(*keys, EXPIRY)
        rows = part if rows is None else rows.unionByName(part)
    return (
        rows.groupBy(*keys)
        .agg(F.max(EXPIRY).alias("last"), F.bool_or(F.col(EXPIRY).isNull()).alias("never"))
        .select(*keys, F.when(~F.col("never"), F.col("last")).alias(EXPIRY))
    )


@dataclass(frozen=True)
class _Wanted:
    """What a lookup reads: a filter of rows, and whether a folder with these key ranges matters."""

    only: Callable[[DataFrame], DataFrame]
    in_: Callable[[Mapping[str, Sequence]], bool] = lambda ranges: True


def _ranges(values: set) -> list[tuple]:
    """At most `_RANGES` ranges that hold all the values, cut at the widest gaps of whole numbers
    or, for other types, into runs of equal length."""
    if not values or not all(isinstance(v, (int, str)) and not isinstance(v, bool) for v in values):
        return []
    ordered = sorted(values)
    if isinstance(ordered[0], int):
        gaps = sorted(range(1, len(ordered)), key=lambda i: ordered[i - 1] - ordered[i])[: _RANGES - 1]
    else:
        gaps = range(0, len(ordered), max(1, -(-len(ordered) // _RANGES)))
    starts = sorted({0, *gaps})
    return [(ordered[a], ordered[b - 1]) for a, b in zip(starts, [*starts[1:], len(ordered)])]


def _key_filters(table: FeatureTable) -> dict[str, str]:
    """Parquet options: a Bloom filter on each key, as large as its values ask for."""
    # The Parquet writer's option names.
    kinds = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)
    keys = [e.name for e in table.entities if isinstance(e.spark_type, kinds)]
    options = {"parquet.bloom.filter.adaptive.enabled": "true"} if keys else {}
    for key in keys:
        # The smallest of so many sizes that holds the values; the first is 1 MB, each next one half.
        options |= {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.candidates.number#{key}": "12"}
    return options


class OnlineTable:
    """One feature table's current values at a path."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        table: FeatureTable,
        *,
        buckets: int = 32,
        compact_after: int = 8,
        event_ts_type: T.DataType | None = None,
        write_options: Mapping[str, str] | None = None,
    ) -> None:
        """`write_options` go to the Parquet writer, e.g. for smaller row groups."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.table = table
        self.compact_after = compact_after
        self._new_buckets = buckets
        self._ts_type = event_ts_type or T.TimestampNTZType()
        self._write_options = {**_key_filters(table), **(write_options or {})}
        self._log = CommitLog(spark, f"{self.path}/_commits", self.path)

    # ---------------------------------------------------------------- commits

    def _state(self) -> dict:
        """The last finished commit; `version` is the last number that is taken, `read` its own."""
        last, read, state = self._log.read()
        return {**(state or self._initial()), "version": last, "read": read}

    def _initial(self) -> dict:
        age = effective_max_age(self.table)
        seconds = None if age is None else age.total_seconds()
        return {
            "base": None,
            "base_bytes": 0,
            "deltas": [],
            "next_seq": 1,
            "writers": {},
            "buckets": self._new_buckets,
            "ts": self._ts_type.simpleString(),
            "features": {f.name: f.dtype for f in self.table.features},
            "max_age": seconds,
            "declared_max_age": seconds,
        }

    def _commit(self, change: Callable[[dict], dict | None]) -> bool:
        return self._log.commit(lambda state: change(state or self._initial()))

    # ---------------------------------------------------------------- writing

    def upsert(self, batch: DataFrame, batch_id: int | None = None, writer: str = "batch") -> bool:
        """Apply a batch. Rows without a complete key or event time are not stored.

        With a `batch_id`, a batch at or below the writer's last one is recognised as
        already applied and skipped (False is returned), so a retry changes nothing. Several
        writers may work on one table: batches count in the order of their commits.
        """
        state = self._state()
        if self._applied(state, batch_id, writer):
            return False
        check_timestamp(batch, EVENT_TS, self.table.name)
        check_fields(batch, [*self.table.entities, *self.table.features], self.table.name)
        self._check_stored_types(state)
        have, want = batch.schema[EVENT_TS].dataType, T.DataType.fromDDL(state["ts"])
        batch = batch.withColumn(EVENT_TS, as_time(F.col(EVENT_TS), have, want))
        newest = compact(batch.filter(entities_valid(self.table)), self.table)
        delta = self._write_delta(newest)

        def append(state: dict) -> dict | None:
            if self._applied(state, batch_id, writer):
                return None
            self._check_stored_types(state)
            writers = dict(state["writers"])
            if batch_id is not None:
                writers[writer] = batch_id
            return {
                **state,
                "deltas": [*state["deltas"], {**delta, "seq": state["next_seq"]}],
                "next_seq": state["next_seq"] + 1,
                "writers": writers,
                "features": {**state["features"], **{f.name: f.dtype for f in self.table.features}},
                **self._ages(state),
            }

        stored = self._commit(append)
        if stored:
            self._tidy()
        else:
            self._forget(delta["folder"])
        return stored

    @staticmethod
    def _applied(state: dict, batch_id: int | None, writer: str) -> bool:
        return batch_id is not None and batch_id <= state["writers"].get(writer, -1)

    def _ages(self, state: dict) -> dict:
        """A max age that is declared anew replaces the stored one."""
        age = effective_max_age(self.table)
        seconds = None if age is None else age.total_seconds()
        if seconds == state["declared_max_age"]:
            return {}
        return {"max_age": seconds, "declared_max_age": seconds}

    def _check_stored_types(self, state: dict) -> None:
        for f in self.table.features:
            stored = state["features"].get(f.name)
            if stored is not None and Field(f.name, stored).spark_type != f.spark_type:
                raise SchemaError(f"{self.table.name}: {f.name!r} is stored as {stored}, now declared {f.dtype}")

    def _write_delta(self, rows: DataFrame, level: int = 0) -> dict:
        folder = f"delta/{_RUN}={uuid.uuid4().hex}"
        bounds = Observation()
        ordered = rows.observe(bounds, *self._bounds()).sortWithinPartitions(*self.table.keys)
        ordered.write.options(**self._write_options).parquet(f"{self.path}/{folder}")
        size = files.size_of(self.spark, f"{self.path}/{folder}")
        return {"folder": folder, "seq": None, "level": level, "bytes": size, **self._described(bounds.get)}

    def _bounds(self) -> list[Column]:
        """The number of rows, and the first and last value of each key that has an order which
        the commit can hold."""
        bounds = [F.count(F.lit(1)).alias("rows")]
        for i, key in enumerate(self.table.entities):
            if isinstance(key.spark_type, (T.IntegerType, T.LongType, T.StringType)):
                column = F.col(f"`{key.name}`")
                bounds += [F.min(column).alias(f"low{i}"), F.max(column).alias(f"high{i}")]
        return bounds

    def _described(self, seen: Mapping) -> dict:
        ranges = {}
        for i, key in enumerate(self.table.keys):
            pair = seen.get(f"low{i}"), seen.get(f"high{i}")
            if None not in pair and all(not isinstance(v, str) or len(v) <= _BOUND_LENGTH for v in pair):
                ranges[key] = list(pair)
        return {"rows": seen["rows"], "ranges": ranges}

    def _tidy(self) -> None:
        """Fold recent batches into the base when they have grown to a fair share of it. Until
        then, equally old batches are put together, a few at a time, so that the number of
        folders stays small and the base is left alone. Another writer may be doing the same:
        then what was written here is dropped."""
        state = self._state()
        recent = state["deltas"]
        if len(recent) < self.compact_after:
            return
        if state["base"] is None or sum(d["bytes"] for d in recent) >= _MERGE_SHARE * state["base_bytes"]:
            self.compact()
            return
        for level in sorted({d["level"] for d in recent}):
            own = [d for d in recent if d["level"] == level]
            if len(own) >= self.compact_after:
                self._put_together(state, own, level + 1)
                return

    def _put_together(self, state: dict, deltas: list[dict], level: int) -> None:
        """Rows of some deltas in one folder, each with its place in the write order."""
        merged = self._write_delta(self._recent(state, deltas), level)
        names = {d["folder"] for d in deltas}

        def replace_them(state: dict) -> dict | None:
            if not names <= {d["folder"] for d in state["deltas"]}:
                return None
            return {**state, "deltas": [merged, *(d for d in state["deltas"] if d["folder"] not in names)]}

        if not self._quietly(replace_them):
            self._forget(merged["folder"])

    def compact(self) -> None:
        """Fold everything into a new bucketed base. Rows move only if they are in recent
        batches: the old base is already laid out by bucket. Batches that are committed in the
        meantime stay recent."""
        state = self._state()
        if not state["deltas"]:
            return
        folder = f"base/{state['version']:012d}-{uuid.uuid4().hex[:8]}"
        (
            self._rows(state)
            .write.format("parquet")
            .options(**self._write_options)
            .bucketBy(state["buckets"], *self.table.keys)
            .sortBy(*self.table.keys)
            .option("path", f"{self.path}/{folder}")
            .saveAsTable(self._catalog_name(folder))
        )
        size = files.size_of(self.spark, f"{self.path}/{folder}")
        names = {d["folder"] for d in state["deltas"]}

        def swap(now: dict) -> dict | None:
            if now["base"] != state["base"] or not names <= {d["folder"] for d in now["deltas"]}:
                return None
            left = [d for d in now["deltas"] if d["folder"] not in names]
            return {**now, "base": folder, "base_bytes": size, "deltas": left}

        if not self._quietly(swap):
            self._forget(folder)

    def _quietly(self, change: Callable[[dict], dict | None]) -> bool:
        """A commit that only rearranges stored rows: losing against other writers is no fault."""
        try:
            return self._commit(change)
        except CommitConflict:
            return False

    def set_max_age(self, max_age: timedelta | None) -> None:
        """Change how long values stay valid; applies to stored values too."""
        seconds = None if max_age is None else max_age.total_seconds()
        self._commit(lambda state: {**state, "max_age": seconds})

    def vacuum(self, retain: timedelta = timedelta(days=1)) -> None:
        """Remove folders and commits that the current commit does not use and that are older
        than `retain`. Longer than that no writer may take from its first file to its commit,
        and no query may read an older commit."""
        state = self._state()
        before = datetime.now(UTC).timestamp() - retain.total_seconds()
        used = {*(d["folder"] for d in state["deltas"]), state["base"]}

        def old(path: str) -> bool:
            return files.modified(self.spark, path) <= before

        for kind in ("base", "delta"):
            for name in files.names_in(self.spark, f"{self.path}/{kind}"):
                if f"{kind}/{name}" not in used and old(f"{self.path}/{kind}/{name}"):
                    self._forget(f"{kind}/{name}")
        self._log.forget_before(state["read"], old)

    def drop(self) -> None:
        """Remove the table and all its data."""
        for name in files.names_in(self.spark, f"{self.path}/base"):
            self._forget(f"base/{name}")
        files.remove(self.spark, self.path)

    def _forget(self, folder: str) -> None:
        if folder.startswith("base/"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(folder)}")
        files.remove(self.spark, f"{self.path}/{folder}")

    # ---------------------------------------------------------------- reading

    @property
    def version(self) -> int:
        return self._state()["version"]

    @property
    def max_age(self) -> timedelta | None:
        seconds = self._state()["max_age"]
        return None if seconds is None else timedelta(seconds=seconds)

    def _catalog_name(self, folder: str) -> str:
        digest = hashlib.md5(f"{self.path}/{folder}".encode()).hexdigest()
        return f"tidemark_online_{digest}"

    def _base(self, state: dict) -> DataFrame:
        """The base as a bucketed table; registered anew in a session that lacks it."""
        name = self._catalog_name(state["base"])
        if not self.spark.catalog.tableExists(name):
            location = f"{self.path}/{state['base']}"
            columns = self.spark.read.parquet(location).schema.fields
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            keys = ", ".join(f"`{k}`" for k in self.table.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({keys}) "
                f"SORTED BY ({keys}) INTO {state['buckets']} BUCKETS LOCATION '{location}'"
            )
        return self.spark.read.table(name)

    def _schema(self, state: dict) -> T.StructType:
        fields = [T.StructField(e.name, e.spark_type) for e in self.table.entities]
        fields.append(T.StructField(EVENT_TS, T.DataType.fromDDL(state["ts"])))
        fields += [T.StructField(n, Field(n, d).spark_type) for n, d in state["features"].items()]
        return T.StructType(fields)

    def _recent(self, state: dict, deltas: Sequence[dict]) -> DataFrame:
        """Rows of some deltas with their place in the write order. Folders of one batch take
        it from the commit, folders that were put together hold it."""
        schema = self._schema(state)
        stored = T.StructType([*schema.fields, T.StructField(SEQ, T.LongType()), T.StructField(_RUN, T.StringType())])
        folders = [f"{self.path}/{d['folder']}" for d in deltas]
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/delta").parquet(*folders)
        places = [(d["folder"].partition("=")[2], d["seq"]) for d in deltas if d["seq"] is not None]
        if not places:
            return rows.drop(_RUN)
        place = F.create_map(*[F.lit(x).cast(t) for run, seq in places for x, t in ((run, "string"), (seq, "long"))])
        return rows.select(*schema.names, F.coalesce(F.col(SEQ), place[F.col(_RUN)]).alias(SEQ))

    def _rows(self, state: dict, wanted: _Wanted | None = None) -> DataFrame:
        """One row per key: the fold of base and recent batches, both reduced to what is `wanted`
        first. Batches that hold no such key are not read."""
        wanted = wanted or _Wanted(lambda df: df)
        only, schema = wanted.only, self._schema(state)
        state = {**state, "deltas": [d for d in state["deltas"] if d.get("rows") != 0 and wanted.in_(d.get("ranges", {}))]}
        names = schema.names
        features = list(state["features"])
        base = None
        if state["base"]:
            base = self._base(state)
            for f in schema.fields:  # features declared after the base was written
                if f.name not in base.columns:
                    base = base.withColumn(f.name, F.lit(None).cast(f.dataType))
            base = only(base.select(*names))
        if not state["deltas"]:
            return base if base is not None else self.spark.createDataFrame([], schema)
        recent = only(self._recent(state, state["deltas"]))
        if len(state["deltas"]) == 1 and state["deltas"][0]["level"] == 0 and base is None:
            return recent.select(*names)
        keys = self.table.keys
        values = [n for n in names if n not in keys]
        rows = _in_step(recent.repartition(state["buckets"], *keys), keys, values, F.col(SEQ))
        if base is not None:
            old = _in_step(base, keys, values, F.lit(0).cast("long"))
            rows = old.unionByName(rows)
        return _fold_in_step(rows, keys, features).select(*names)

    def rows(self) -> DataFrame:
        """Current values with their expiry: keys, event time, features, expiry."""
        return with_expiry(self._rows(self._state()), self.max_age)

    def lookup(
        self,
        spine: DataFrame,
        features: Sequence[str] | None = None,
        *,
        as_of: datetime | None = None,
        include_expired: bool = False,
        full_feature_names: bool = True,
        skew: SkewOptions | None = SkewOptions(),
        key_rows: DataFrame | None = None,
    ) -> DataFrame:
        """The spine with current feature values; unknown or expired keys get nulls.

        Values expire by `as_of`, which is now by default; `include_expired` serves all that
        is stored. Where the stored table is large, base and recent batches are reduced to the
        spine's keys before they are folded: by value, if the spine is short (batches of other
        keys are left out, and row groups and pages by their bounds and Bloom filters), else by a
        bitmap of its keys, which is broadcast with a bounded size. When the spine is itself the
        result of joins, `key_rows` can name the frame it was made from: keys are then taken
        there and the joins are not run for it.
        """
        features = list(features or self.table.feature_names)
        unknown = [f for f in features if f not in self.table.feature_names]
        if unknown:
            raise SchemaError(f"{self.table.name}: unknown features {unknown}")
        state = self._state()
        wanted = self._wanted(state, key_rows if key_rows is not None else spine)
        found = self._current(state, features, None if include_expired else as_of or datetime.now(UTC), full_feature_names, wanted)
        joined = salted_join(spine, found, self.table.keys, "left", skew, key_rows=key_rows)
        names = [output_name(self.table.name, f, full_feature_names) for f in features]
        return joined.select(*[F.col(f"`{c}`") for c in [*spine.columns, *names]])

    def _wanted(self, state: dict, spine: DataFrame) -> _Wanted | None:
        """What a lookup for this spine reads; None for everything."""
        if state["base_bytes"] + sum(d["bytes"] for d in state["deltas"]) <= _SMALL_TABLE:
            return None
        keys = self.table.keys
        # In the stored types: hashes and literals are of these.
        rows = spine.select(*[F.col(f"`{e.name}`").try_cast(e.spark_type).alias(e.name) for e in self.table.entities])
        rows = rows.na.drop(subset=keys)
        first = rows.limit(_VALUES + 1).collect()
        if len(first) <= _VALUES:
            return self._with_values(first)
        known = KeySet.of(rows, key_hash(keys), rows.count())
        return _Wanted(lambda df: known.keep_possible(df, key_hash(keys)))

    def _with_values(self, rows: Sequence[Mapping]) -> _Wanted:
        """Rows whose keys have the given values: literals, which choose buckets and row groups."""
        keys = self.table.keys
        values = {tuple(r[k] for k in keys) for r in rows if all(r[k] is not None for k in keys)}
        # Zeros and NaN have several forms: numbers with a fraction choose nothing here.
        exact = [i for i, e in enumerate(self.table.entities) if not isinstance(e.spark_type, T.FractionalType)]
        conditions = [F.col(keys[i]).isin(list({v[i] for v in values})) for i in exact]
        ranges = _ranges({v[0] for v in values})
        if len(ranges) > 1 or (ranges and len(values) > 1):
            within = [F.col(keys[0]).between(low, high) for low, high in ranges]
            conditions.append(reduce(lambda a, b: a | b, within))

        def only(df: DataFrame) -> DataFrame:
            for condition in conditions:
                df = df.filter(condition)
            return df

        def has(ranges: Mapping[str, Sequence]) -> bool:
            bounds = [(i, *ranges[k]) for i, k in enumerate(keys) if k in ranges]
            return any(all(low <= v[i] <= high for i, low, high in bounds) for v in values)

        return _Wanted(only, has)

    def _current(
        self, state: dict, features: Sequence[str], as_of: datetime | None, full: bool, wanted: _Wanted | None
    ) -> DataFrame:
        seconds = state["max_age"]
        rows = with_expiry(self._rows(state, wanted), None if seconds is None else timedelta(seconds=seconds))
        if as_of is not None:
            now = time_literal(as_of, rows.schema[EXPIRY].dataType)
            rows = rows.filter(F.col(EXPIRY).isNull() | (F.col(EXPIRY) > now))
        return rows.select(
            *self.table.keys,
            *[F.col(f).alias(output_name(self.table.name, f, full)) for f in features],
        )

    def get(
        self,
        entity_rows: Sequence[Mapping],
        features: Sequence[str] | None = None,
        *,
        as_of: datetime | None = None,
        include_expired: bool = False,
        full_feature_names: bool = True,
    ) -> list[dict]:
        """Current values for a caller's list of keys, in the order of the list.

        The list is the caller's own, so answer and driver memory have its size.
        """
        features = list(features or self.table.feature_names)
        keys = self.table.keys
        schema = T.StructType([T.StructField(e.name, e.spark_type) for e in self.table.entities])
        position = T.StructField("__tm_position", T.IntegerType())
        spine = self.spark.createDataFrame(
            [(*[row[k] for k in keys], i) for i, row in enumerate(entity_rows)],
            T.StructType([*schema.fields, position]),
        )
        state = self._state()
        wanted = self._with_values(entity_rows) if len(entity_rows) <= _VALUES else self._wanted(state, spine)
        found = self._current(state, features, None if include_expired else as_of or datetime.now(UTC), full_feature_names, wanted)
        answer = spine.join(found, keys, "left").orderBy("__tm_position").drop("__tm_position")
        return [row.asDict() for row in answer.collect()]


def update_online_tables(
    spark: SparkSession, root: str, delete: Iterable[FeatureTable], keep: Iterable[FeatureTable]
) -> list[str]:
    """Bring a folder of online tables in line with the declarations: remove the tables in
    `delete`, keep those in `keep`. Returns the names of the tables that remain."""
    keep_names = {t.name for t in keep}
    for table in delete:
        if table.name not in keep_names:
            OnlineTable(spark, f"{root.rstrip('/')}/{table.name}", table).drop()
    return files.names_in(spark, root)
