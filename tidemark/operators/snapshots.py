"""Snapshots: the newest feature rows of every key at cut times, e.g. at day ends.

A point-in-time join without a max age asks for the newest row up to each spine time, however old
it is. With a snapshot at a cut before the first spine time it needs the snapshot and the rows from
the cut on; the history before is not read. A snapshot is made from the one before it and the
rows in between, so each row of the history is read once for all of them.

A snapshot keeps all rows of a key that tie for the newest by event time, created time and the
tie-break columns. A request for some of the features then decides ties by their values just as
it would on the whole history. Rows that come late, with times before stored cuts, are merged
into these snapshots (`absorb`); the snapshots of a store change together, in one commit.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.commits import CommitLog
from tidemark.errors import CommitConflict, SchemaError
from tidemark.functions.times import as_time, as_utc, time_literal
from tidemark.model import CREATED_TS, EVENT_TS, FeatureTable
from tidemark.plans.lineage import cut_lineage

_NEWEST = "__tm_newest"


def as_cut(value: date | datetime) -> datetime:
    """A cut as naive UTC time. A date is the end of that day."""
    if isinstance(value, datetime):
        return as_utc(value)
    return datetime(value.year, value.month, value.day) + timedelta(days=1)


def newest_rows(rows: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The distinct rows of each key that come last by `order`; ties all stay.

    The newest order values are an aggregate, combined before the shuffle; rows then meet them by
    key and order values together, so a key with many rows is spread over tasks.
    """
    marked = rows.select(*keys, *columns, F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias(_NEWEST))
    newest = marked.groupBy(*keys).agg(F.max(_NEWEST).alias(_NEWEST))
    return marked.join(newest, [*keys, _NEWEST], "left_semi").drop(_NEWEST).distinct()


@dataclass(frozen=True)
class CarryIn:
    """What a store offers for spine times from its cut on: `rows` are the newest before it."""

    cut: datetime
    rows: DataFrame


class SnapshotStore:
    """The snapshots of one feature table at a path.

    `origin` describes where the rows come from (a source's path, mapping and the like): a store
    that was filled from elsewhere, or with other keys or another order, is not used.
    """

    def __init__(self, spark: SparkSession, path: str, table: FeatureTable, *, created: bool = False, origin: Mapping | None = None) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.table = table
        self.order = [EVENT_TS, *([CREATED_TS] if created else []), *table.tie_break]
        self._log = CommitLog(spark, f"{self.path}/_commits", self.path)
        described = json.dumps(dict(origin or {}), sort_keys=True, default=str)
        self._origin = hashlib.sha256(described.encode()).hexdigest()

    # ------------------------------------------------------------------ state

    def _initial(self) -> dict:
        return {
            "cuts": {},
            "keys": {e.name: e.dtype for e in self.table.entities},
            "features": {f.name: f.dtype for f in self.table.features},
            "order": self.order,
            "origin": self._origin,
        }

    def _state(self) -> dict:
        return self._log.read()[2] or self._initial()

    def _same_rows(self, state: dict) -> bool:
        mine = self._initial()
        return all(state[part] == mine[part] for part in ("keys", "order", "origin"))

    def cuts(self) -> list[datetime]:
        """The stored cut times, ascending."""
        return sorted(datetime.fromisoformat(c) for c in self._state()["cuts"])

    @property
    def _columns(self) -> list[str]:
        """What is stored besides the keys."""
        names = dict.fromkeys([*self.table.feature_names, *self.order])
        return [n for n in names if n not in self.table.keys]

    def _stored(self, state: dict, cut: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{state['cuts'][cut]}")

    # ---------------------------------------------------------------- writing

    def build(self, rows: DataFrame, cut: date | datetime, *, day: str | None = None) -> None:
        """Store the newest rows before `cut` (the end of that day for a date).

        `rows` has the table's canonical columns; `day` names the one that holds a row's UTC date
        where its source is partitioned by it. Only rows since the last earlier snapshot are read.
        """
        cut = as_cut(cut)
        state = self._state()
        if state["cuts"] and not self._same_rows(state):
            raise SchemaError(f"{self.path}: snapshots of other keys, of another order or of another source")
        missing = {f.name: f.dtype for f in self.table.features if state["features"].get(f.name) != f.dtype}
        if missing:
            raise SchemaError(f"{self.path}: snapshots lack {missing}; store them anew elsewhere")
        earlier = [c for c in state["cuts"] if datetime.fromisoformat(c) <= cut]
        since = max(earlier, key=datetime.fromisoformat, default=None)
        fresh = self._usable(rows).filter(F.col(EVENT_TS) < time_literal(cut, rows.schema[EVENT_TS].dataType))
        if day is not None:
            fresh = fresh.filter(F.col(day) <= F.lit((cut - timedelta(microseconds=1)).date()))
        if since is not None:
            start = datetime.fromisoformat(since)
            fresh = fresh.filter(F.col(EVENT_TS) >= time_literal(start, rows.schema[EVENT_TS].dataType))
            if day is not None:
                fresh = fresh.filter(F.col(day) >= F.lit(start.date()))
        fresh = fresh.select(*self.table.keys, *self._columns)
        if since is not None:
            fresh = fresh.unionByName(self._stored(state, since))
        folder = self._write(fresh)

        def add(now: dict | None) -> dict | None:
            now = now or self._initial()
            # Late rows may have changed what this one was made from.
            if since is not None and now["cuts"].get(since) != state["cuts"][since]:
                return None
            if not self._same_rows(now):
                return None
            return {**now, "cuts": {**now["cuts"], cut.isoformat(): folder}}

        if not self._log.commit(add):
            files.remove(self.spark, f"{self.path}/{folder}")
            raise CommitConflict(f"{self.path}: the snapshot at {since} changed meanwhile; build again")

    def absorb(self, late: DataFrame) -> int:
        """Merge rows that came after snapshots were made, with times before their cuts. Returns
        the number of snapshots that changed."""
        state = self._state()
        # Read several times below, and always the same rows.
        late = cut_lineage(self._usable(late).select(*self.table.keys, *self._columns))
        dtype = late.schema[EVENT_TS].dataType
        first = _first_time(late)
        changed = {}
        for cut in state["cuts"]:
            if first is None or datetime.fromisoformat(cut) <= first:
                continue
            before = late.filter(F.col(EVENT_TS) < time_literal(datetime.fromisoformat(cut), dtype))
            changed[cut] = self._write(before.unionByName(self._stored(state, cut)))
        if not changed:
            return 0

        def swap(now: dict | None) -> dict | None:
            if now is None or {c: now["cuts"].get(c) for c in changed} != {c: state["cuts"][c] for c in changed}:
                return None
            # A snapshot added meanwhile was made from one without these rows.
            if any(datetime.fromisoformat(c) > first and c not in changed for c in now["cuts"]):
                return None
            return {**now, "cuts": {**now["cuts"], **changed}}

        if not self._log.commit(swap):
            for folder in changed.values():
                files.remove(self.spark, f"{self.path}/{folder}")
            raise CommitConflict(f"{self.path}: snapshots changed meanwhile; absorb again")
        return len(changed)

    def _usable(self, rows: DataFrame) -> DataFrame:
        return rows.na.drop(subset=[*self.table.keys, EVENT_TS])

    def _write(self, rows: DataFrame) -> str:
        folder = f"cuts/{uuid.uuid4().hex}"
        newest = newest_rows(rows, self.table.keys, self.order, self._columns)
        newest.sortWithinPartitions(*self.table.keys).write.parquet(f"{self.path}/{folder}")
        return folder

    def keep_last(self, n: int) -> None:
        """Take all but the last `n` cuts out of the store; `vacuum` removes their rows."""

        def shorten(state: dict | None) -> dict | None:
            if state is None or len(state["cuts"]) <= n:
                return None
            last = sorted(state["cuts"], key=datetime.fromisoformat)[len(state["cuts"]) - n :]
            return {**state, "cuts": {c: state["cuts"][c] for c in last}}

        self._log.commit(shorten)

    def vacuum(self, retain: timedelta = timedelta(days=1)) -> None:
        """Remove what the last finished commit does not use and is older than `retain`."""
        _, read, state = self._log.read()
        used = set((state or self._initial())["cuts"].values())
        before = datetime.now(UTC).timestamp() - retain.total_seconds()

        def old(path: str) -> bool:
            return files.modified(self.spark, path) <= before

        for name in files.names_in(self.spark, f"{self.path}/cuts"):
            if f"cuts/{name}" not in used and old(f"{self.path}/cuts/{name}"):
                files.remove(self.spark, f"{self.path}/cuts/{name}")
        self._log.forget_before(read, old)

    # ---------------------------------------------------------------- reading

    def before(self, first: datetime, table: FeatureTable, created: bool) -> CarryIn | None:
        """The last snapshot at or before `first` (naive UTC) that can serve the features of
        `table`; None without one."""
        state = self._state()
        wanted = [EVENT_TS, *([CREATED_TS] if created else []), *table.tie_break]
        known = self._same_rows(state) and wanted == state["order"]
        cuts = [c for c in state["cuts"] if datetime.fromisoformat(c) <= first]
        if not cuts or not known or any(state["features"].get(f.name) != f.dtype for f in table.features):
            return None
        cut = max(cuts, key=datetime.fromisoformat)
        return CarryIn(datetime.fromisoformat(cut), self._stored(state, cut))


def _first_time(rows: DataFrame) -> datetime | None:
    """The first event time as naive UTC."""
    at = as_time(F.col(EVENT_TS), rows.schema[EVENT_TS].dataType, T.TimestampNTZType())
    return rows.agg(F.min(at)).first()[0]
