"""Which stretches of time an online table has been filled from: a run reads only the others.

The ledger is a list of disjoint intervals `[start, end)` beside the table, changed by commits.
Filling from an interval twice does no harm, so a run first stores rows and then notes the
interval: one that fails between the two is repeated as a whole. Late rows reopen the days they
belong to; the next run over these reads them again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.commits import CommitLog
from tidemark.functions.times import as_utc, event_date, time_literal
from tidemark.model import EVENT_TS, FeatureTable
from tidemark.operators.ingest import latest_rows
from tidemark.operators.online import OnlineTable
from tidemark.sources.batch import load

Interval = tuple[datetime, datetime]
_TICK = timedelta(microseconds=1)


def _at(value: date | datetime) -> datetime:
    return as_utc(value) if isinstance(value, datetime) else datetime(value.year, value.month, value.day)


def united(intervals: Sequence[Interval]) -> list[Interval]:
    """The same times as disjoint intervals that do not touch, ascending."""
    found: list[Interval] = []
    for start, end in sorted(i for i in intervals if i[0] < i[1]):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((start, end))
    return found


def without(intervals: Sequence[Interval], gone: Sequence[Interval]) -> list[Interval]:
    """The times of `intervals` that are in none of `gone`."""
    left = united(intervals)
    for start, end in united(gone):
        pieces = [(a, b) for x, y in left for a, b in ((x, min(y, start)), (max(x, end), y))]
        left = united(pieces)
    return left


class IntervalLedger:
    """The intervals that have gone into one online table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._log = CommitLog(spark, f"{path.rstrip('/')}/_intervals", path)

    @staticmethod
    def _of(state: dict | None) -> list[Interval]:
        return [(datetime.fromisoformat(a), datetime.fromisoformat(b)) for a, b in (state or {"intervals": []})["intervals"]]

    @staticmethod
    def _state(intervals: Sequence[Interval], opened: int) -> dict:
        return {"intervals": [[a.isoformat(), b.isoformat()] for a, b in united(intervals)], "opened": opened}

    def intervals(self) -> list[Interval]:
        return self._of(self._log.read()[2])

    def opened(self) -> int:
        """How often times have been reopened."""
        return (self._log.read()[2] or {"opened": 0})["opened"]

    def missing(self, start: date | datetime, end: date | datetime) -> list[Interval]:
        """What of `[start, end)` is not covered."""
        return without([(_at(start), _at(end))], self.intervals())

    def cover(self, intervals: Sequence[Interval], opened: int) -> bool:
        """Note that rows of these times are stored, unless times were reopened since `opened`
        was read: then some late rows may have been missed, and nothing is noted."""

        def add(state: dict | None) -> dict | None:
            if (state or {"opened": 0})["opened"] != opened:
                return None
            return self._state([*self._of(state), *intervals], opened)

        return self._log.commit(add)

    def reopen(self, start: date | datetime, end: date | datetime) -> None:
        """Read `[start, end)` again in the next run over it."""
        self._reopen([(_at(start), _at(end))])

    def reopen_days(self, late: DataFrame, event_ts: str = EVENT_TS) -> int:
        """Reopen the UTC days of rows that came late. Returns the number of days."""
        days = late.select(event_date(event_ts, late.schema[event_ts].dataType).alias("day")).na.drop().distinct().collect()
        if days:
            self._reopen([(_at(r["day"]), _at(r["day"]) + timedelta(days=1)) for r in days])
        return len(days)

    def _reopen(self, intervals: Sequence[Interval]) -> None:
        def cut(state: dict | None) -> dict:
            opened = (state or {"opened": 0})["opened"]
            return self._state(without(self._of(state), intervals), opened + 1)

        self._log.commit(cut)


def in_intervals(df: DataFrame, ts: str, intervals: Sequence[Interval], day: str | None = None) -> DataFrame:
    """Rows of these times, as literals that reach the scan; `day` is the column with a row's UTC
    date where the source is partitioned by it."""
    dtype = df.schema[ts].dataType
    wanted: Column = F.lit(False)
    days: Column = F.lit(False)
    for start, end in intervals:
        wanted = wanted | ((F.col(ts) >= time_literal(start, dtype)) & (F.col(ts) < time_literal(end, dtype)))
        if day is not None:
            days = days | F.col(f"`{day}`").between(F.lit(start.date()), F.lit((end - _TICK).date()))
    return df.filter(days).filter(wanted) if day is not None else df.filter(wanted)


def materialize_missing(
    spark: SparkSession,
    table: FeatureTable,
    online: OnlineTable,
    start: date | datetime,
    end: date | datetime,
    ledger: IntervalLedger,
    *,
    df: DataFrame | None = None,
) -> list[Interval]:
    """Newest rows of `[start, end)` to the online table, read from the stretches that earlier
    runs have not covered. Returns these.

    Rows of covered times are in the table already, and it keeps the newest of each key, so the
    table is the same as after reading the whole range.
    """
    opened, missing = ledger.opened(), ledger.missing(start, end)
    if missing:
        rows = df if df is not None else load(spark, table.source)
        rows = in_intervals(rows, table.source.event_timestamp, missing, table.source.date_partition)
        online.upsert(latest_rows(rows, table, table.source))
        ledger.cover(missing, opened)
    return missing
