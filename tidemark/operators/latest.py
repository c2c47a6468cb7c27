"""Latest row per key, and plain range pulls."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import time_literal
from tidemark.model import CREATED_TS, EVENT_TS, FeatureTable


def time_range(
    df: DataFrame,
    ts: str,
    start: datetime | date | None,
    end: datetime | date | None,
    closed: str = "left",
) -> DataFrame:
    """Rows in `[start, end)` or, with `closed="both"`, `[start, end]`; None leaves a side
    open."""
    if closed not in ("left", "both"):
        raise ValueError(f"closed is 'left' or 'both', got {closed!r}")
    dtype = df.schema[ts].dataType
    if start is not None:
        df = df.filter(F.col(ts) >= time_literal(start, dtype))
    if end is not None:
        last = time_literal(end, dtype)
        df = df.filter(F.col(ts) < last if closed == "left" else F.col(ts) <= last)
    return df


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    event_ts: str = EVENT_TS,
    created_ts: str | None = None,
    start: datetime | date | None = None,
    end: datetime | date | None = None,
    *,
    closed: str = "both",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest row of every key in a time range: keys, features, event and created time.

    Ties on event time go to the later created time, then `tie_break`, then the feature
    values. Without keys: the newest row of all. A maximum over a struct is combined on
    the map side, so a key with very many rows reaches the shuffle as one row per task.
    """
    order = [event_ts, *([created_ts] if created_ts else []), *tie_break]
    carried = list(dict.fromkeys([*order, *features]))
    newest = F.max(F.struct(*[F.col(c).alias(f"s{i}") for i, c in enumerate(carried)])).alias("__tm_newest")
    grouped = time_range(df, event_ts, start, end, closed).groupBy(*keys).agg(newest)
    wanted = [*features, event_ts, *([created_ts] if created_ts else [])]
    if not keys:
        grouped = grouped.filter(F.col("__tm_newest").isNotNull())
    return grouped.select(
        *keys,
        *[
            F.col("__tm_newest")[f"s{carried.index(c)}"].alias(c)
            for c in dict.fromkeys(wanted)
        ],
    )


def pull_all(
    df: DataFrame,
    columns: Sequence[str],
    event_ts: str = EVENT_TS,
    start: datetime | date | None = None,
    end: datetime | date | None = None,
    *,
    closed: str = "both",
) -> DataFrame:
    """Every row of a time range, reduced to the given columns and the event time."""
    wanted = list(dict.fromkeys([*columns, event_ts]))
    return time_range(df, event_ts, start, end, closed).select(*wanted)


def compact(batch: DataFrame, table: FeatureTable) -> DataFrame:
    """One row per entity key of a batch: the newest one. A batch that was reduced to its
    features before has no created time or tie-break columns; it is ordered by what it has."""
    created = CREATED_TS if CREATED_TS in batch.columns else None
    ties = [t for t in table.tie_break if t in batch.columns]
    newest = latest_per_key(batch, table.keys, table.feature_names, EVENT_TS, created, tie_break=ties)
    return newest.select(*table.keys, EVENT_TS, *table.feature_names)
