"""Batch ingestion: source rows to the online table, rejected rows aside."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import SchemaError
from tidemark.model import CREATED_TS, EVENT_TS, FeatureTable, Source
from tidemark.operators.latest import latest_per_key
from tidemark.operators.metrics import observe_counters
from tidemark.operators.online import OnlineTable
from tidemark.operators.project import project_input, select_features
from tidemark.operators.sinks import write_dead_letters
from tidemark.operators.validate import (
    FAILED,
    VALID,
    Suite,
    check_table_frame,
    entities_valid,
    split_valid,
    with_validity,
)
from tidemark.sources.batch import bounded, in_partitions, load


@dataclass(frozen=True)
class IngestReport:
    """What an ingestion run did."""

    run_id: str
    n_read: int
    n_stored: int
    n_deadletter: int
    latest_event: datetime | None
    # Checks of the suite that could not be evaluated on the rows.
    skipped_checks: tuple[str, ...] = ()


def checked_rows(
    df: DataFrame,
    table: FeatureTable,
    source: Source,
    suite: Suite | None = None,
    *,
    need_feature: bool = False,
    keep: tuple[str, ...] = (),
    extra_checks: Mapping[str, Column] | None = None,
    strict: bool = False,
    skipped: list[str] | None = None,
) -> DataFrame:
    """Source rows projected to the table, type-checked and marked with failed checks."""
    projected = project_input(df, table, source, keep=keep)
    if source.created_timestamp and CREATED_TS not in projected.columns:
        created = F.expr(source.field_mapping.get(CREATED_TS, f"`{source.created_timestamp}`"))
        projected = project_input(
            df.withColumn("__tm_created", created), table, source, keep=(*keep, "__tm_created")
        ).withColumnRenamed("__tm_created", CREATED_TS)
    check_table_frame(projected, table)
    return with_validity(
        projected,
        table,
        suite,
        need_feature=need_feature,
        extra_checks=extra_checks,
        strict=strict,
        skipped=skipped,
    )


def storable(on_invalid: str, table: FeatureTable) -> Column:
    """Which checked rows are stored. `drop`: only valid rows. `flag`: rows that fail the
    suite are stored as well as dead-lettered; rows without key or time never are."""
    if on_invalid == "drop":
        return F.col(VALID)
    if on_invalid == "flag":
        return entities_valid(table)
    raise ValueError(f"on_invalid is 'drop' or 'flag', got {on_invalid!r}")


def ingest_batch(
    spark: SparkSession,
    table: FeatureTable,
    online: OnlineTable,
    start: datetime | date | None = None,
    end: datetime | date | None = None,
    *,
    source: Source | None = None,
    df: DataFrame | None = None,
    dead_letters: str | None = None,
    suite: Suite | None = None,
    on_invalid: str = "drop",
    need_feature: bool = False,
    run_id: str | None = None,
    strict: bool = False,
) -> IngestReport:
    """Load a time range of a source into the online table. Checks that can not be evaluated
    are named in the report, or raise with `strict`.

    The rejected rows come from a second read of the bounded source instead of a cached
    copy: scans are cheap next to spilling a large input to disk.
    """
    source = source or table.source
    if source is None:
        raise SchemaError(f"{table.name}: no source declared")
    run_id = run_id or uuid.uuid4().hex
    rows = bounded(df if df is not None else load(spark, source), source, start, end)
    skipped: list[str] = []
    checked = checked_rows(
        rows, table, source, suite, need_feature=need_feature, strict=strict, skipped=skipped
    )
    keep = storable(on_invalid, table)
    watched, observation = observe_counters(checked, f"ingest-{run_id}", keep)
    online.upsert(watched.filter(keep).drop(VALID, FAILED))
    if dead_letters:
        write_dead_letters(split_valid(checked)[1], dead_letters, run_id)
    seen = observation.get
    return IngestReport(
        run_id,
        seen["n_read"],
        seen["n_stored"],
        seen["n_deadletter"],
        seen["latest_event"],
        tuple(skipped),
    )


def latest_rows(
    df: DataFrame,
    table: FeatureTable,
    source: Source,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """The newest feature row per key of a source in a closed time range."""
    created = source.created_timestamp
    mapped = select_features(df, table, source)
    newest = latest_per_key(
        mapped,
        table.keys,
        table.feature_names,
        EVENT_TS,
        CREATED_TS if created else None,
        start,
        end,
        tie_break=table.tie_break,
    )
    return newest.select(*table.keys, EVENT_TS, *table.feature_names)


def materialize(
    spark: SparkSession,
    table: FeatureTable,
    online: OnlineTable,
    start: datetime | None = None,
    end: datetime | None = None,
    *,
    df: DataFrame | None = None,
) -> None:
    """Newest rows of a time range to the online table."""
    rows = in_partitions(df if df is not None else load(spark, table.source), table.source, start, end)
    online.upsert(latest_rows(rows, table, table.source, start, end))


def push(table: FeatureTable, online: OnlineTable, df: DataFrame) -> None:
    """Rows of a frame straight to the online table, through the table's mapping."""
    source = table.source or Source()
    online.upsert(project_input(df, table, source))
