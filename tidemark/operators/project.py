"""Column mapping, feature selection and ingestion windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import SchemaError
from tidemark.functions.times import as_utc
from tidemark.functions.types import castable
from tidemark.model import CREATED_TS, EVENT_TS, FeatureTable, Source


def _mapped(mapping: Mapping[str, str], name: str) -> Column:
    return F.expr(mapping[name]) if name in mapping else F.col(f"`{name}`")


def project_input(
    df: DataFrame, table: FeatureTable, source: Source, *, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of a source as the table's features, keys and event time.

    Mapping values are Spark SQL expressions over the source columns; whatever is not
    mapped is taken by name. `keep` passes extra columns (message metadata) through.
    """
    mapping = source.field_mapping
    names = [*table.feature_names, *table.keys]
    extra = [m for m in mapping if m not in names and m not in (EVENT_TS, *keep)]
    ties = [t for t in table.tie_break if t not in [*names, *extra, EVENT_TS, *keep]]
    columns = [_mapped(mapping, n).alias(n) for n in [*names, *extra, *ties]]
    columns.append(_mapped(mapping, source.event_timestamp).alias(EVENT_TS))
    columns += [F.col(f"`{k}`") for k in keep if k in df.columns]
    return df.select(*columns)


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Retrieval mapping `{final: source}`: a source that names an existing column renames
    it, anything else is an expression; all other columns stay."""
    renames = {src: final for final, src in mapping.items() if src in df.columns}
    computed = {final: src for final, src in mapping.items() if src not in df.columns}
    columns = [
        F.expr(computed[c]).alias(c) if c in computed else F.col(f"`{c}`").alias(renames.get(c, c))
        for c in df.columns
    ]
    columns += [F.expr(e).alias(c) for c, e in computed.items() if c not in df.columns]
    return df.select(*columns)


def reverse_mapping(mapping: Mapping[str, str], names: Sequence[str]) -> list[str]:
    """Source column of each final name."""
    return [mapping.get(n, n) for n in names]


def select_features(
    df: DataFrame, table: FeatureTable, source: Source, *, keep: Mapping[str, str] | None = None
) -> DataFrame:
    """Keys, features and canonical time columns of a mapped frame, with the one allowed
    cast (double to float) applied. Missing or differently typed columns raise. `keep` passes
    source columns on under other names."""
    from tidemark.operators.validate import check_fields, check_timestamp

    mapped = map_columns(df, source.field_mapping) if source.field_mapping else df
    check_timestamp(mapped, source.event_timestamp, table.name)
    if source.created_timestamp:
        check_timestamp(mapped, source.created_timestamp, table.name)
    check_fields(mapped, [*table.entities, *table.features], table.name, allow_cast=True)
    columns = []
    for f in [*table.entities, *table.features]:
        column = F.col(f"`{f.name}`")
        if castable(mapped.schema[f.name].dataType, f.spark_type):
            column = column.cast(f.spark_type).alias(f.name)
        columns.append(column)
    columns.append(F.col(f"`{source.event_timestamp}`").alias(EVENT_TS))
    if source.created_timestamp:
        columns.append(F.col(f"`{source.created_timestamp}`").alias(CREATED_TS))
    names = [*table.keys, *table.feature_names]
    for tie in table.tie_break:
        if tie not in mapped.columns:
            raise SchemaError(f"{table.name}: tie-break column {tie!r} is missing")
        if tie not in names:
            columns.append(F.col(f"`{tie}`"))
    columns += [F.col(f"`{column}`").alias(name) for name, column in (keep or {}).items()]
    return mapped.select(*columns)


def flatten(df: DataFrame, struct: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of one struct column as columns, plus columns to keep."""
    return df.select(f"{struct}.*", *keep)


# Fixed value: the table label that holds the clean-up threshold in seconds.
CLEANUP_LABEL = "gcThresholdSec"


def effective_max_age(table: FeatureTable, label: str = CLEANUP_LABEL) -> timedelta | None:
    """How long stored values of a table stay: its max age, unless the clean-up label asks for
    longer. A label that is no whole number of seconds says nothing."""
    asked = str(table.labels.get(label, "")).strip()
    seconds = int(asked) if asked.removeprefix("-").isdecimal() else None
    ages = [age for age in (table.max_age, None if seconds is None else timedelta(seconds=seconds)) if age is not None]
    return max(ages, default=None)


def ingestion_window(days: int, now: datetime | None = None) -> tuple[datetime, datetime]:
    """The last `days` calendar days in UTC including today, as `[start, end)`."""
    if days < 1:
        raise ValueError("an ingestion window has at least one day")
    today = as_utc(now or datetime.now(UTC)).replace(hour=0, minute=0, second=0, microsecond=0)
    return today - timedelta(days=days - 1), today + timedelta(days=1)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without nulls, e.g. training rows after retrieval."""
    return df.na.drop(subset=list(columns) if columns else None)
