"""Rows in the shapes key-value, wide-column and column stores keep them.

Projections only: each returns an ordinary DataFrame that a connector can write.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import hashed_name, joined_key, schema_ref, short_hash, trimmed_name
from tidemark.functions.times import as_time
from tidemark.model import EVENT_TS, FeatureTable
from tidemark.operators.online import EXPIRY


def storage_name(table: FeatureTable) -> str:
    """Name of the store table of an entity: project and sorted entity names."""
    return trimmed_name(f"{table.project}__{'__'.join(sorted(table.keys))}")


def value_schema(df: DataFrame, table: FeatureTable) -> T.StructType:
    return T.StructType([df.schema[f] for f in table.feature_names])


def wide_layout(df: DataFrame, table: FeatureTable) -> DataFrame:
    """(key, value, schema_ref, ts): one serialised value per row, versioned by event time.
    The value's first four bytes are the reference of its schema, so that a reader finds the
    schema with the value. Rows whose key is empty are left out."""
    rows = _serialised(df, table)
    value = F.concat(F.unhex("schema_ref"), F.encode("value", "UTF-8"))
    return rows.withColumn("value", value)


def _serialised(df: DataFrame, table: FeatureTable) -> DataFrame:
    rows = df.select(
        joined_key(sorted(table.keys)).alias("key"),
        F.to_json(F.struct(*table.feature_names)).alias("value"),
        schema_ref(value_schema(df, table)).alias("schema_ref"),
        F.col(EVENT_TS).alias("ts"),
    )
    return rows.filter(F.length("key") > 0)


def read_wide(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Values of a wide layout as columns again: key, features, ts. Values that another schema
    wrote raise, because their bytes would be misread."""
    written = F.lower(F.hex(F.substring("value", 1, 4)))
    known = schema_ref(schema)
    value = F.decode(F.substring("value", F.lit(5), F.length("value")), "UTF-8")
    checked = F.when(written == known, F.from_json(value, schema)).otherwise(
        F.raise_error(F.concat(F.lit("value of schema "), written)).cast(schema)
    )
    return rows.select("key", checked.alias("v"), "ts").select("key", "v.*", "ts")


def column_layout(df: DataFrame, table: FeatureTable) -> DataFrame:
    """One value column and one schema column named after the table, plus write time in
    microseconds and time to live in seconds (0 = forever)."""
    ttl = 0 if table.max_age is None else int(table.max_age.total_seconds())
    wide = _serialised(df, table)
    at = as_time(F.col("ts"), wide.schema["ts"].dataType, T.TimestampType())
    return wide.select(
        "key",
        F.col("value").alias(table.name),
        F.col("schema_ref").alias(f"{table.name}__schema_ref"),
        F.unix_micros(at).alias("write_time"),
        F.lit(ttl).alias("ttl"),
    )


def kv_layout(
    df: DataFrame,
    table: FeatureTable,
    *,
    value_type: str = "string",
    with_times: bool = True,
    max_age: timedelta | None = None,
) -> DataFrame:
    """(entity_key, field, field_hash, value): one entry per feature that is not null, and
    `_ts:<table>` / `_ex:<table>` entries for event time and expiry (none = never). The
    entity key holds the project, the sorted entity names and their values."""

    def entry(name: str, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("field"),
            hashed_name(name).alias("field_hash"),
            value.cast(value_type).alias("value"),
        )

    entries = [entry(f"{table.name}:{f}", F.col(f)) for f in table.feature_names]
    if with_times:
        age = max_age or table.max_age
        expiry = F.col(EXPIRY) if EXPIRY in df.columns else None
        if expiry is None and age is not None:
            expiry = F.col(EVENT_TS) + F.lit(age)
        entries.append(entry(f"_ts:{table.name}", F.col(EVENT_TS)))
        if expiry is not None:
            entries.append(entry(f"_ex:{table.name}", expiry))
    present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    key = joined_key(sorted(table.keys), before=[table.project, *sorted(table.keys)])
    return df.select(key.alias("entity_key"), F.explode(present).alias("e")).select(
        "entity_key", "e.field", "e.field_hash", "e.value"
    )


def schema_registry_rows(df: DataFrame, tables: Sequence[FeatureTable]) -> DataFrame:
    """(schema_ref, schema) of the value schemas of the given tables."""
    spark = df.sparkSession
    rows = [(value_schema(df, t),) for t in tables]
    text = [(s.simpleString(),) for (s,) in rows]
    frame = spark.createDataFrame(text, "schema string")
    return frame.select(
        short_hash(F.col("schema")).alias("schema_ref"),
        "schema",
    )


def new_refs(candidates: DataFrame, stored: DataFrame, key: str = "schema_ref") -> DataFrame:
    """Registry rows to add: each reference once, and only if it is not stored yet."""
    return candidates.dropDuplicates([key]).join(stored.select(key).distinct(), key, "left_anti")


def register_schemas(spark: SparkSession, path: str, candidates: DataFrame) -> DataFrame:
    """Put-if-absent into a registry folder; returns the registry afterwards."""
    from tidemark import files

    if files.names_in(spark, path):
        candidates = new_refs(candidates, spark.read.parquet(path))
    else:
        candidates = candidates.dropDuplicates(["schema_ref"])
    candidates.write.mode("append").parquet(path)
    return spark.read.parquet(path).dropDuplicates(["schema_ref"])
