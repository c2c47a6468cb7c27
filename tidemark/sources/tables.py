"""Declared feature-store tables in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.model import FeatureTable, Source
from tidemark.operators.validate import check_fields, check_timestamp


def table_schema(
    table: FeatureTable, source: Source | None = None, ts_type: T.DataType | None = None
) -> T.StructType:
    """Column names and types of a table's rows: keys, features, event and created time."""
    source = source or table.source or Source()
    ts_type = ts_type or T.TimestampNTZType()
    fields = [T.StructField(f.name, f.spark_type) for f in [*table.entities, *table.features]]
    fields.append(T.StructField(source.event_timestamp, ts_type))
    if source.created_timestamp:
        fields.append(T.StructField(source.created_timestamp, ts_type))
    return T.StructType(fields)


def declare_table(
    spark: SparkSession,
    name: str,
    table: FeatureTable,
    source: Source | None = None,
    *,
    buckets: int | None = None,
    path: str | None = None,
) -> None:
    """Create an empty columnar table for feature rows. With `buckets` it is laid out by
    key: point-in-time joins of tables bucketed alike need no shuffle."""
    empty = spark.createDataFrame([], table_schema(table, source))
    _writer(empty, table, buckets, path).saveAsTable(name)


def append_rows(df: DataFrame, name: str, table: FeatureTable, source: Source | None = None) -> None:
    """Append feature rows to a declared table, after checking their types. For a bucketed
    table the rows are first brought together by bucket, so each append adds one file per
    bucket and not one per bucket and task."""
    source = source or table.source or Source()
    check_fields(df, [*table.entities, *table.features], table.name)
    check_timestamp(df, source.event_timestamp, table.name)
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns)
    buckets = _buckets_of(spark, name)
    if buckets:
        rows = rows.repartition(buckets, *table.keys)
    _writer(rows, table, buckets, None).mode("append").saveAsTable(name)


def _buckets_of(spark: SparkSession, name: str) -> int | None:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
    return int(described["data_type"]) if described else None


def _writer(df: DataFrame, table: FeatureTable, buckets: int | None, path: str | None):
    writer = df.write.format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *table.keys).sortBy(*table.keys)
    return writer.option("path", path) if path else writer
