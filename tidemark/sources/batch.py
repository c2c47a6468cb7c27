"""Reading batch sources."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import MissingConnectorError, SchemaError
from tidemark.functions.times import utc_day
from tidemark.functions.types import is_timestamp
from tidemark.model import EVENT_TS, Source
from tidemark.operators.latest import time_range


def load(spark: SparkSession, source: Source) -> DataFrame:
    """The rows of a source as they are: file, table, JDBC or any connector format."""
    if source.format == "table":
        return spark.read.table(source.path)
    reader = spark.read.format(source.format).options(**dict(source.options))
    if source.schema is not None:
        reader = reader.schema(source.schema)
    try:
        return reader.load(source.path) if source.path else reader.load()
    except Exception as error:
        text = str(error)
        if "DATA_SOURCE_NOT_FOUND" in text or "ClassNotFoundException" in text or "No suitable driver" in text:
            raise MissingConnectorError(
                f"format {source.format!r} needs a connector that is not on the classpath"
            ) from error
        if isinstance(error, AnalysisException) and "external" in text and "avro" in text.lower():
            raise MissingConnectorError("format 'avro' needs the spark-avro package") from error
        raise


def read_batch(
    spark: SparkSession,
    source: Source,
    start: datetime | date | None = None,
    end: datetime | date | None = None,
) -> DataFrame:
    """Source rows with event time in `[start, end)`.

    With a date partition column, whole partitions outside the range are skipped first
    (closed on both ends; the time filter decides at the edges).
    """
    return bounded(load(spark, source), source, start, end)


def bounded(
    df: DataFrame, source: Source, start: datetime | date | None, end: datetime | date | None
) -> DataFrame:
    return time_range(in_partitions(df, source, start, end), source.event_timestamp, start, end)


def in_partitions(
    df: DataFrame, source: Source, start: datetime | date | None, end: datetime | date | None
) -> DataFrame:
    """Rows of the date partitions (UTC days) that a closed time range touches."""
    if source.date_partition:
        day = F.col(f"`{source.date_partition}`")
        if start is not None:
            df = df.filter(day >= F.lit(utc_day(start)))
        if end is not None:
            df = df.filter(day <= F.lit(utc_day(end)))
    return df


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """Bulk CSV load with a declared schema: header skipped, any bad row fails the job."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", **options)


def columns_of(spark: SparkSession, source: Source) -> list[tuple[str, str]]:
    """Column names and types of a source, without reading rows."""
    return load(spark, source).dtypes


def infer_event_timestamp(df: DataFrame, default: str = EVENT_TS) -> str:
    """The event time column of a frame: the default name, else its only timestamp."""
    if default in df.columns:
        return default
    times = [f.name for f in df.schema.fields if is_timestamp(f.dataType)]
    if len(times) == 1:
        return times[0]
    raise SchemaError(f"cannot tell the event time column: no {default!r}, timestamps are {times}")
