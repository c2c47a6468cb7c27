"""Reading what the sinks wrote: saved datasets, feature logs and dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import utc_day
from tidemark.model import EVENT_TS, output_name, parse_refs
from tidemark.operators.latest import pull_all, time_range


def read_saved_dataset(
    spark: SparkSession,
    path: str,
    refs: Sequence[str],
    join_keys: Sequence[str],
    *,
    full_feature_names: bool = True,
    event_ts: str = EVENT_TS,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Join keys and referenced features of a stored retrieval result, both ends included."""
    columns = [
        output_name(table, f, full_feature_names) for table, fs in parse_refs(refs).items() for f in fs
    ]
    return pull_all(spark.read.parquet(path), [*join_keys, *columns], event_ts, start, end)


def read_logs(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    log_ts: str = "log_timestamp",
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Logged feature rows in `[start, end)`; log date partitions outside are skipped."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.filter(F.col("log_date") >= F.lit(utc_day(start)))
    if end is not None:
        df = df.filter(F.col("log_date") <= F.lit(utc_day(end)))
    return time_range(df, log_ts, start, end).select(*dict.fromkeys([*columns, log_ts]))


def read_dead_letters(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Rejected rows with the names of the checks they failed, of batch and stream runs."""
    found = spark.read.parquet(path).schema
    # Run ids are text, also where they look like numbers.
    fields = [T.StructField(f.name, T.StringType()) if f.name == "run_id" else f for f in found]
    df = spark.read.schema(T.StructType(fields)).parquet(path)
    return df if run_id is None else df.filter(F.col("run_id") == run_id)
