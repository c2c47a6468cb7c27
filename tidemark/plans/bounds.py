"""What is measured on the spine before a join: its time bounds and its size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import as_time, time_literal


def spine_bounds(spine: DataFrame, ts: str) -> DataFrame:
    """One row: the first and last spine time."""
    return spine.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


# What a row adds to its keys' bytes in a broadcast table.
_ROW_BYTES = 32


@dataclass(frozen=True)
class SpineBounds:
    """First and last spine time (naive UTC; None for a spine without times), the number of
    spine rows and the bytes of the values in its key columns, all of one stored evaluation of
    the spine."""

    first: datetime | None
    last: datetime | None
    rows: int
    key_bytes: Mapping[str, int] = field(default_factory=dict)

    def oldest(self, max_age: timedelta | None) -> datetime | None:
        """The first feature time that a spine time could use; None for no such limit."""
        if max_age is None or self.first is None:
            return None
        try:
            return self.first - max_age
        except OverflowError:
            return None

    def keep_usable(
        self,
        features: DataFrame,
        ts: str,
        max_age: timedelta | None,
        day: str | None = None,
        since: datetime | None = None,
    ) -> DataFrame:
        """Feature rows that some spine time could use, or those of them from `since` on. The
        bounds are plain literals of the column's own type, so they reach the feature scan: row
        groups outside are skipped, and so are whole partitions where `day` holds the rows' UTC
        date."""
        if self.last is None:
            return features.filter(F.lit(False))
        dtype = features.schema[ts].dataType
        kept = features.filter(F.col(ts) <= time_literal(self.last, dtype))
        if day is not None:
            kept = kept.filter(F.col(day) <= F.lit(self.last.date()))
        oldest = self.oldest(max_age)
        if since is not None and (oldest is None or since > oldest):
            oldest = since
        if oldest is not None:
            kept = kept.filter(F.col(ts) >= time_literal(oldest, dtype))
            if day is not None:
                kept = kept.filter(F.col(day) >= F.lit(oldest.date()))
        return kept

    def keys_fit(self, spark: SparkSession, keys: Sequence[str]) -> bool:
        """Whether the spine's keys, as measured, stay below Spark's own limit for broadcasts."""
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        size = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit))
        return self.rows * _ROW_BYTES + sum(self.key_bytes[k] for k in keys) <= size


def _bytes_of(name: str, dtype: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.octet_length(F.to_json(F.struct(column)))
    return F.lit(16)


def measure_spine(spine: DataFrame, ts: str, keys: Sequence[str] = ()) -> SpineBounds:
    """One small job over the time and key columns of a stored spine; it serves all feature tables."""
    at = as_time(F.col(ts), spine.schema[ts].dataType, T.TimestampNTZType())
    sizes = [F.coalesce(F.sum(_bytes_of(k, spine.schema[k].dataType)), F.lit(0)) for k in keys]
    first, last, rows, *sizes = spine.agg(F.min(at), F.max(at), F.count(F.lit(1)), *sizes).first()
    return SpineBounds(first, last, rows, dict(zip(keys, sizes)))
