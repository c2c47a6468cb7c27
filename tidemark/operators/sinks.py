"""Writing results, datasets, logs, dead letters and batch-store rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import datetime
from itertools import islice
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import event_date
from tidemark.model import EVENT_TS

DEFAULT_BATCH_ROWS = 10_000


def write_result(df: DataFrame, path: str, format: str = "parquet", **options) -> None:
    """Overwrite `path` with the result; record files get the event time as seconds."""
    if format == "tfrecord":
        df = times_as_seconds(df)
    df.write.format(format).options(**options).mode("overwrite").save(path)


def times_as_seconds(df: DataFrame, ts: str = EVENT_TS) -> DataFrame:
    """Event time as whole seconds, for record formats without a time type."""
    return df.withColumn(ts, F.unix_seconds(F.col(ts).cast("timestamp")))


def save_dataset(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Store a retrieval result as a dataset folder. `single_file` is for results known to
    be small: it writes through one task."""
    (df.coalesce(1) if single_file else df).write.mode("errorifexists").parquet(path)


def write_dead_letters(df: DataFrame, path: str, run_id: str, batch_id: int = 0) -> None:
    """Rejected rows in a folder of their run and batch; a batch that is replayed writes the
    same folder again."""
    df.write.mode("overwrite").parquet(f"{path}/run_id={quote(run_id, safe='')}/batch_id={batch_id}")


def append_to_batch_store(
    df: DataFrame,
    path: str,
    event_ts: str = EVENT_TS,
    partition: str = "date",
    *,
    rebalance: bool = True,
) -> None:
    """Append feature rows to the batch store, one folder per event date.

    With `rebalance`, rows are grouped by date before writing, so a task writes few files;
    a date with very many rows is split over tasks. Switch it off for rows that come
    ordered by date anyway: it saves the shuffle.
    """
    dated = df.withColumn(partition, event_date(event_ts, df.schema[event_ts].dataType))
    if rebalance:
        dated = dated.hint("rebalance", F.col(partition))
    dated.write.mode("append").partitionBy(partition).parquet(path)


def append_logs(df: DataFrame, path: str, log_ts: str = "log_timestamp") -> None:
    """Append logged feature rows, one folder per log date."""
    append_to_batch_store(df, path, log_ts, "log_date")


def write_in_batches(
    df: DataFrame,
    write: Callable[[list[Row]], None],
    batch_rows: int = DEFAULT_BATCH_ROWS,
    progress: Callable[[int], None] | None = None,
) -> int:
    """Hand rows to a user's store client in fixed-size batches, on the executors.

    `write` runs inside tasks and must be idempotent, because a task may be retried.
    `progress` gets the total on the driver. Returns the number of rows handed over.
    """
    written = df.sparkSession.sparkContext.accumulator(0)

    def send(rows: Iterable[Row]) -> None:
        rows = iter(rows)
        while chunk := list(islice(rows, batch_rows)):
            write(chunk)
            written.add(len(chunk))

    df.foreachPartition(send)
    if progress:
        progress(written.value)
    return written.value


def dataset_bounds(df: DataFrame, event_ts: str = EVENT_TS) -> tuple[datetime, datetime]:
    """First and last event time of a stored dataset."""
    row = df.agg(F.min(event_ts), F.max(event_ts)).first()
    return row[0], row[1]


def on_demand(df: DataFrame, features: dict[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """Add features computed from a retrieval result by Spark SQL expressions."""
    out = df.withColumns({name: F.expr(text) for name, text in features.items()})
    return out if columns is None else out.select(*columns)


def on_demand_pandas(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Add features computed by a user function over pandas batches. It gets batches of
    result rows and returns the new columns, row for row, as `schema` names them."""
    added = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            new = function(rows)
            for name in added.names:
                rows[name] = new[name].to_numpy()
            yield rows

    return df.mapInPandas(batches, T.StructType([*df.schema.fields, *added.fields]))
