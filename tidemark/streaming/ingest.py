"""Stream ingestion: decode, map, check, upsert, dead letters; one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.codecs import MALFORMED, decode_avro, decode_json, decode_protobuf
from tidemark.functions.times import as_time, time_literal
from tidemark.model import FeatureTable, Source
from tidemark.operators.ingest import checked_rows, storable
from tidemark.operators.metrics import counters, lag_columns
from tidemark.operators.online import OnlineTable
from tidemark.operators.project import flatten
from tidemark.operators.sinks import write_dead_letters
from tidemark.operators.validate import FAILED, VALID, Suite
from tidemark.streaming.progress import IngestMetrics, ProgressTable


def decode(stream: DataFrame, message: Mapping) -> DataFrame:
    """Messages to columns.

    `message` is `{"format": "json", "column": c, "schema": StructType}`,
    `{"format": "avro", "column": c, "schema": text}`,
    `{"format": "protobuf", "column": c, "message": name, "descriptor": path}` or
    `{"format": "columns"}`. Malformed messages keep a row, marked by `_malformed`.
    """
    kind = message["format"]
    if kind == "columns":
        return stream.withColumn(MALFORMED, F.lit(False))
    column, into = message["column"], "__tm_message"
    if kind == "json":
        decoded = decode_json(stream, column, message["schema"], into)
    elif kind == "avro":
        decoded = decode_avro(stream, column, message["schema"], into)
    elif kind == "protobuf":
        decoded = decode_protobuf(stream, column, message["message"], message["descriptor"], into)
    else:
        raise ValueError(f"unknown message format {kind!r}")
    fields = decoded.schema[into].dataType.names
    meta = [c for c in stream.columns if c != column and c not in fields]
    return flatten(decoded, into, keep=[*meta, MALFORMED])


def ingest_stream(
    stream: DataFrame,
    table: FeatureTable,
    online: OnlineTable,
    *,
    source: Source | None = None,
    message: Mapping | None = None,
    checkpoint: str,
    dead_letters: str | None = None,
    suite: Suite | None = None,
    on_invalid: str = "drop",
    trigger: Mapping | None = None,
    message_time: str | None = None,
    metrics: IngestMetrics | None = None,
    progress: ProgressTable | None = None,
) -> StreamingQuery:
    """Keep the online table current from a stream.

    `checkpoint` is one stable folder per feature table. A micro-batch that is replayed
    after a failure is recognised by its id: the upsert is skipped and its dead letters
    are overwritten, so a restart changes nothing. Dead letters lie by run and batch, next to
    those of batch runs; the run is Spark's id of the query, which its checkpoint keeps.
    `trigger` is passed to Spark
    (`{"processingTime": "30 seconds"}`, `{"availableNow": True}`). The counters of each batch go
    to `metrics` on this driver and to `progress`, a table; there with the lag of `message_time`
    behind the batch. They are observed while the batch is stored.
    """
    source = source or table.source or Source()
    decoded = decode(stream, message or {"format": "columns"})
    keep = (MALFORMED, *([message_time] if message_time else []))
    intact = {"malformed": ~F.col(MALFORMED)}
    checked = checked_rows(decoded, table, source, suite, keep=keep, extra_checks=intact)
    stored = storable(on_invalid, table)
    if on_invalid == "flag":
        stored = stored & ~F.col(MALFORMED)

    counted = [*counters(stored), (F.max(message_time) if message_time else F.lit(None)).alias("latest_message")]

    def apply(batch: DataFrame, batch_id: int) -> None:
        wanted = list(counted)
        if progress is not None and message_time:
            kind = batch.schema[message_time].dataType
            wanted += lag_columns(time_literal(datetime.now(UTC), kind), message_time)
            wanted.append(as_time(F.max(message_time), kind, T.TimestampNTZType()).alias("latest_utc"))
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()
        try:
            seen = Observation()
            watched = batch.observe(seen, *wanted) if metrics is not None or progress is not None else batch
            applied = online.upsert(watched.filter(stored).drop(VALID, FAILED, *keep), batch_id=batch_id, writer=checkpoint)
            if dead_letters:
                write_dead_letters(batch.filter(~F.col(VALID)).drop(VALID), dead_letters, run, batch_id)
            if metrics is not None or progress is not None:
                # A batch that was applied before a failure is not stored again: it is counted here.
                values = seen.get if applied else batch.agg(*wanted).first().asDict()
                if metrics is not None:
                    metrics.add(batch_id, {k: values[k] for k in ("n_read", "n_stored", "n_deadletter", "latest_message")})
                if progress is not None:
                    progress.record(run, batch_id, {**values, "latest_message": values.pop("latest_utc", None)})
        finally:
            batch.unpersist()

    writer = checked.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**dict(trigger or {"processingTime": "0 seconds"})).start()


def json_message(schema: T.StructType, column: str = "value") -> dict:
    return {"format": "json", "column": column, "schema": schema}
