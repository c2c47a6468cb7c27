"""Ingestion job: `spark-submit ingest.py --config job.json`.

The job:
    {"mode": "offline" | "online",
     "table": {..table.., "source": {...}},
     "online": {"path": "...", "buckets": 1024},
     "start": "2024-01-01T00:00:00", "end": "...",       (offline; or "days": 3)
     "stream": {"format": "kafka" | file format, "path": ..., "schema": ddl},   (online)
     "message": {"format": "json", "column": "value", "schema": ddl},           (online)
     "checkpoint": "...", "trigger_seconds": 30,                                (online)
     "dead_letters": "...", "suite": [...], "on_invalid": "drop" | "flag",
     "validation_function": path of a stored function}
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict, replace
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.shipped import load_function
from tidemark.model import FeatureTable, Source
from tidemark.operators.ingest import IngestReport, ingest_batch
from tidemark.operators.online import OnlineTable
from tidemark.operators.project import effective_max_age, ingestion_window
from tidemark.operators.validate import Suite
from tidemark.sources.stream import read_broker, read_files
from tidemark.streaming.ingest import ingest_stream


def run(spark: SparkSession, config: dict) -> IngestReport | StreamingQuery:
    """Start one ingestion: a report for a batch load, the running query for a stream."""
    source = Source.from_dict(config["table"]["source"])
    table = FeatureTable.from_dict(config["table"], source)
    table = replace(table, max_age=effective_max_age(table))
    where = config["online"]
    online = OnlineTable(spark, where["path"], table, buckets=where.get("buckets", 32))
    suite = None
    if config.get("suite") or config.get("validation_function"):
        suite = Suite.from_dicts(config.get("suite") or [])
        if config.get("validation_function"):
            suite = replace(suite, function=load_function(spark, config["validation_function"]))
    common = {
        "dead_letters": config.get("dead_letters"),
        "suite": suite,
        "on_invalid": config.get("on_invalid", "drop"),
    }
    if config["mode"] == "offline":
        if "days" in config:
            start, end = ingestion_window(config["days"])
        else:
            start, end = (
                datetime.fromisoformat(config[k]) if config.get(k) else None for k in ("start", "end")
            )
        return ingest_batch(spark, table, online, start, end, **common)
    if config["mode"] != "online":
        raise ValueError(f"mode is 'offline' or 'online', got {config['mode']!r}")
    origin = config.get("stream", {"format": "kafka"})
    if origin["format"] == "kafka":
        stream = read_broker(spark, source, **config.get("login", {}))
    else:
        stream = read_files(spark, origin["path"], origin["schema"], origin["format"])
    message = dict(config.get("message") or {"format": "columns"})
    if message["format"] == "json" and isinstance(message["schema"], str):
        message["schema"] = T.StructType.fromDDL(message["schema"])
    seconds = config.get("trigger_seconds", 0)
    trigger = {"availableNow": True} if seconds == "once" else {"processingTime": f"{seconds} seconds"}
    return ingest_stream(
        stream,
        table,
        online,
        source=source,
        message=message,
        checkpoint=config["checkpoint"],
        trigger=trigger,
        **common,
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="feature ingestion")
    parser.add_argument("--config", required=True, help="path of the job, as JSON")
    arguments = parser.parse_args()
    spark = SparkSession.builder.appName("tidemark-ingest").getOrCreate()
    with open(arguments.config) as file:
        outcome = run(spark, json.load(file))
    if isinstance(outcome, StreamingQuery):
        outcome.awaitTermination()
    else:
        print(json.dumps(asdict(outcome), default=str))


if __name__ == "__main__":
    main()
