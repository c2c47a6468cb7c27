"""Retrieval job: `spark-submit retrieve.py --config request.json`.

The request:
    {"tables": [{..table.., "source": {"file": {...}}}],
     "spine": {"file": {...}} | "sql": "...",
     "features": ["table:feature", ...],
     "output": {"format": "parquet", "path": "..."},
     "full_feature_names": true, "checkpoint_every": null}
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tidemark.engine import FeatureEngine
from tidemark.model import FeatureTable, Source
from tidemark.operators.sinks import write_result


def tables_of(config: dict) -> list[FeatureTable]:
    return [
        FeatureTable.from_dict(t, Source.from_dict(t["source"]) if "source" in t else None)
        for t in config["tables"]
    ]


def run(spark: SparkSession, config: dict) -> str:
    """Run one request; returns the path of the result."""
    engine = FeatureEngine(spark, tables_of(config))
    spine = config["sql"] if "sql" in config else Source.from_dict(config["spine"])
    result = engine.get_historical_features(
        spine,
        config["features"],
        full_feature_names=config.get("full_feature_names", True),
        checkpoint_every=config.get("checkpoint_every"),
    )
    output = config["output"]
    write_result(result, output["path"], output.get("format", "parquet"), **output.get("options", {}))
    return output["path"]


def main() -> None:
    parser = argparse.ArgumentParser(description="point-in-time feature retrieval")
    parser.add_argument("--config", required=True, help="path of the request, as JSON")
    arguments = parser.parse_args()
    spark = SparkSession.builder.appName("tidemark-retrieve").getOrCreate()
    with open(arguments.config) as file:
        print(run(spark, json.load(file)))


if __name__ == "__main__":
    main()
