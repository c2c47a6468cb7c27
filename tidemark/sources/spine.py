"""Entity frames: from a DataFrame, SQL text, pandas or a declared source."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tidemark.model import Source
from tidemark.operators.project import map_columns
from tidemark.sources.batch import load


def as_spine(spark: SparkSession, spine: DataFrame | pd.DataFrame | str | Source) -> DataFrame:
    """Any accepted form of an entity frame as a DataFrame. Its schema comes from the
    plan, so no rows are read to find it."""
    if isinstance(spine, DataFrame):
        return spine
    if isinstance(spine, str):
        return spark.sql(spine)
    if isinstance(spine, Source):
        df = load(spark, spine)
        return map_columns(df, spine.field_mapping) if spine.field_mapping else df
    return spark.createDataFrame(spine)


def stage_spine(spark: SparkSession, spine: pd.DataFrame | DataFrame, path: str) -> DataFrame:
    """Write an entity frame where other jobs can read it, and read it back; a Spark frame is
    written by the executors."""
    frame = spine if isinstance(spine, DataFrame) else spark.createDataFrame(spine)
    frame.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
