"""Row counters and lag summaries as small frames, gathered without extra passes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.times import micros_between, time_literal
from tidemark.model import EVENT_TS, FeatureTable
from tidemark.operators.validate import VALID

QUANTILES = (0.5, 0.95, 0.99)


def counters(stored: Column | None = None) -> list[Column]:
    """Rows read, stored and dead-lettered of checked rows. Invalid rows are dead letters;
    `stored` says which rows are stored where that is not simply the valid ones."""
    valid = F.col(VALID)
    return [
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(valid if stored is None else stored).alias("n_stored"),
        F.count_if(~valid).alias("n_deadletter"),
    ]


def row_counters(checked: DataFrame, stored: Column | None = None) -> DataFrame:
    """One row: rows read, stored and dead-lettered."""
    return checked.agg(*counters(stored))


def observe_counters(
    checked: DataFrame, name: str, stored: Column | None = None, event_ts: str = EVENT_TS
) -> tuple[DataFrame, Observation]:
    """Count rows while they flow through whatever job runs next."""
    observation = Observation(name)
    watched = checked.observe(observation, *counters(stored), F.max(event_ts).alias("latest_event"))
    return watched, observation


def counters_frame(df: DataFrame, table: FeatureTable, values: dict) -> DataFrame:
    """Observed counters as a frame labelled by project and table."""
    row = [
        (
            table.project,
            table.name,
            values.get("n_read", 0),
            values.get("n_stored", 0),
            values.get("n_deadletter", 0),
        )
    ]
    return df.sparkSession.createDataFrame(
        row, "project string, feature_table string, n_read long, n_stored long, n_deadletter long"
    )


# Values that a sketch keeps per level: quantiles are within 1.7% of their rank, whatever is merged.
SKETCH_K = 200
RANK_ERROR = 0.017


def lag_columns(now: Column, event_ts: str = EVENT_TS) -> list[Column]:
    """Aggregates of the lag of event times behind `now`, in microseconds, that can be merged: its
    count, least and greatest value, and a KLL sketch of all values."""
    lag = micros_between(F.col(event_ts), now)
    return [
        F.count(lag).alias("lag_n"),
        F.min(lag).alias("lag_min"),
        F.max(lag).alias("lag_max"),
        F.kll_sketch_agg_bigint(lag, SKETCH_K).alias("lag_sketch"),
    ]


def lag_sketches(df: DataFrame, now: datetime | Column, by: Sequence[str] = (), event_ts: str = EVENT_TS) -> DataFrame:
    """The lag of a batch as one row per group, to be stored and merged with other batches'."""
    now = now if isinstance(now, Column) else time_literal(now, df.schema[event_ts].dataType)
    return df.groupBy(*by).agg(*lag_columns(now, event_ts)).filter("lag_n > 0")


def merged_lag(sketches: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The lag over all stored batches: count, least and greatest value exactly, quantiles within
    `RANK_ERROR` of their rank. The rows that are merged are as many as batches, not as messages."""
    merged = sketches.filter("lag_n > 0").groupBy(*by).agg(
        F.sum("lag_n").alias("n"),
        F.min("lag_min").alias("min_lag_us"),
        F.max("lag_max").alias("max_lag_us"),
        F.kll_merge_agg_bigint("lag_sketch", SKETCH_K).alias("sketch"),
    )
    if not by:
        merged = merged.filter("n > 0")
    names = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias(f"p{round(q * 100)}_lag_us") for q in quantiles]
    return merged.select(*[c for c in merged.columns if c != "sketch"], *names)


def lag_summary(
    df: DataFrame, now: datetime | Column, by: Sequence[str] = (), event_ts: str = EVENT_TS
) -> DataFrame:
    """Lag of event times behind `now`, in microseconds: count, min, max, mean, spread and
    approximate quantiles."""
    now = now if isinstance(now, Column) else time_literal(now, df.schema[event_ts].dataType)
    lag = df.select(*by, micros_between(F.col(event_ts), now).alias("lag"))
    q = F.percentile_approx("lag", list(QUANTILES)).alias("q")
    summary = lag.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("lag").alias("min_lag_us"),
        F.max("lag").alias("max_lag_us"),
        F.avg("lag").alias("mean_lag_us"),
        F.stddev("lag").alias("stddev_lag_us"),
        q,
    )
    quantiles = [
        F.col("q")[i].alias(f"p{round(p * 100)}_lag_us") for i, p in enumerate(QUANTILES)
    ]
    return summary.select(*[c for c in summary.columns if c != "q"], *quantiles)
