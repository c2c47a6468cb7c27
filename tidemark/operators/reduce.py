"""Cheap reductions that shrink inputs before a point-in-time join."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.bounds import spine_bounds
from tidemark.plans.keyset import MOST_WORDS, KeySet, key_hash
from tidemark.plans.skew import (
    HOT,
    SLICE,
    SkewOptions,
    assign_slices,
    find_hot_keys,
    salted_join,
)

__all__ = ["SKETCH_KEYS", "candidate_counts", "distinct_keys", "semi_reduce", "sketch_reduce", "spine_bounds"]


def distinct_keys(spine: DataFrame, columns: Sequence[str]) -> DataFrame:
    return spine.select(*columns).distinct()


def semi_reduce(
    features: DataFrame,
    spine: DataFrame,
    keys: Sequence[str],
    *,
    skew: SkewOptions | None = SkewOptions(),
) -> DataFrame:
    """Feature rows whose key occurs in the spine; never multiplies rows.

    The key side is made distinct first, so Spark can broadcast it when its measured size
    is below the broadcast limit and otherwise shuffles one row per key. Feature rows of
    hot keys are spread over salts.
    """
    reduced = salted_join(features, distinct_keys(spine, keys), keys, "left_semi", skew)
    return reduced.select(*[F.col(f"`{c}`") for c in features.columns])


# A bitmap of more keys than this has less than 8 bits a key, and lets too many others pass.
SKETCH_KEYS = MOST_WORDS * 64 // 8


def sketch_reduce(features: DataFrame, spine: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Feature rows whose key may occur in the spine: all whose key does, and about one in a hundred
    (one in ten, near `SKETCH_KEYS` keys) of the others.

    No feature row is shuffled and no key table is built: the spine's key hashes become a bitmap
    by partial aggregation, of at most `MOST_WORDS` words whatever the spine, which is broadcast.
    `rows` is the number of spine rows, if it is known; else a small job counts them.
    """
    # In the types of the features: hashes are of these, and what does not fit them is not there.
    whole = spine.select(*[F.col(f"`{k}`").try_cast(features.schema[k].dataType).alias(k) for k in keys]).na.drop(subset=list(keys))
    known = KeySet.of(whole, key_hash(keys), whole.count() if rows is None else rows)
    return known.keep_possible(features.na.drop(subset=list(keys)), key_hash(keys))


def candidate_counts(
    spine: DataFrame,
    spine_ts: str,
    features: DataFrame,
    feature_ts: str,
    keys: Sequence[str],
    max_age: timedelta,
    *,
    skew: SkewOptions | None = SkewOptions(),
) -> DataFrame:
    """How many feature rows each key offers its spine rows within `max_age`.

    The number of (spine, feature) pairs with `spine - max_age <= feature <= spine`, per
    key, without building the pairs: every spine time adds the features up to it and takes
    away those before its window, so the whole count is one running sum per key. A hot
    key's rows are first counted per time; its running sum is cut into time slices that
    start from the sum of all earlier slices.
    """

    def mark(at: Column, side: int, is_feature: int, weight: int) -> Column:
        parts = {"t": at, "side": F.lit(side), "f": F.lit(is_feature), "w": F.lit(weight)}
        return F.struct(*[c.cast("long").alias(n) if n in "fw" else c.alias(n) for n, c in parts.items()])

    at = F.col(spine_ts)
    window = F.array(mark(at - F.lit(max_age), 0, 0, -1), mark(at, 2, 0, 1))
    rows = (
        spine.select(*keys, F.inline(window))
        .unionByName(features.select(*keys, F.inline(F.array(mark(F.col(feature_ts), 1, 1, 0)))))
        .na.drop(subset=[*keys, "t"])
    )
    hot = find_hot_keys(rows, keys, "t", skew) if skew else None
    steps = rows.withColumn(SLICE, F.lit(0))
    if hot:
        sliced = assign_slices(rows, hot, "t", "time")
        counted = (
            sliced.filter(F.col(HOT))
            .groupBy(*keys, SLICE, "t", "side")
            .agg(F.sum("f").alias("f"), F.sum("w").alias("w"))
        )
        earlier = (
            Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = (
            counted.groupBy(*keys, SLICE)
            .agg(F.sum("f").alias("f"))
            .withColumn("f", F.coalesce(F.sum("f").over(earlier), F.lit(0)))
            .withColumn("t", F.lit(None).cast(rows.schema["t"].dataType))
            .withColumn("side", F.lit(0))
            .withColumn("w", F.lit(0).cast("long"))
        )
        steps = sliced.filter(~F.col(HOT)).drop(HOT).unionByName(counted).unionByName(carried)
    running = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(F.col("t").asc_nulls_first(), "side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        steps.withColumn("seen", F.sum("f").over(running))
        .groupBy(*keys)
        .agg(F.sum(F.col("seen") * F.col("w")).alias("n"))
        .filter(F.col("n") > 0)
    )
