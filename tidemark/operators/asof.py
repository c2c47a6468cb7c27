"""Point-in-time joins.

For every spine row: the latest feature row of the same key that is not after the spine
time and not older than the table's max age. Exact to the microsecond; ties on event time
are decided by created time, then `tie_break` columns, then the feature values.

Plan: spine and features are unioned and one window takes the running maximum of
(event time, created time, ...) per key. That is a single shuffle on the keys for all
feature tables that share them, no candidate pairs, and no shuffle at all when both sides
are already partitioned on the keys (bucketed tables).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaError
from tidemark.functions.times import as_time
from tidemark.model import CREATED_TS, EVENT_TS, FeatureTable, output_name
from tidemark.operators.reduce import SKETCH_KEYS, distinct_keys, semi_reduce, sketch_reduce
from tidemark.operators.snapshots import CarryIn, SnapshotStore
from tidemark.operators.validate import check_spine
from tidemark.plans.bounds import SpineBounds, measure_spine
from tidemark.plans.lineage import cut_lineage
from tidemark.plans.skew import (
    HOT,
    SLICE,
    HotKeys,
    SkewOptions,
    assign_slices,
    find_hot_keys,
    row_spread,
)

_TS = "__tm_ts"
_SIDE = "__tm_side"
_REST = "__tm_rest"
# Spine rows without a complete key match nothing; they are spread over so many groups for each
# shuffle partition.
_NULL_KEY_GROUPS = 4


@dataclass(frozen=True)
class FeatureInput:
    """A feature table with the frame that holds its rows (canonical column names)."""

    table: FeatureTable
    df: DataFrame
    event_ts: str = EVENT_TS
    created_ts: str | None = CREATED_TS
    # The column that holds the rows' UTC date, where the source is partitioned by it.
    day: str | None = None
    # The newest rows at earlier cuts: rows before the last useful one are then not read.
    snapshots: SnapshotStore | None = None


def as_of_join(
    spine: DataFrame,
    spine_ts: str,
    feature_df: DataFrame,
    table: FeatureTable,
    *,
    full_feature_names: bool = True,
    skew: SkewOptions | None = SkewOptions(),
    bound_by_spine: bool = True,
    reduce_by_spine: bool | None = None,
) -> DataFrame:
    """Spine columns plus the table's features as they were at `spine_ts`.

    `feature_df` has the table's keys, `event_timestamp`, optionally `created_timestamp`,
    and the features. Every spine row comes out exactly once.
    """
    return multi_as_of(
        spine,
        spine_ts,
        [FeatureInput(table, feature_df)],
        full_feature_names=full_feature_names,
        skew=skew,
        bound_by_spine=bound_by_spine,
        reduce_by_spine=reduce_by_spine,
    )


def multi_as_of(
    spine: DataFrame,
    spine_ts: str,
    inputs: Sequence[FeatureInput],
    *,
    full_feature_names: bool = True,
    skew: SkewOptions | None = SkewOptions(),
    bound_by_spine: bool = True,
    reduce_by_spine: bool | None = None,
    checkpoint_every: int | None = None,
) -> DataFrame:
    """Point-in-time join of many feature tables.

    The spine is evaluated once per request, into the reliable checkpoint folder: all that
    is measured on it holds for the rows that are joined, also when its tables grow or it asks
    for the current time. Two small jobs then look at it: its time bounds and size
    (`bound_by_spine`), for the scans, and a sample of the key columns, for hot keys (`skew`).
    With neither, nothing is measured and the spine stays lazy. Feature rows whose key the
    spine does not have are dropped before the shuffle: by its keys, if these fit into a
    broadcast, or else by a bitmap of them, which is broadcast with a fixed size and lets a few
    others pass. `reduce_by_spine=True` asks for a semi join beyond the first, and False for
    never. Rows before a snapshot that an input brings are not read. Tables with the same keys share one pass. `checkpoint_every=n` cuts
    lineage after every n passes, for requests over very many different keys.
    """
    _check_output_names(spine, inputs, full_feature_names)
    groups: dict[tuple[str, ...], list[FeatureInput]] = {}
    for item in inputs:
        check_spine(spine, spine_ts, item.table)
        groups.setdefault(tuple(sorted(item.table.keys)), []).append(item)

    bounds = None
    if bound_by_spine:
        spine = cut_lineage(spine)
        bounds = measure_spine(spine, spine_ts, sorted({k for keys in groups for k in keys}))
    result = spine
    for done, (keys, members) in enumerate(groups.items(), start=1):
        bounded = [_bounded(m, bounds) for m in members]
        hot = _find_hot(spine, spine_ts, members, bounded, keys, skew) if skew else None
        prepared = [
            _prepare(m, df, spine, spine_ts, bounds, reduce_by_spine, f"__tm_f{i}")
            for i, (m, df) in enumerate(zip(members, bounded))
        ]
        result = _one_pass(result, spine_ts, list(keys), members, prepared, hot, full_feature_names)
        if checkpoint_every and done % checkpoint_every == 0 and done < len(groups):
            result = cut_lineage(result)
    wanted = [output_name(i.table.name, f, full_feature_names) for i in inputs for f in i.table.feature_names]
    return result.select(*[_c(c) for c in [*spine.columns, *wanted]])


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _check_output_names(spine: DataFrame, inputs: Sequence[FeatureInput], full: bool) -> None:
    names = list(spine.columns)
    for item in inputs:
        names += [output_name(item.table.name, f, full) for f in item.table.feature_names]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise SchemaError(f"columns would appear twice in the result: {twice}")


def _bounded(item: FeatureInput, bounds: SpineBounds | None) -> DataFrame:
    """Feature rows with a key and a time that some spine time could use."""
    complete = F.col(item.event_ts).isNotNull()
    for key in item.table.keys:
        complete = complete & F.col(key).isNotNull()
    df = item.df.filter(complete)
    if bounds is None:
        return df
    carried = _carried(item, bounds)
    if carried is None:
        return bounds.keep_usable(df, item.event_ts, item.table.max_age, item.day)
    recent = bounds.keep_usable(df, item.event_ts, item.table.max_age, item.day, since=carried.cut)
    created = [item.created_ts] if item.created_ts and item.created_ts in df.columns else []
    names = dict.fromkeys([*item.table.keys, *item.table.feature_names, item.event_ts, *created, *item.table.tie_break])
    earlier = carried.rows.withColumnsRenamed({EVENT_TS: item.event_ts, **({CREATED_TS: created[0]} if created else {})})
    earlier = bounds.keep_usable(earlier, item.event_ts, item.table.max_age)
    return recent.select(*names).unionByName(earlier.select(*names))


def _carried(item: FeatureInput, bounds: SpineBounds) -> CarryIn | None:
    """The snapshot to start from, if the table's max age reaches back before it."""
    if item.snapshots is None or bounds.first is None:
        return None
    created = bool(item.created_ts) and item.created_ts in item.df.columns
    carried = item.snapshots.before(bounds.first, item.table, created)
    oldest = bounds.oldest(item.table.max_age)
    return None if carried is None or (oldest is not None and oldest >= carried.cut) else carried


def _prepare(
    item: FeatureInput,
    df: DataFrame,
    spine: DataFrame,
    spine_ts: str,
    bounds: SpineBounds | None,
    reduce_by_spine: bool | None,
    slot: str,
) -> DataFrame:
    """Feature rows as (keys, time, struct of everything that orders or is returned)."""
    table = item.table
    have, want = df.schema[item.event_ts].dataType, spine.schema[spine_ts].dataType
    if have != want:
        df = df.withColumn(item.event_ts, as_time(F.col(item.event_ts), have, want))
    if bounds and reduce_by_spine is not False and bounds.keys_fit(spine.sparkSession, table.keys):
        # Measured on the stored spine that these keys come from.
        df = df.join(F.broadcast(distinct_keys(spine, table.keys)), table.keys, "left_semi")
    elif bounds and reduce_by_spine is None and bounds.rows <= SKETCH_KEYS:
        df = sketch_reduce(df, spine, table.keys, bounds.rows)
    elif reduce_by_spine:
        df = semi_reduce(df, spine, table.keys)
    order = [F.col(item.event_ts).alias("ts")]
    if item.created_ts and item.created_ts in df.columns:
        order.append(F.col(item.created_ts).alias("created"))
    order += [F.col(c).alias(f"tie{i}") for i, c in enumerate(table.tie_break)]
    values = [F.col(f).alias(f"v{i}") for i, f in enumerate(table.feature_names)]
    return df.select(
        *sorted(table.keys), F.col(item.event_ts).alias(_TS), F.struct(*order, *values).alias(slot)
    )


def _find_hot(
    spine: DataFrame,
    spine_ts: str,
    members: list[FeatureInput],
    bounded: list[DataFrame],
    keys: Sequence[str],
    skew: SkewOptions,
) -> HotKeys | None:
    """Hot keys of spine and features, sampled before any join."""
    want = spine.schema[spine_ts].dataType
    rows = spine.select(*keys, F.col(spine_ts).alias(_TS))
    for item, df in zip(members, bounded):
        at = as_time(F.col(item.event_ts), df.schema[item.event_ts].dataType, want)
        rows = rows.unionByName(df.select(*keys, at.alias(_TS)))
    return find_hot_keys(rows, keys, _TS, skew)


def _one_pass(
    spine: DataFrame,
    spine_ts: str,
    keys: list[str],
    members: list[FeatureInput],
    prepared: list[DataFrame],
    hot: HotKeys | None,
    full: bool,
) -> DataFrame:
    slots = [f"__tm_f{i}" for i in range(len(members))]
    slot_types = [df.schema[slot].dataType for df, slot in zip(prepared, slots)]
    # Keys are aliased on every branch: Spark then sees that all branches of the union are
    # partitioned alike when they are, and leaves out the shuffle.
    inner = [f"__tm_k{i}" for i in range(len(keys))]
    rest = [c for c in spine.columns if c not in keys and c != spine_ts]
    rest_type = T.StructType([T.StructField(c, spine.schema[c].dataType) for c in rest])

    def aligned(df: DataFrame, own: str | None, slice_no: Column, rest_col: Column, side: int) -> DataFrame:
        empty = {s: F.lit(None).cast(t) for s, t in zip(slots, slot_types)}
        if own:
            empty[own] = F.col(own)
        return df.select(
            *[F.col(k).alias(i) for k, i in zip(keys, inner)],
            F.col(_TS),
            slice_no.alias(SLICE),
            F.lit(side).alias(_SIDE),
            rest_col.alias(_REST),
            *[empty[s].alias(s) for s in slots],
        )

    no_rest = F.lit(None).cast(rest_type) if rest else F.lit(None).cast("int")
    rest_col = F.struct(*[_c(c) for c in rest]) if rest else F.lit(None).cast("int")
    spread = row_spread(spine)
    key_missing = F.lit(False)
    for key in keys:
        key_missing = key_missing | F.col(key).isNull()
    groups = _NULL_KEY_GROUPS * int(spine.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    null_group = F.pmod(F.xxhash64(*spread), F.lit(groups).cast("long")).cast("int")

    spine_rows = spine.withColumn(_TS, F.col(spine_ts))
    spine_slice = F.lit(0)
    if hot:
        spine_rows = assign_slices(spine_rows, hot, _TS, "spine", spread)
        spine_slice = F.col(SLICE)
    spine_slice = F.when(key_missing | F.col(_TS).isNull(), -1 - null_group).otherwise(spine_slice)
    parts = [aligned(spine_rows, None, spine_slice, rest_col, 1)]

    for features, slot in zip(prepared, slots):
        if not hot:
            parts.append(aligned(features, slot, F.lit(0), no_rest, 0))
            continue
        sliced = assign_slices(features, hot, _TS, "feature", [F.col(slot)])
        parts.append(aligned(sliced, slot, F.col(SLICE), no_rest, 0))
        carried = _carry_in(sliced.filter(F.col(HOT)), slot, hot)
        carried = carried.withColumn(_TS, F.lit(None).cast(spine.schema[spine_ts].dataType))
        parts.append(aligned(carried, slot, F.col(SLICE), no_rest, 0))

    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    so_far = (
        Window.partitionBy(*inner, SLICE)
        .orderBy(F.col(_TS).asc_nulls_first(), F.col(_SIDE))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = everything.withColumns({s: F.max(s).over(so_far) for s in slots}).filter(
        F.col(_SIDE) == 1
    )

    output = []
    for column in spine.columns:
        if column in keys:
            output.append(F.col(inner[keys.index(column)]).alias(column))
        elif column == spine_ts:
            output.append(F.col(_TS).alias(column))
        else:
            output.append(F.col(_REST)[column].alias(column))
    for item, slot in zip(members, slots):
        found = F.col(slot)
        fresh = found.isNotNull()
        if item.table.max_age is not None:
            fresh = found["ts"] >= F.col(_TS) - F.lit(item.table.max_age)
        for i, feature in enumerate(item.table.feature_names):
            name = output_name(item.table.name, feature, full)
            output.append(F.when(fresh, found[f"v{i}"]).alias(name))
    return matched.select(*output)


def _carry_in(hot_features: DataFrame, slot: str, hot: HotKeys) -> DataFrame:
    """Latest feature row of all earlier slices, for every slice of every hot key.

    The aggregate leaves at most one row per (key, slice), so the window that follows sees
    a few thousand rows per key however many rows the key has.
    """
    keys = list(hot.keys)
    grid = hot.slice_grid(hot_features.sparkSession).withColumn(
        slot, F.lit(None).cast(hot_features.schema[slot].dataType)
    )
    newest = (
        hot_features.select(*keys, SLICE, slot)
        .unionByName(grid)
        .groupBy(*keys, SLICE)
        .agg(F.max(slot).alias(slot))
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    return newest.withColumn(slot, F.max(slot).over(earlier)).filter(F.col(slot).isNotNull())
