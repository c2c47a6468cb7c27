"""Hot keys: find them cheaply, then split their rows without changing any result.

A window or join puts all rows of one key into one task. `find_hot_keys` looks for keys
that are too big for that on a sample of the key columns; the sample only steers where
rows go, never which rows count. Two ways to split a hot key are offered:

* time slices (`assign_slices`), for operators that need a key's rows in time order, and
* salts (`salted_join`), for joins against a side with one row per key.

What is found is kept as plain values in the plan, so a re-run of a lost task places its
rows exactly as the first run did.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one key that a single task sorts without trouble.
HOT_ROWS = 2_000_000
SAMPLE_FRACTION = 0.01
# The threshold follows the data: a key with less than this share of all rows is never hot, for
# there can not be more such keys than that, and it takes no more than this share of the work.
# Slices are as fine. What is collected and broadcast stays at some ten MB, whatever the data.
LARGEST_SHARES = 200_000
MAX_SLICES = 2 * LARGEST_SHARES

SLICE = "__tm_slice"
HOT = "__tm_hot"
_BOUNDS = "__tm_bounds"
_PLACE = "__tm_place"
_SALT = "__tm_salt"
_SALTS = "__tm_salts"


@dataclass(frozen=True)
class SkewOptions:
    """When a key counts as hot and how finely it is split.

    `known` gives hot keys that the caller knows, with their numbers of rows, as tuples
    (key values in the order of the sorted key columns, then the number): joins by salts then
    sample nothing, and time slices look at the rows of these keys only.
    """

    hot_rows: int = HOT_ROWS
    sample_fraction: float = SAMPLE_FRACTION
    known: tuple[tuple, ...] | None = None


@dataclass(frozen=True)
class HotKeys:
    """Hot keys with their estimated row counts and, for slicing, time bounds."""

    keys: tuple[str, ...]
    key_schema: T.StructType
    rows: tuple[tuple, ...]  # (key values...)
    counts: tuple[int, ...] = ()
    # Ascending; may repeat a time that holds many rows. Instants are kept as microseconds.
    bounds: tuple[tuple, ...] = ()
    ts_type: T.DataType | None = None

    def __len__(self) -> int:
        return len(self.rows)

    def with_bounds(self, spark: SparkSession) -> DataFrame:
        """One row per hot key: its distinct bound times, and how many bounds (repeats
        included) lie before each of them."""
        data = []
        for key, bounds in zip(self.rows, self.bounds):
            times = sorted(set(bounds))
            before = [bisect_left(bounds, t) for t in times] + [len(bounds)]
            data.append((*key, times, before))
        held = T.LongType() if isinstance(self.ts_type, T.TimestampType) else self.ts_type
        schema = T.StructType(
            [
                *self.key_schema.fields,
                T.StructField("times", T.ArrayType(held)),
                T.StructField("before", T.ArrayType(T.IntegerType())),
            ]
        )
        times = F.col("times")
        if held != self.ts_type:
            times = F.transform(times, F.timestamp_micros)
        found = F.struct(times.alias("times"), "before").alias(_BOUNDS)
        return spark.createDataFrame(data, schema).select(*self.keys, found)

    def slice_grid(self, spark: SparkSession) -> DataFrame:
        """Every (key, slice) of every hot key."""
        data = [(*key, len(bounds) + 1) for key, bounds in zip(self.rows, self.bounds)]
        schema = T.StructType([*self.key_schema.fields, T.StructField("n", T.IntegerType())])
        grid = spark.createDataFrame(data, schema)
        return grid.select(
            *self.keys, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias(SLICE)
        )

    def with_salts(self, spark: SparkSession, hot_rows: int) -> DataFrame:
        """One row per hot key: keys and its number of salts (MAX_SLICES in total, about)."""
        per_salt = max(hot_rows / 2, sum(self.counts) / MAX_SLICES, 1)
        data = [(*key, max(2, ceil(n / per_salt))) for key, n in zip(self.rows, self.counts)]
        schema = T.StructType([*self.key_schema.fields, T.StructField(_SALTS, T.IntegerType())])
        return spark.createDataFrame(data, schema)


def row_spread(df: DataFrame) -> list[Column]:
    """What to hash to spread the rows of one key: the row itself and, for rows that are
    all alike, the input partition they come from. Both are the same when a task is run
    again. Maps cannot be hashed and are left out."""
    usable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return [*[F.col(f"`{name}`") for name in usable], F.spark_partition_id()]


def _not_null(names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


def find_hot_keys(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str | None = None,
    options: SkewOptions = SkewOptions(),
) -> HotKeys | None:
    """Keys with about `hot_rows` rows or more; with `ts` also time bounds that cut each
    of them into slices of about equal size.

    One job over a sample of the key columns (a second one, over hot keys only, for the
    bounds). Returns None when no key is hot, which is the usual case.
    """
    spark = rows.sparkSession
    fraction = options.sample_fraction
    sample = rows.filter(_not_null(keys))
    if fraction < 1.0:
        sample = sample.sample(withReplacement=False, fraction=fraction, seed=17)
    if options.known is not None:
        order = [sorted(keys).index(k) for k in keys]
        found = [(*(r[i] for i in order), r[-1]) for r in options.known if r[-1] >= options.hot_rows]
        counts = [int(r[-1]) for r in found]
    else:
        found = (
            sample.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("__tm_n"))
            .filter(F.col("__tm_n") >= max(2, int(options.hot_rows * fraction)))
            .orderBy(F.col("__tm_n").desc())
            .limit(LARGEST_SHARES)
            .collect()
        )
        counts = [int(r["__tm_n"] / fraction) for r in found]
    if not found:
        return None
    key_schema = T.StructType([rows.schema[k] for k in keys])
    key_rows = [tuple(r[:-1]) for r in found]
    if ts is None:
        return HotKeys(tuple(keys), key_schema, tuple(key_rows), tuple(counts))

    # Slices of about hot_rows / 2 rows, coarser if that would be too many in total.
    target = max(options.hot_rows / 2, sum(counts) / MAX_SLICES, 1)
    slices = [max(2, ceil(n / target)) for n in counts]
    finest = max(slices)
    marks = [i / finest for i in range(1, finest)]
    plan_schema = T.StructType([*key_schema.fields, T.StructField("__tm_s", T.IntegerType())])
    hot = spark.createDataFrame([(*k, s) for k, s in zip(key_rows, slices)], plan_schema)
    # Thin out the quantiles before collecting: a key with s slices needs s - 1 of them.
    picked = F.transform(
        F.sequence(F.lit(1), F.col("__tm_s") - 1),
        lambda i: F.element_at(
            "__tm_q", F.greatest(F.lit(1), (i * F.lit(finest) / F.col("__tm_s")).cast("int"))
        ),
    )
    quantiles = (
        sample.select(*keys, ts)
        .join(F.broadcast(hot), list(keys))
        .groupBy(*keys, "__tm_s")
        .agg(F.percentile_approx(ts, marks, max(10_000, 4 * finest)).alias("__tm_q"))
        .select(*keys, F.sort_array(F.array_compact(picked)).alias("__tm_b"))
    )
    ts_type = rows.schema[ts].dataType
    if isinstance(ts_type, T.TimestampType):
        quantiles = quantiles.withColumn("__tm_b", F.transform("__tm_b", F.unix_micros))
    quantiles = quantiles.collect()
    return HotKeys(
        tuple(keys),
        key_schema,
        tuple(tuple(r[:-1]) for r in quantiles),
        (),
        tuple(tuple(r["__tm_b"]) for r in quantiles),
        ts_type,
    )


def assign_slices(
    df: DataFrame, hot: HotKeys, ts: str, role: str, spread: Sequence[Column] = ()
) -> DataFrame:
    """Add the slice number of each row, 0 for keys that are not hot, and the flag `HOT`.

    Slices follow time: a feature at or before a spine row never lands in a later slice
    than that spine row, and a feature after it never in an earlier one. Where one time
    holds so many rows that it fills several slices, rows of `role` "feature" use the lower
    ones and those of "spine" the upper ones, spread by a hash of the row. Rows of role
    "time" stay together when their times are equal.

    The bounds are broadcast; they are a few MB at most (see the limits above).
    """
    at, bounds = F.col(ts), F.col(_BOUNDS)
    times = bounds["times"]
    df = df.join(F.broadcast(hot.with_bounds(df.sparkSession)), list(hot.keys), "left")
    # Binary search for the number of times before `at`. Each halving is a column of its
    # own, so Spark compiles the search to a few comparisons per row.
    df = df.withColumn(_PLACE, F.lit(0))
    place = F.col(_PLACE)
    for bit in reversed(range(max(len(b) for b in hot.bounds).bit_length())):
        smaller = F.get(times, place + ((1 << bit) - 1)) < at
        df = df.withColumn(_PLACE, F.when(smaller, place + (1 << bit)).otherwise(place))
    df = df.withColumns(
        {
            "__tm_low": F.get(bounds["before"], place),
            "__tm_high": F.get(
                bounds["before"], F.when(F.get(times, place) == at, place + 1).otherwise(place)
            ),
        }
    )
    low, high = F.col("__tm_low"), F.col("__tm_high")
    middle = low + F.floor((high - low) / 2).cast("int")
    if role == "time":
        number = low
    else:
        start, width = (middle, high - middle) if role == "spine" else (low, middle - low)
        number = start + F.pmod(F.xxhash64(*spread), (width + 1).cast("long")).cast("int")
    return df.withColumns(
        {SLICE: F.when(bounds.isNull(), F.lit(0)).otherwise(number), HOT: bounds.isNotNull()}
    ).drop(_BOUNDS, _PLACE, "__tm_low", "__tm_high")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    skew: SkewOptions | None = SkewOptions(),
    *,
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """`left` joined (`how` is "left" or "left_semi") to a `right` with one row per key.

    Left rows of a hot key are spread over its salts; the one right row of that key is
    repeated once per salt, which adds MAX_SLICES rows at most, give or take a salt per key.
    `key_rows` is a cheaper frame with the same keys as `left`, for the sample.
    """
    hot = find_hot_keys(left if key_rows is None else key_rows, keys, None, skew) if skew else None
    if hot is None:
        return left.join(right, list(keys), how)
    salts = F.broadcast(hot.with_salts(left.sparkSession, skew.hot_rows))
    n = F.coalesce(F.col(_SALTS), F.lit(1))
    salt = F.pmod(F.xxhash64(*row_spread(left)), n.cast("long")).cast("int")
    left = left.join(salts, list(keys), "left").withColumn(_SALT, salt)
    right = right.join(salts, list(keys), "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), n - 1))
    )
    return left.drop(_SALTS).join(right.drop(_SALTS), [*keys, _SALT], how).drop(_SALT)
