"""Point-in-time joins: literal cases, brute force, and plans."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import FeatureInput, FeatureTable, Field, SchemaError, SkewOptions, as_of_join, multi_as_of
from tidemark.operators.reduce import candidate_counts

EVERYTHING_HOT = SkewOptions(hot_rows=2, sample_fraction=1.0)
PLANS = [None, SkewOptions(), EVERYTHING_HOT]
# The caller says that key 1 is hot, and names a key that has no rows.
ONE_HOT = SkewOptions(hot_rows=2, sample_fraction=1.0, known=((1, 20), (99, 7)))


def at(day, month=9, **kw):
    return datetime(2020, month, day, **kw)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def table(name, keys, features, max_age=None, **kw):
    return FeatureTable(
        name,
        tuple(Field(k, "INT32") for k in keys),
        tuple(Field(f, t) for f, t in features.items()),
        max_age,
        **kw,
    )


def spine_of(spark, rows, keys):
    return spark.createDataFrame(rows, ", ".join(f"{k} int" for k in keys) + ", event_timestamp timestamp_ntz")


def features_of(spark, rows, keys, values):
    times = "event_timestamp timestamp_ntz, created_timestamp timestamp_ntz"
    return spark.createDataFrame(rows, ", ".join(f"{k} int" for k in keys) + f", {times}, {values}")


@pytest.mark.parametrize("skew", PLANS)
def test_a_reading_serves_until_its_age_is_exactly_the_limit(spark, skew):
    """One water gauge, read once; asked every quarter of an hour around the limit."""
    read = at(14, hour=6)
    limit = timedelta(minutes=45)
    asked = [read + timedelta(minutes=15) * i for i in range(-1, 5)] + [read + limit + timedelta(microseconds=1)]
    gauge = table("gauge", ["station"], {"level": "DOUBLE"}, limit)
    feats = features_of(spark, [(4, read, read, 2.75)], ["station"], "level double")
    got = as_of_join(spine_of(spark, [(4, t) for t in asked], ["station"]), "event_timestamp", feats, gauge, skew=skew)
    assert got.columns == ["station", "event_timestamp", "gauge__level"]
    for row in got.collect():
        age = row.event_timestamp - read
        assert row.gauge__level == (2.75 if timedelta(0) <= age <= limit else None), row


@pytest.mark.parametrize("skew", PLANS)
def test_all_parts_of_a_key_must_agree(spark, skew):
    """Every pair of shelf and slot is asked; a third of them has stock, one part alone never does."""
    stocked = {(shelf, slot): 10 * shelf + slot for shelf in range(3) for slot in range(3) if (shelf + slot) % 3 == 0}
    keys = ["shelf", "slot"]
    spine = spine_of(spark, [(shelf, slot, at(20)) for shelf in range(4) for slot in range(4)], keys)
    feats = features_of(spark, [(*k, at(19), at(19), n) for k, n in stocked.items()], keys, "items int")
    got = as_of_join(spine, "event_timestamp", feats, table("stock", keys, {"items": "INT32"}), skew=skew)
    assert {(r.shelf, r.slot): r.stock__items for r in got.collect()} == {
        (shelf, slot): stocked.get((shelf, slot)) for shelf in range(4) for slot in range(4)
    }


def test_a_table_may_know_fewer_keys_than_the_spine(spark):
    """Prices per shelf serve every slot of the shelf."""
    prices = {shelf: 1.5 * shelf for shelf in (1, 2)}
    spine = spine_of(spark, [(shelf, slot, at(9)) for shelf in (1, 2, 3) for slot in (1, 2)], ["shelf", "slot"])
    feats = features_of(spark, [(s, at(8), at(8), p) for s, p in prices.items()], ["shelf"], "price double")
    got = as_of_join(spine, "event_timestamp", feats, table("p", ["shelf"], {"price": "DOUBLE"}))
    assert rows_of(got) == Counter(
        (shelf, slot, at(9), prices.get(shelf)) for shelf in (1, 2, 3) for slot in (1, 2)
    )


@pytest.mark.parametrize("skew", PLANS)
@pytest.mark.parametrize("checkpoint_every", [None, 1])
def test_tables_of_different_keys_and_corrections(spark, skew, checkpoint_every):
    """Levels per station, corrected twice for the same hour, and one forecast per region."""
    levels = [(s, at(3, hour=h), at(3, hour=h, minute=m), 100 * s + 10 * h + m) for s in (1, 2) for h in (1, 5) for m in (7, 3, 9)]
    forecasts = [(8, at(2), at(2), 0.25), (8, at(4), at(4), 0.75)]
    asked = [(s, r, at(3, hour=h)) for s in (1, 2, 3) for r in (8, 9) for h in (0, 4, 6)]
    got = multi_as_of(
        spine_of(spark, asked, ["station", "region"]),
        "event_timestamp",
        [
            FeatureInput(table("level", ["station"], {"cm": "INT32"}, timedelta(hours=2)), features_of(spark, levels, ["station"], "cm int")),
            FeatureInput(table("rain", ["region"], {"p": "DOUBLE"}), features_of(spark, forecasts, ["region"], "p double")),
        ],
        skew=skew,
        checkpoint_every=checkpoint_every,
    )

    def expected(station, region, t):
        hour = 5 if t.hour == 6 else None  # at 4 o'clock the reading of 1 o'clock is too old
        cm = 100 * station + 10 * hour + 9 if hour and station < 3 else None
        return station, region, t, cm, 0.25 if region == 8 else None

    assert rows_of(got) == Counter(expected(*row) for row in asked)


def test_later_feature_in_the_same_second_does_not_leak(spark):
    spine = spine_of(spark, [(1, at(1, microsecond=100))], ["k"])
    feats = features_of(spark, [(1, at(1, microsecond=200), at(1), 1)], ["k"], "v int")
    got = as_of_join(spine, "event_timestamp", feats, table("t", ["k"], {"v": "INT32"}, 60))
    assert [r.t__v for r in got.collect()] == [None]


def test_late_correction_of_an_older_event_does_not_hide_the_newer_one(spark):
    spine = spine_of(spark, [(1, at(20))], ["k"])
    feats = features_of(spark, [(1, at(10), at(10), 1), (1, at(5), at(19), 2)], ["k"], "v int")
    got = as_of_join(spine, "event_timestamp", feats, table("t", ["k"], {"v": "INT32"}))
    assert [r.t__v for r in got.collect()] == [1]


@pytest.mark.parametrize("skew", PLANS)
def test_spine_rows_come_out_once_each(spark, skew):
    rows = [(1, at(2)), (1, at(2)), (None, at(2)), (1, None), (7, at(2))]
    spine = spine_of(spark, rows, ["k"])
    feats = features_of(
        spark,
        [(1, at(2), at(2), 5), (1, at(1), at(1), 4), (None, at(1), at(1), 9), (1, None, at(1), 8)],
        ["k"],
        "v int",
    )
    got = as_of_join(spine, "event_timestamp", feats, table("t", ["k"], {"v": "INT32"}), skew=skew)
    assert rows_of(got) == Counter(
        [(1, at(2), 5), (1, at(2), 5), (None, at(2), None), (1, None, None), (7, at(2), None)]
    )


def test_newest_row_wins_even_when_its_feature_is_null(spark):
    spine = spine_of(spark, [(1, at(5))], ["k"])
    feats = features_of(spark, [(1, at(1), at(1), 4), (1, at(2), at(2), None)], ["k"], "v int")
    got = as_of_join(spine, "event_timestamp", feats, table("t", ["k"], {"v": "INT32"}))
    assert [r.t__v for r in got.collect()] == [None]


def test_empty_feature_table_and_empty_spine(spark):
    spine = spine_of(spark, [(1, at(5))], ["k"])
    none = features_of(spark, [], ["k"], "v int")
    t = table("t", ["k"], {"v": "INT32"}, 60)
    assert [tuple(r) for r in as_of_join(spine, "event_timestamp", none, t).collect()] == [(1, at(5), None)]
    assert as_of_join(spine.limit(0), "event_timestamp", none, t).count() == 0


def test_bare_names_that_collide_raise(spark):
    spine = spine_of(spark, [(1, at(5))], ["k"])
    feats = features_of(spark, [], ["k"], "v int")
    inputs = [FeatureInput(table(n, ["k"], {"v": "INT32"}), feats) for n in ("a", "b")]
    with pytest.raises(SchemaError, match="twice"):
        multi_as_of(spine, "event_timestamp", inputs, full_feature_names=False)
    assert multi_as_of(spine, "event_timestamp", inputs).columns[-2:] == ["a__v", "b__v"]


def test_spine_with_map_and_odd_column_names(spark):
    spine = spine_of(spark, [(1, at(5)), (None, at(5))], ["k"]).withColumns(
        {"m": F.create_map(F.lit("a"), F.lit(1)), "odd.name": F.lit("x")}
    )
    feats = features_of(spark, [(1, at(1), at(1), 4)], ["k"], "v int")
    got = as_of_join(spine, "event_timestamp", feats, table("t", ["k"], {"v": "INT32"}))
    assert {(r["k"], r["odd.name"], r["m"]["a"], r["t__v"]) for r in got.collect()} == {
        (1, "x", 1, 4),
        (None, "x", 1, None),
    }


def test_many_keys_each_with_one_row_in_reach(spark):
    """Key k has rows at minutes k, 2k, 3k ...; asked at minute 997 the last multiple answers."""
    start = datetime(2023, 3, 1)
    rows = spark.range(1, 400).select(
        F.col("id").cast("int").alias("k"), F.explode(F.sequence(F.col("id"), F.lit(2000), F.col("id"))).alias("m")
    )
    minute = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("m").cast("int"))
    feats = rows.select("k", minute.alias("event_timestamp"), F.col("m").cast("int").alias("v"))
    spine = rows.select("k").distinct().select("k", F.lit(start + timedelta(minutes=997)).cast("timestamp_ntz").alias("event_timestamp"))
    got = as_of_join(spine, "event_timestamp", feats, table("b", ["k"], {"v": "INT32"}, timedelta(minutes=150)))
    for row in got.collect():
        last = 997 // row.k * row.k
        assert row.b__v == (last if 997 - last <= 150 else None), row


# ---------------------------------------------------------------------------- brute force

minutes = st.integers(0, 12)
keys = st.one_of(st.none(), st.integers(0, 2))
spine_rows = st.lists(st.tuples(keys, st.one_of(st.none(), minutes)), max_size=25)
feature_rows = st.lists(
    st.tuples(
        keys,
        st.one_of(st.none(), minutes),
        st.one_of(st.none(), minutes),
        st.one_of(st.none(), st.integers(0, 3)),
    ),
    max_size=25,
)


def clock(minute):
    return None if minute is None else datetime(2024, 1, 1) + timedelta(minutes=minute)


def low(value):
    """Nulls sort before everything."""
    return (value is not None, value)


def brute_force(spine, feats, max_age):
    out = Counter()
    for key, t in spine:
        found = [
            f
            for f in feats
            if key is not None and t is not None and f[0] == key and f[1] is not None and f[1] <= t
        ]
        best = max(found, key=lambda f: (f[1], low(f[2]), low(f[3])), default=None)
        if best is not None and max_age is not None and best[1] < t - max_age:
            best = None
        out[(key, clock(t), best[3] if best else None)] += 1
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spine=spine_rows, feats=feature_rows, max_age=st.one_of(st.none(), st.integers(1, 6)))
def test_equals_brute_force(spark, spine, feats, max_age):
    spine_df = spine_of(spark, [(k, clock(t)) for k, t in spine], ["k"])
    feats_df = features_of(spark, [(k, clock(t), clock(c), v) for k, t, c, v in feats], ["k"], "v int")
    t = table("t", ["k"], {"v": "INT32"}, None if max_age is None else max_age * 60)
    expected = brute_force(spine, feats, max_age)
    for skew in (None, EVERYTHING_HOT, ONE_HOT):
        for reduce in (None, False, True) if skew is None else (None,):
            got = as_of_join(
                spine_df, "event_timestamp", feats_df, t, skew=skew, reduce_by_spine=reduce
            )
            assert rows_of(got) == expected, (skew, reduce)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spine=spine_rows, feats=feature_rows, max_age=st.integers(1, 6))
def test_candidate_counts_equal_pairs(spark, spine, feats, max_age):
    spine_df = spine_of(spark, [(k, clock(t)) for k, t in spine], ["k"])
    feats_df = features_of(spark, [(k, clock(t), clock(c), v) for k, t, c, v in feats], ["k"], "v int")
    pairs = Counter(
        k
        for k, t in spine
        for f in feats
        if k is not None and t is not None and f[0] == k and f[1] is not None and t - max_age <= f[1] <= t
    )
    for skew in (None, EVERYTHING_HOT):
        got = candidate_counts(
            spine_df,
            "event_timestamp",
            feats_df,
            "event_timestamp",
            ["k"],
            timedelta(minutes=max_age),
            skew=skew,
        )
        assert {r.k: r.n for r in got.collect()} == dict(pairs), skew


def test_one_hot_key_is_spread_over_many_groups(spark):
    """One key holds all rows, and one time holds half of them: no window group is large."""
    n = 4_000
    feats = spark.range(n).select(
        F.lit(1).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("m"),
        F.col("id").cast("int").alias("v"),
    )
    moment = (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m").cast("int"))).cast(
        "timestamp_ntz"
    )
    feats = feats.select("k", moment.alias("event_timestamp"), "v")
    spine = feats.select("k", "event_timestamp", F.col("v").alias("row"))
    t = FeatureTable("t", (Field("k", "INT32"),), (Field("v", "INT32"),))
    skew = SkewOptions(hot_rows=200, sample_fraction=1.0)
    got = as_of_join(spine, "event_timestamp", feats, t, skew=skew)
    plain = as_of_join(spine, "event_timestamp", feats, t, skew=None)
    assert rows_of(got) == rows_of(plain)

    from tidemark.plans.skew import SLICE, assign_slices, find_hot_keys, row_spread

    hot = find_hot_keys(spine.select("k", "event_timestamp"), ["k"], "event_timestamp", skew)
    sliced = assign_slices(spine, hot, "event_timestamp", "spine", row_spread(spine))
    sizes = sliced.groupBy(SLICE).count().collect()
    assert len(sizes) >= 15
    assert max(r["count"] for r in sizes) <= 800


# ---------------------------------------------------------------------------------- plans


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def event_frames(spark, sf_dir="/root/testdata/sf0.001"):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    spine = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    feats = events.withColumnRenamed("ts", "event_timestamp")
    return spine, feats


def test_tables_with_the_same_keys_share_one_shuffle(spark):
    spine, feats = event_frames(spark)
    user = (Field("user_id", "INT64"),)
    inputs = [
        FeatureInput(FeatureTable(name, user, (Field("value", "DOUBLE"),)), feats.filter(f"event_type='{name}'"))
        for name in ("view", "click")
    ]
    plan = physical_plan(multi_as_of(spine, "ts", inputs, skew=None, bound_by_spine=False))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan
    assert "props" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_spine_bounds_reach_the_feature_scan(spark, kind):
    spine, feats = event_frames(spark)
    spine = spine.withColumn("ts", F.col("ts").cast(kind))
    feats = feats.withColumn("event_timestamp", F.col("event_timestamp").cast(kind))
    t = FeatureTable("e", (Field("user_id", "INT64"),), (Field("value", "DOUBLE"),), timedelta(hours=1))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2_000)
    plan = physical_plan(as_of_join(spine, "ts", feats, t, skew=None, reduce_by_spine=False))
    assert "Subquery" not in plan
    feature_scan = plan.split("FileScan")[-1]
    if kind == "timestamp_ntz":  # the type of the file; the other case filters on a cast
        pushed = feature_scan.split("PushedFilters")[1]
        assert "LessThanOrEqual(ts," in pushed and "GreaterThanOrEqual(ts," in pushed
    else:
        assert "cast(ts" in feature_scan.split("DataFilters")[1]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_both_timestamp_types(spark, kind):
    spine = spine_of(spark, [(1, at(2)), (1, at(5)), (2, at(2))], ["k"])
    spine = spine.withColumn("event_timestamp", F.col("event_timestamp").cast(kind))
    feats = features_of(spark, [(1, at(2), at(2), 5), (1, at(4), at(4), 6)], ["k"], "v int")
    t = table("t", ["k"], {"v": "INT32"}, 3 * 86400)
    for skew in PLANS:
        got = as_of_join(spine, "event_timestamp", feats, t, skew=skew)
        assert rows_of(got.select("k", "t__v")) == Counter([(1, 5), (1, 6), (2, None)])
        assert got.schema["event_timestamp"].dataType.simpleString() == kind


def test_bucketed_tables_join_without_a_shuffle(spark):
    spine, feats = event_frames(spark)
    for name, df in (("tm_spine", spine), ("tm_feats", feats)):
        df.write.mode("overwrite").bucketBy(8, "user_id").sortBy("user_id").saveAsTable(name)
    t = FeatureTable("e", (Field("user_id", "INT64"),), (Field("value", "DOUBLE"),))
    df = as_of_join(
        spark.table("tm_spine"), "ts", spark.table("tm_feats"), t, skew=None, bound_by_spine=False
    )
    assert "Exchange" not in physical_plan(df)
    assert rows_of(df) == rows_of(as_of_join(spine, "ts", feats, t))


@pytest.mark.parametrize("skew", [*PLANS, ONE_HOT])
def test_semi_reduce_keeps_rows_as_they_are(spark, skew):
    from tidemark.operators.reduce import semi_reduce

    feats = features_of(
        spark, [(1, at(1), at(1), 4), (1, at(1), at(1), 4), (2, at(1), at(1), 5), (None, at(1), at(1), 6)], ["k"], "v int"
    )
    spine = spine_of(spark, [(1, at(1)), (1, at(2)), (None, at(2)), (9, at(2))], ["k"])
    got = semi_reduce(feats, spine, ["k"], skew=skew)
    assert got.columns == feats.columns
    assert [r.v for r in got.collect()] == [4, 4]


def test_small_spine_reduces_features_before_the_shuffle(spark):
    spine, feats = event_frames(spark)
    t = FeatureTable("e", (Field("user_id", "INT64"),), (Field("value", "DOUBLE"),))
    plan = physical_plan(as_of_join(spine, "ts", feats, t, skew=None))
    assert "BroadcastHashJoin [user_id" in plan and "LeftSemi" in plan
    # A spine above Spark's own limit is never broadcast on request of this library.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert "LeftSemi" not in physical_plan(as_of_join(spine, "ts", feats, t, skew=None))
        assert "LeftSemi" in physical_plan(as_of_join(spine, "ts", feats, t, skew=None, reduce_by_spine=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_sample_for_hot_keys_holds_no_join(spark, monkeypatch):
    from tidemark.operators import asof

    plans, find = [], asof.find_hot_keys
    monkeypatch.setattr(asof, "find_hot_keys", lambda rows, *a: plans.append(physical_plan(rows)) or find(rows, *a))
    spine, feats = event_frames(spark)
    t = FeatureTable("e", (Field("user_id", "INT64"),), (Field("value", "DOUBLE"),))
    assert "LeftSemi" in physical_plan(as_of_join(spine, "ts", feats, t, reduce_by_spine=True))
    assert len(plans) == 1 and "Join" not in plans[0]


def test_a_spine_that_changes_is_evaluated_once(spark, folder):
    """Its table grows, and it asks for the current time: what was measured holds all the same."""
    import time

    feats = features_of(spark, [(1, at(1), at(1), 1), (1, at(9), at(9), 2)], ["k"], "v int")
    t = table("t", ["k"], {"v": "INT32"}, timedelta(days=10_000))
    spark.sql("drop table if exists tm_growing")
    spine_of(spark, [(1, at(2))], ["k"]).write.option("path", f"{folder}/growing").saveAsTable("tm_growing")
    lazy = as_of_join(spark.table("tm_growing"), "event_timestamp", feats, t)
    spine_of(spark, [(1, at(20)), (2, at(20))], ["k"]).write.insertInto("tm_growing")
    assert rows_of(lazy) == Counter([(1, at(2), 1)])
    again = as_of_join(spark.table("tm_growing"), "event_timestamp", feats, t)
    assert rows_of(again) == Counter([(1, at(2), 1), (1, at(20), 2), (2, at(20), None)])
    spark.sql("drop table tm_growing")

    now = spark.range(1).select(F.lit(1).alias("k"), F.current_timestamp().alias("event_timestamp"))
    got = as_of_join(now, "event_timestamp", feats, t)
    first = got.collect()
    time.sleep(1.1)
    second = got.collect()
    assert first == second and first[0].t__v == 2


@pytest.mark.parametrize("max_age, last", [(None, 20), (timedelta(days=3), 20)])
def test_spine_times_choose_date_partitions(spark, folder, max_age, last):
    """Only the folders that the spine's times can use are read; the result is the unbounded one."""
    from tidemark import FeatureEngine, Source
    from tidemark.operators.sinks import append_to_batch_store

    feats = features_of(spark, [(1, at(d, hour=5), at(d), d) for d in range(1, 29)], ["k"], "v int")
    append_to_batch_store(feats, f"{folder}/store")
    source = Source(path=f"{folder}/store", event_timestamp="event_timestamp", date_partition="date")
    t = FeatureTable("t", (Field("k", "INT32"),), (Field("v", "INT32"),), max_age, source=source)
    engine = FeatureEngine(spark, [t], skew=None, online_root=f"{folder}/online")
    spine = spine_of(spark, [(1, at(18, hour=2)), (1, at(20, hour=6))], ["k"])
    got = engine.get_historical_features(spine, ["t:v"])
    plan = physical_plan(got)
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "<= 2020-09-20" in filters and (max_age is None or ">= 2020-09-15" in filters)
    assert rows_of(got) == Counter([(1, at(18, hour=2), 17), (1, at(20, hour=6), 20)])
    engine.materialize(at(3), at(5, hour=23))
    assert [r.t__v for r in engine.online_table("t").lookup(spine.limit(1), include_expired=True).collect()] == [5]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("spine_type", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("feature_type", ["timestamp", "timestamp_ntz"])
def test_naive_times_are_utc_in_any_session(spark, zone, spine_type, feature_type):
    """Around the night in which New York's clocks go back, when one local hour comes twice."""
    from tidemark.functions.times import as_time

    def typed(df, name, kind):
        have = df.schema[name].dataType
        return df.withColumn(name, as_time(F.col(name), have, T.DataType.fromDDL(kind)))

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [datetime(2024, 11, 3, h, 30) for h in range(3, 9)]
        feats = features_of(spark, [(1, t, t, i) for i, t in enumerate(times)], ["k"], "v int")
        spine = spine_of(spark, [(1, t + timedelta(minutes=1)) for t in times], ["k"])
        item = table("t", ["k"], {"v": "INT32"}, timedelta(minutes=5))
        got = as_of_join(
            typed(spine, "event_timestamp", spine_type), "event_timestamp", typed(feats, "event_timestamp", feature_type), item
        )
        assert sorted(r.t__v for r in got.collect()) == list(range(6))
        back = typed(got, "event_timestamp", "timestamp_ntz")
        assert sorted(r.event_timestamp for r in back.collect()) == [t + timedelta(minutes=1) for t in times]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
