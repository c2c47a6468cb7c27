"""Online table: fold, commits, lookups, expiry."""

from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import (
    CommitConflict,
    FeatureTable,
    Field,
    OnlineTable,
    SchemaError,
    SkewOptions,
    files,
    fold_batches,
    key_expiry,
)
from tidemark.operators import online as online_module
from tidemark.operators.online import _ranges, update_online_tables, with_expiry

T0 = datetime(2024, 1, 1)
SCHEMA = "k int, event_timestamp timestamp_ntz, a int, b string"
TABLE = FeatureTable("t", (Field("k", "INT32"),), (Field("a", "INT32"), Field("b", "STRING")))


def minute(n):
    return T0 + timedelta(minutes=n)


def frame(spark, rows):
    return spark.createDataFrame([(k, minute(t), a, b) for k, t, a, b in rows], SCHEMA)


def state_of(df):
    return {r.k: (r.event_timestamp, r.a, r.b) for r in df.collect()}


def low(v):
    return (v is not None, v)


def dict_fold(batches):
    state = {}
    for batch in batches:
        newest = {}
        for k, t, a, b in batch:
            if k not in newest or (t, low(a), low(b)) > (newest[k][0], low(newest[k][1]), low(newest[k][2])):
                newest[k] = (t, a, b)
        for k, (t, a, b) in newest.items():
            if k not in state:
                state[k] = (t, a, b)
            elif t >= state[k][0]:
                old = state[k]
                state[k] = (t, a if a is not None else old[1], b if b is not None else old[2])
    return {k: (minute(t), a, b) for k, (t, a, b) in state.items()}


row = st.tuples(
    st.integers(0, 3),
    st.integers(0, 6),
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.sampled_from(["x", "y"])),
)
batch_lists = st.lists(st.lists(row, max_size=6), min_size=1, max_size=4)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=batch_lists)
def test_fold_equals_a_loop(spark, batches):
    folded = fold_batches([frame(spark, b) for b in batches], TABLE)
    assert state_of(folded) == dict_fold(batches)


def test_stored_table_equals_a_loop_across_compactions(spark, folder):
    batches = [
        [(1, 5, 1, "x"), (2, 5, 1, None), (1, 4, 9, "z")],
        [(1, 4, 7, "q"), (2, 5, None, "y"), (3, 1, 3, None)],
        [(1, 6, None, None), (3, 0, 8, "w")],
        [(2, 9, 4, None), (4, 1, 1, "n")],
        [(4, 1, None, "m")],
    ]
    online = OnlineTable(spark, f"{folder}/t", TABLE, buckets=4, compact_after=2)
    for i, b in enumerate(batches):
        online.upsert(frame(spark, b))
        assert state_of(online.rows()) == dict_fold(batches[: i + 1])
    # A second handle, and a session that has not seen the bucketed table yet.
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_online_")]:
        spark.sql(f"DROP TABLE {name}")
    again = OnlineTable(spark, f"{folder}/t", TABLE)
    assert state_of(again.rows()) == dict_fold(batches)
    again.vacuum(retain=timedelta(0))
    assert state_of(again.rows()) == dict_fold(batches)
    again.drop()
    assert OnlineTable(spark, f"{folder}/t", TABLE).rows().count() == 0


def test_old_base_is_not_shuffled(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE, buckets=4, compact_after=100)
    online.upsert(frame(spark, [(i, 1, i, "x") for i in range(50)]))
    online.compact()
    online.upsert(frame(spark, [(1, 2, 5, "y")]))
    plan = online.rows()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the recent batch only
    assert "Bucketed: true" in plan
    online.compact()
    bases = list((__import__("pathlib").Path(folder) / "t" / "base").iterdir())
    files = [p for p in sorted(bases)[-1].iterdir() if p.suffix == ".parquet"]
    assert len(files) <= 4


def test_a_large_base_is_not_rewritten_for_small_batches(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE, buckets=2, compact_after=1)
    online.upsert(frame(spark, [(i, 1, i, "x" * (i % 97)) for i in range(60_000)]))
    base = online._state()["base"]
    for i in range(3):
        online.upsert(frame(spark, [(1, 2 + i, i, "y")]))
    state = online._state()
    assert state["base"] == base and len(state["deltas"]) == 3
    assert online.rows().filter("k = 1").first().a == 2


def test_batches_are_shuffled_once_each(spark):
    spread = [frame(spark, [(1, 1, 1, "x")]), frame(spark, [(1, 2, None, "y")])]
    plan = fold_batches(spread, TABLE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2


def test_key_only_spine_of_equal_rows_is_spread(spark, folder):
    from tidemark.plans.skew import row_spread
    from pyspark.sql import functions as F

    spine = spark.range(0, 2_000, 1, 16).select(F.lit(1).alias("k"))
    groups = spine.groupBy(F.pmod(F.xxhash64(*row_spread(spine)), F.lit(8)).alias("g")).count().collect()
    assert len(groups) > 3
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    online.upsert(frame(spark, [(1, 1, 5, "x")]))
    got = online.lookup(spine, ["a"], skew=SkewOptions(hot_rows=100, sample_fraction=1.0))
    assert [tuple(r) for r in got.distinct().collect()] == [(1, 5)] and got.count() == 2_000


def test_replayed_batches_are_skipped(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    assert online.upsert(frame(spark, [(1, 1, 1, "x")]), batch_id=0, writer="w")
    assert not online.upsert(frame(spark, [(1, 9, 2, "y")]), batch_id=0, writer="w")
    assert online.upsert(frame(spark, [(1, 2, 3, "z")]), batch_id=0, writer="other")
    assert state_of(online.rows()) == {1: (minute(2), 3, "z")}


def _racing(monkeypatch, rival, times=1):
    """Let `rival` commit right before the next `times` commits."""
    real, left = files.create_text, [times]

    def create(spark, path, text):
        if left[0] > 0:
            left[0] -= 1
            rival()
        return real(spark, path, text)

    monkeypatch.setattr(files, "create_text", create)


def test_a_number_is_given_once(spark, folder):
    path = f"{folder}/t/_commits/000000000007.json"
    assert files.create_text(spark, path, "first") and not files.create_text(spark, path, "second")
    assert files.read_text(spark, path) == "first"
    assert files.names_in(spark, f"{folder}/t/_commits") == ["000000000007.json"]


def test_a_write_that_is_second_commits_again(spark, folder, monkeypatch):
    online, rival = (OnlineTable(spark, f"{folder}/t", TABLE) for _ in range(2))
    online.upsert(frame(spark, [(1, 1, 1, "x")]))
    _racing(monkeypatch, lambda: rival.upsert(frame(spark, [(1, 2, 2, "y"), (2, 2, 2, "y")])))
    assert online.upsert(frame(spark, [(1, 2, 3, None)]))
    assert state_of(online.rows()) == {1: (minute(2), 3, "y"), 2: (minute(2), 2, "y")}
    assert [d["seq"] for d in online._state()["deltas"]] == [1, 2, 3]


def test_a_write_that_never_wins_raises(spark, folder, monkeypatch):
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    monkeypatch.setattr(files, "create_text", lambda *args: False)
    with pytest.raises(CommitConflict):
        online.upsert(frame(spark, [(1, 1, 1, "x")]))


def test_a_replay_that_meets_its_own_commit_is_skipped(spark, folder, monkeypatch):
    online, rival = (OnlineTable(spark, f"{folder}/t", TABLE) for _ in range(2))
    rows = frame(spark, [(1, 1, 1, "x")])
    _racing(monkeypatch, lambda: rival.upsert(rows, batch_id=0, writer="w"))
    assert not online.upsert(rows, batch_id=0, writer="w")
    assert len(online._state()["deltas"]) == 1


def test_a_compaction_that_loses_is_quiet_and_later_batches_stay(spark, folder, monkeypatch):
    online, rival = (OnlineTable(spark, f"{folder}/t", TABLE, compact_after=100) for _ in range(2))
    online.upsert(frame(spark, [(1, 1, 1, "x")]))
    _racing(monkeypatch, lambda: rival.upsert(frame(spark, [(1, 3, 5, None)])))
    online.compact()
    assert state_of(online.rows()) == {1: (minute(3), 5, "x")} and len(online._state()["deltas"]) == 1
    base = online._state()["base"]
    _racing(monkeypatch, rival.compact)
    online.upsert(frame(spark, [(2, 1, 1, "x")]))
    online.compact()
    assert online._state()["base"] != base
    assert state_of(online.rows()) == {1: (minute(3), 5, "x"), 2: (minute(1), 1, "x")}


def test_an_unfinished_commit_is_skipped(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    online.upsert(frame(spark, [(1, 1, 1, "x")]))
    for left in ("", '{"version": 2, "del'):
        files.create_text(spark, online._log._name(online.version + 1), left)
        assert state_of(online.rows())[1] == (minute(1), 1, "x")
    online.upsert(frame(spark, [(1, 2, 2, None)]))
    assert state_of(online.rows()) == {1: (minute(2), 2, "x")}


def test_vacuum_spares_the_commit_that_is_read(spark, folder):
    """A finished commit behind an unfinished one is the one in force."""
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    online.upsert(frame(spark, [(1, 1, 1, "x"), (2, 1, 2, "y")]))
    files.create_text(spark, online._log._name(online.version + 1), "")
    online.vacuum(retain=timedelta(0))
    assert set(state_of(online.rows())) == {1, 2}
    online.upsert(frame(spark, [(3, 1, 3, "z")]))
    online.vacuum(retain=timedelta(0))
    assert set(state_of(online.rows())) == {1, 2, 3} and online.version == 3


def test_commits_are_found_without_and_with_an_old_pointer(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    for i in range(3):
        online.upsert(frame(spark, [(1, i, i, "x")]))
    for pointer in ("1", "0", "99", "", "torn"):
        files.write_text(spark, f"{folder}/t/_commits/latest", pointer)
        assert online.version == 3
    files.remove(spark, f"{folder}/t/_commits/latest")
    assert online.version == 3


def test_vacuum_spares_what_a_writer_may_still_commit(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    online.upsert(frame(spark, [(1, 1, 1, "x")]))
    delta = online._write_delta(frame(spark, [(2, 1, 1, "y")]))
    online.vacuum()
    online._commit(lambda s: {**s, "deltas": [*s["deltas"], {**delta, "seq": s["next_seq"]}], "next_seq": s["next_seq"] + 1})
    assert set(state_of(online.rows())) == {1, 2}
    online.compact()
    online.vacuum(retain=timedelta(0))
    assert set(state_of(online.rows())) == {1, 2} and files.names_in(spark, f"{folder}/t/delta") == []


def test_a_feature_keeps_its_stored_type(spark, folder):
    OnlineTable(spark, f"{folder}/t", TABLE).upsert(frame(spark, [(1, 1, 1, "x")]))
    changed = FeatureTable("t", TABLE.entities, (Field("a", "STRING"),))
    rows = frame(spark, [(1, 2, 1, "x")]).withColumn("a", F.lit("text"))
    with pytest.raises(SchemaError, match="stored as"):
        OnlineTable(spark, f"{folder}/t", changed).upsert(rows)
    assert state_of(OnlineTable(spark, f"{folder}/t", TABLE).rows()) == {1: (minute(1), 1, "x")}


def test_many_small_writes_leave_the_base_alone(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE, buckets=2, compact_after=3)
    online.upsert(frame(spark, [(i, 0, i, "x" * (i % 97)) for i in range(30_000)]))
    online.compact()
    base, expected = online._state()["base"], {}
    for i in range(20):
        k = i % 4
        a, b = (None, f"b{i}") if i % 3 else (i, None)
        online.upsert(frame(spark, [(k, 1 + i % 7, a, b)]))
        expected.setdefault(k, []).append([(k, 1 + i % 7, a, b)])
    state = online._state()
    assert state["base"] == base
    assert len(state["deltas"]) < 10 and max(d["level"] for d in state["deltas"]) == 2
    first = {k: (0, k, "x" * k) for k in range(4)}
    for k, batches in expected.items():
        t, a, b = first[k]
        assert state_of(online.rows().filter(f"k = {k}")) == dict_fold([[(k, t, a, b)], *batches])


def test_a_redeclared_max_age_applies(spark, folder):
    def declared(age, **labels):
        return OnlineTable(spark, f"{folder}/t", FeatureTable("t", TABLE.entities, TABLE.features, age, labels=labels))

    rows = frame(spark, [(1, 0, 1, "x")])
    declared(timedelta(days=30)).upsert(rows)
    for age, kept in ((timedelta(days=2), timedelta(days=2)), (None, None), (timedelta(days=5), timedelta(days=5))):
        declared(age).upsert(rows)
        assert declared(age).max_age == kept
    declared(timedelta(days=5)).set_max_age(timedelta(days=9))
    declared(timedelta(days=5)).upsert(rows)  # declared as before: the change stays
    assert declared(None).max_age == timedelta(days=9)
    declared(timedelta(days=1), gcThresholdSec=str(10 * 86_400)).upsert(rows)
    assert declared(None).max_age == timedelta(days=10)


def test_values_expire_by_now_unless_asked_otherwise(spark, folder):
    aged = FeatureTable("t", TABLE.entities, TABLE.features, timedelta(days=30))
    online = OnlineTable(spark, f"{folder}/t", aged)
    now = datetime.now(UTC).replace(tzinfo=None)
    rows = [(1, now - timedelta(days=31), 1, "x"), (2, now - timedelta(days=1), 2, "y")]
    online.upsert(spark.createDataFrame(rows, SCHEMA))
    spine = spark.createDataFrame([(1,), (2,)], "k int")
    for options, expected in (({}, {1: None, 2: 2}), ({"include_expired": True}, {1: 1, 2: 2})):
        assert {r.k: r.t__a for r in online.lookup(spine, ["a"], **options).collect()} == expected
        assert {r["k"]: r["t__a"] for r in online.get([{"k": 1}, {"k": 2}], ["a"], **options)} == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants_are_stored_as_utc_in_any_session(spark, folder, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(1, 1, "x")], "k int, a int, b string")
        rows = rows.withColumn("event_timestamp", F.timestamp_micros(F.lit(1_710_054_000_000_000)))
        online = OnlineTable(spark, f"{folder}/{zone}", TABLE)
        online.upsert(rows)
        assert online.rows().first().event_timestamp == datetime(2024, 3, 10, 7)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rows_without_key_or_time_are_not_stored(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    rows = [(None, minute(1), 1, "x"), (1, None, 1, "x"), (2, minute(1), 1, "x")]
    online.upsert(spark.createDataFrame(rows, SCHEMA))
    assert set(state_of(online.rows())) == {2}


def test_lookup_expiry_and_order(spark, folder):
    aged = FeatureTable("t", TABLE.entities, TABLE.features, timedelta(minutes=10))
    online = OnlineTable(spark, f"{folder}/t", aged)
    online.upsert(frame(spark, [(1, 0, 1, "x"), (2, 5, 2, None)]))
    keys = [{"k": 2}, {"k": 9}, {"k": 1}, {"k": 2}]
    assert [r["t__a"] for r in online.get(keys, ["a"], include_expired=True)] == [2, None, 1, 2]
    late = online.get(keys, ["a"], as_of=minute(12))
    assert [r["t__a"] for r in late] == [2, None, None, 2]
    online.set_max_age(None)
    assert [r["t__a"] for r in online.get(keys, ["a"], as_of=minute(10_000))] == [2, None, 1, 2]
    spine = spark.createDataFrame([(1, "p"), (2, "q"), (2, "q"), (None, "r"), (5, "s")], "k int, extra string")
    for skew in (None, SkewOptions(), SkewOptions(hot_rows=2, sample_fraction=1.0)):
        got = sorted(tuple(r) for r in online.lookup(spine, ["b", "a"], skew=skew).na.fill(-1).na.fill("-").collect())
        assert got == sorted(
            [(1, "p", "x", 1), (2, "q", "-", 2), (2, "q", "-", 2), (-1, "r", "-", -1), (5, "s", "-", -1)]
        )


def test_new_features_appear_after_they_are_declared(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", FeatureTable("t", TABLE.entities, TABLE.features[:1]))
    online.upsert(frame(spark, [(1, 0, 1, "x")]))
    online.compact()
    wider = OnlineTable(spark, f"{folder}/t", TABLE)
    wider.upsert(frame(spark, [(1, 1, None, "y"), (2, 1, 5, "z")]))
    assert state_of(wider.rows()) == {1: (minute(1), 1, "y"), 2: (minute(1), 5, "z")}


def test_key_expiry_is_the_latest_and_never_wins(spark):
    base = spark.createDataFrame([(1, T0), (2, T0)], "k int, event_timestamp timestamp_ntz")
    thirty, sixty = (with_expiry(base, timedelta(days=d)) for d in (30, 60))
    never = with_expiry(base.filter("k = 2"), None)
    got = {r.k: r.expiry_timestamp for r in key_expiry([sixty, thirty, never], ["k"]).collect()}
    assert got == {1: T0 + timedelta(days=60), 2: None}


def test_teardown_keeps_the_other_tables(spark, folder):
    other = FeatureTable("other", TABLE.entities, TABLE.features)
    for t in (TABLE, other):
        OnlineTable(spark, f"{folder}/{t.name}", t).upsert(frame(spark, [(1, 0, 1, "x")]))
    assert update_online_tables(spark, folder, [TABLE], [other]) == ["other"]
    assert OnlineTable(spark, f"{folder}/other", other).rows().count() == 1


def _rows_scanned(df, base):
    """Rows that the scans of a collected frame have read, of the base or of all else."""
    rows, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            plans.append(plan.executedPlan())
        elif "QueryStage" in plan.nodeName():
            plans.append(plan.plan())
        elif plan.nodeName().startswith("Scan parquet"):
            if ("tidemark_online" in plan.nodeName()) == base:
                rows += plan.metrics().apply("numOutputRows").value()
        else:
            children = plan.children()
            plans += [children.apply(i) for i in range(children.size())]
    return rows


def test_a_small_lookup_reads_few_buckets_and_row_groups(spark, folder, monkeypatch):
    monkeypatch.setattr(online_module, "_SMALL_TABLE", 0)
    online = OnlineTable(spark, f"{folder}/t", TABLE, buckets=8)
    online.upsert(frame(spark, [(i, 1, i, "x") for i in range(100)]))
    online.compact()
    online.upsert(frame(spark, [(3, 2, 7, "y")]))
    spine = spark.createDataFrame([(3,), (4,), (None,)], "k int")
    for few in (1000, 1):  # beyond: a bitmap before the fold, the same answer
        monkeypatch.setattr(online_module, "_VALUES", few)
        rows = online.lookup(spine, ["a"], skew=None)
        assert {r.k: r.t__a for r in rows.collect()} == {3: 7, 4: 4, None: None}
        plan = rows._jdf.queryExecution().executedPlan().toString()
        if few == 1:
            assert plan.count("__tm_word") >= 2 and "LeftSemi" not in plan
        else:
            assert plan.count("In(k, [3,4])") + plan.count("In(k, [4,3])") >= 2
            assert any(f"SelectedBucketsCount: {n} out of 8" in plan for n in (1, 2))


# Row groups of some hundred rows.
FINE = {
    "parquet.block.size": "8192",
    "parquet.page.size": "2048",
    "parquet.block.size.row.check.min": "500",
    "parquet.block.size.row.check.max": "500",
    "parquet.bloom.filter.max.bytes": "16384",
}


def _large(spark, folder):
    online = OnlineTable(spark, f"{folder}/t", TABLE, buckets=4, write_options=FINE)
    ids = spark.range(200_000).select(F.col("id").cast("int").alias("k"))
    rows = ids.select("k", F.lit(minute(1)).cast("timestamp_ntz").alias("event_timestamp"), F.col("k").alias("a"), F.lit("x").alias("b"))
    online.upsert(rows)
    online.compact()
    for low in (0, 50_000, 120_000):
        newer = rows.filter(F.col("k").between(low, low + 9_999) & (F.col("k") % 2 == 0))
        online.upsert(newer.withColumns({"a": F.col("a") + 1, "event_timestamp": F.lit(minute(2)).cast("timestamp_ntz")}))
    return online


def test_five_thousand_keys_read_a_small_share_of_the_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(online_module, "_SMALL_TABLE", 0)
    online = _large(spark, folder)
    wanted = [*range(1_000, 3_500), *range(150_000, 152_499), 999_999]
    spine = spark.createDataFrame([(k,) for k in wanted], "k long")
    rows = online.lookup(spine, ["a"], skew=None)
    got = {r.k: r.t__a for r in rows.collect()}
    assert got == {k: None if k > 200_000 else k + (k < 10_000 and k % 2 == 0) for k in wanted}
    # Two of three batches hold none of these keys; of the others only the row groups around them.
    assert rows._jdf.queryExecution().executedPlan().toString().count("run=") <= 2
    assert 5_000 <= _rows_scanned(rows, True) <= 20_000
    assert _rows_scanned(rows, False) <= 3_000
    everything = online.rows()
    everything.collect()
    assert _rows_scanned(everything, True) == 200_000


def test_bloom_filters_leave_row_groups_out(spark, folder):
    """Keys between the stored ones: no bounds exclude them."""
    online = OnlineTable(spark, f"{folder}/t", TABLE)
    ids = spark.range(50_000).select((F.col("id") * 2).cast("int").alias("k"))
    online.upsert(ids.select("k", F.lit(minute(1)).cast("timestamp_ntz").alias("event_timestamp"), F.lit(1).alias("a"), F.lit("x").alias("b")))
    read = spark.read.parquet(f"{folder}/t/{online._state()['deltas'][0]['folder']}")
    for value, least, most in ((20_001, 0, 0), (20_000, 1, 50_000)):
        found = read.filter(F.col("k") == value)
        found.collect()
        assert least <= _rows_scanned(found, False) <= most


def test_commits_know_the_keys_of_their_folders(spark, folder, monkeypatch):
    monkeypatch.setattr(online_module, "_SMALL_TABLE", 0)
    table = FeatureTable("t", (Field("k", "INT32"), Field("s", "STRING"), Field("f", "DOUBLE")), (Field("a", "INT32"),))
    online = OnlineTable(spark, f"{folder}/t", table, compact_after=100)
    schema = "k int, s string, f double, event_timestamp timestamp_ntz, a int"
    online.upsert(spark.createDataFrame([(1, "a", 0.5, minute(1), 1), (9, "é", -0.0, minute(1), 2)], schema))
    online.upsert(spark.createDataFrame([(None, "b", 0.5, minute(1), 1)], schema))
    online.upsert(spark.createDataFrame([(5, "z" * 300, 0.0, minute(1), 3)], schema))
    deltas = online._state()["deltas"]
    assert [d["rows"] for d in deltas] == [2, 0, 1]
    assert [d["ranges"] for d in deltas] == [{"k": [1, 9], "s": ["a", "é"]}, {}, {"k": [5, 5]}]
    asked = [{"k": 9, "s": "é", "f": 0.0}, {"k": 5, "s": "z" * 300, "f": 0.0}, {"k": 5, "s": "a", "f": 0.5}, {"k": None, "s": "a", "f": 0.5}]
    assert [r["t__a"] for r in online.get(asked)] == [2, 3, None, None]
    spine = spark.createDataFrame([(9, "é", -0.0), (5, "z" * 300, 0.0), (2**40, "a", 0.5)], "k long, s string, f double")
    for few in (100, 1):
        monkeypatch.setattr(online_module, "_VALUES", few)
        assert {r.k: r.t__a for r in online.lookup(spine, skew=None).collect()} == {9: 2, 5: 3, 2**40: None}


def test_ranges_of_values():
    assert _ranges(set()) == [] and _ranges({1.5}) == [] and _ranges({7}) == [(7, 7)]
    found = _ranges({*range(10), *range(1_000_000, 1_000_050)})
    assert found[0][0] == 0 and found[-1][1] == 1_000_049 and len(found) <= 64
    assert not any(low < 500_000 < high for low, high in found)
    words = {f"w{i:04}" for i in range(1_000)}
    found = _ranges(words)
    assert len(found) <= 64 and all(any(low <= w <= high for low, high in found) for w in words)
