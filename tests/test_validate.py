"""Schema checks, row checks, suites."""

from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import FeatureTable, Field, SchemaError, Source, Suite, as_of_join, expect, expect_between, expect_in_set
from tidemark.operators.project import select_features
from tidemark.operators.validate import (
    FAILED,
    VALID,
    check_report,
    check_table_frame,
    frames_equal,
    observed_report,
    split_valid,
    with_validity,
)

NOW = datetime(2020, 9, 1)
TABLE = FeatureTable("t", (Field("key", "INT32"),), (Field("num", "INT32"), Field("set", "STRING")))
SUITE = Suite((expect_between("num", 0, 100), expect_in_set("set", ("a", "b", "c"))))


def rows(spark, data):
    return spark.createDataFrame(data, "key int, num int, set string, event_timestamp timestamp_ntz")


@pytest.mark.parametrize("lost", ["key", "event_timestamp"])
def test_spine_without_a_needed_column(spark, lost):
    spine = rows(spark, [(1, 1, "a", NOW)])
    feats = rows(spark, [(1, 1, "a", NOW)])
    with pytest.raises(SchemaError, match=lost):
        as_of_join(spine.drop(lost), "event_timestamp", feats, TABLE)


def test_spine_key_of_another_type(spark):
    spine = rows(spark, [(1, 1, "a", NOW)]).withColumn("key", F.col("key").cast("string"))
    with pytest.raises(SchemaError, match="declared int but is string"):
        as_of_join(spine, "event_timestamp", rows(spark, []), TABLE)


@pytest.mark.parametrize("lost", ["num", "key", "event_timestamp", "made"])
def test_source_without_a_needed_column(spark, lost):
    df = rows(spark, [(1, 1, "a", NOW)]).withColumn("made", F.col("event_timestamp"))
    source = Source(created_timestamp="made")
    select_features(df, TABLE, source)
    with pytest.raises(SchemaError, match=lost):
        select_features(df.drop(lost), TABLE, source)


def test_time_columns_must_be_timestamps(spark):
    df = rows(spark, []).withColumn("event_timestamp", F.lit("2020-01-01"))
    with pytest.raises(SchemaError, match="must be a timestamp"):
        select_features(df, TABLE, Source())


def test_double_is_cast_to_float_and_nothing_else_is(spark):
    wanted = FeatureTable("t", (Field("key", "INT32"),), (Field("x", "FLOAT"),))
    df = rows(spark, [(1, 1, "a", NOW)])
    out = select_features(df.withColumn("x", F.lit(1.5)), wanted, Source())
    assert dict(out.dtypes)["x"] == "float"
    with pytest.raises(SchemaError, match="declared float but is int"):
        select_features(df.withColumn("x", F.lit(1)), wanted, Source())


def test_declared_types_are_checked_before_ingestion(spark):
    with pytest.raises(SchemaError, match="'num' is declared int but is bigint"):
        check_table_frame(rows(spark, []).withColumn("num", F.lit(1).cast("bigint")), TABLE)


def test_reasons_and_split(spark):
    df = rows(
        spark,
        [(1, 5, "a", NOW), (None, 5, "a", NOW), (1, 500, "d", NOW), (1, None, None, NOW), (2, 1, "b", None)],
    )
    checked = with_validity(df, TABLE, SUITE, need_feature=True)
    reasons = sorted(tuple(r[FAILED]) for r in checked.filter(~F.col(VALID)).collect())
    assert reasons == [
        ("entity_null",),
        ("event_timestamp_null",),
        (SUITE.expectations[0].name, SUITE.expectations[1].name),
        ("no_feature",),
    ]
    good, bad = split_valid(checked)
    assert good.columns == df.columns
    assert (good.count(), bad.count()) == (1, 4)
    # Without the feature check, nulls pass value checks.
    assert with_validity(df, TABLE, SUITE).filter(VALID).count() == 2


def test_prefixed_columns_and_unknown_columns(spark):
    suite = Suite((expect_between("t__num", 0, 10), expect_between("gone", 0, 1)))
    df = rows(spark, [(1, 50, "a", NOW), (1, 5, "a", NOW)])
    checked = with_validity(df, TABLE, suite)
    assert checked.filter(VALID).count() == 1
    usable, skipped = suite.for_table(TABLE).usable_checks(df)
    assert list(usable) == ["expect_column_values_to_be_between(num, max_value=10, min_value=0)"]
    assert skipped == ["expect_column_values_to_be_between(gone, max_value=1, min_value=0)"]
    seen = []
    with_validity(df, TABLE, suite, skipped=seen)
    assert seen == skipped
    with pytest.raises(SchemaError, match="gone"):
        with_validity(df, TABLE, suite, strict=True)


def test_checks_of_one_column_keep_apart(spark):
    """Names hold all arguments, lists included."""
    suite = Suite((expect_in_set("set", ("a", "b")), expect_in_set("set", ("b", "c"))))
    assert len({e.name for e in suite.expectations}) == 2
    df = rows(spark, [(1, 5, "a", NOW), (2, 5, "b", NOW), (3, 5, "c", NOW)])
    assert {r.check_name: r.failed for r in check_report(df, suite).collect()} == {
        "expect_column_values_to_be_in_set(set, value_set=[a, b])": 1,
        "expect_column_values_to_be_in_set(set, value_set=[b, c])": 1,
    }
    assert [r.key for r in with_validity(df, TABLE, suite).filter(VALID).collect()] == [2]


def test_check_report(spark):
    df = rows(spark, [(1, 150, "d", NOW), (1, -1, "a", NOW), (1, None, None, NOW)])
    assert {r.check_name: r.failed for r in check_report(df, SUITE).collect()} == {
        SUITE.expectations[0].name: 2,
        SUITE.expectations[1].name: 1,
    }


@pytest.mark.parametrize(
    "check, bad_keys",
    [
        (expect("expect_column_values_to_not_be_in_set", "set", value_set=("a",)), {1}),
        (expect("expect_column_values_to_not_be_null", "set"), {3}),
        (expect("expect_column_values_to_be_null", "set"), {1, 2}),
        (expect("expect_column_values_to_match_regex", "set", regex="^a"), {2}),
        (expect("expect_column_value_lengths_to_be_between", "set", min_value=2), {1}),
        (expect("expect_column_pair_values_A_to_be_greater_than_B", None, column_A="num", column_B="key"), {2, 3}),
        (expect("expect_column_values_to_be_between", "num", min_value=2, strict_min=True), {2, 3}),
    ],
)
def test_row_rules(spark, check, bad_keys):
    df = rows(spark, [(1, 9, "a", NOW), (2, 2, "bb", NOW), (3, 1, None, NOW)])
    bad = with_validity(df, TABLE, Suite((check,))).filter(~F.col(VALID))
    assert {r.key for r in bad.collect()} == bad_keys


def test_observed_values(spark):
    df = rows(spark, [(1, 10, "a", NOW), (2, 20, "a", NOW)])
    suite = Suite(
        (
            expect("expect_column_mean_to_be_between", "num", min_value=0, max_value=10),
            expect("expect_column_proportion_of_unique_values_to_be_between", "set", min_value=0.1),
            expect("expect_column_stdev_to_be_between", "no_such", max_value=1),
        )
    )
    got = {r.check_name: (r.observed_value, r.success, r.reported_value) for r in observed_report(df, suite).collect()}
    assert got == {
        suite.expectations[0].name: (15.0, False, 1500),
        suite.expectations[1].name: (0.5, True, 0),
    }


def test_pandas_function_and_null_answers(spark):
    def small(batch: pd.DataFrame) -> pd.Series:
        answer = (batch["num"] < 10).astype("object")
        answer[batch["set"].isna()] = None
        return answer

    df = rows(spark, [(1, 5, "a", NOW), (2, 50, "a", NOW), (3, 5, None, NOW)])
    checked = with_validity(df, TABLE, Suite(function=small))
    assert {r.key: r[FAILED] for r in checked.collect()} == {1: [], 2: ["small"], 3: ["small"]}


def test_suite_from_dicts_and_unknown_kind():
    suite = Suite.from_dicts(
        [{"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "n", "min_value": 0}}]
    )
    assert suite.expectations[0].name == "expect_column_values_to_be_between(n, min_value=0)"
    with pytest.raises(SchemaError):
        expect("expect_magic", "x")


def test_frames_equal_counts_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a int, b string")
    b = spark.createDataFrame([("x", 1), ("y", 2), ("x", 1)], "b string, a int")
    assert frames_equal(a, b)
    assert not frames_equal(a, b.distinct())
    assert not frames_equal(a, b.withColumnRenamed("b", "c"))


@pytest.mark.parametrize("hot", [True, False])
def test_rules_over_other_rows(spark, monkeypatch, hot):
    """Against plain counting, with one value that holds a third of all rows."""
    from collections import Counter

    from tidemark import SkewOptions
    from tidemark.operators import validate

    if hot:
        joined = validate.salted_join
        options = SkewOptions(hot_rows=20, sample_fraction=1.0)
        monkeypatch.setattr(validate, "salted_join", lambda left, right, keys, how, skew: joined(left, right, keys, how, options))
    rows = [(i, "big" if i % 3 == 0 else ("x", "y", None)[i % 7 % 3], i % 11 if i % 5 else None, NOW) for i in range(150)]
    rows += [(0, "z", 3, NOW), (None, "z", 3, NOW), (None, None, None, NOW)]
    df = spark.createDataFrame(rows, "k long, a string, b int, event_timestamp timestamp_ntz")
    table = FeatureTable("t", (Field("k", "INT64"),), (Field("a", "STRING"), Field("b", "INT32")))
    suite = Suite(
        (
            expect("expect_column_values_to_be_unique", "k"),
            expect("expect_compound_columns_to_be_unique", column_list=("t__a", "t__b")),
            expect("expect_column_value_shares_to_be_between", "t__a", max_value=0.3),
            expect("expect_column_value_shares_to_be_between", "a", min_value=0.05, strict_min=True),
            expect("expect_column_values_to_be_unique", "missing"),
        )
    )
    skipped = []
    checked = with_validity(df, table, suite, skipped=skipped)
    assert checked.columns == [*df.columns, "_failed_checks", "_is_valid"]
    assert skipped == ["expect_column_values_to_be_unique(missing)"]
    ks, pairs, values = Counter(r[0] for r in rows), Counter(r[1:3] for r in rows), Counter(r[1] for r in rows if r[1] is not None)
    share = {v: n / sum(values.values()) for v, n in values.items()}
    expected = Counter()
    for k, a, b, _ in rows:
        failed = {"entity_null"} if k is None else set()
        if k is not None and ks[k] > 1:
            failed.add("expect_column_values_to_be_unique(k)")
        if None not in (a, b) and pairs[a, b] > 1:
            failed.add("expect_compound_columns_to_be_unique(column_list=[a, b])")
        if a is not None and share[a] > 0.3:
            failed.add("expect_column_value_shares_to_be_between(a, max_value=0.3)")
        if a is not None and share[a] <= 0.05:
            failed.add("expect_column_value_shares_to_be_between(a, min_value=0.05, strict_min=True)")
        expected[k, a, b, frozenset(failed)] += 1
    assert Counter((r.k, r.a, r.b, frozenset(r["_failed_checks"])) for r in checked.collect()) == expected
    report = {r.check_name: r.failed for r in check_report(df, suite.for_table(table)).collect()}
    assert report["expect_column_values_to_be_unique(k)"] == 2 and len(report) == 4


def test_rules_over_other_rows_need_all_rows(spark):
    stream = spark.readStream.format("rate").load()
    suite = Suite((expect("expect_column_values_to_be_unique", "value"),))
    with pytest.raises(SchemaError, match="a stream does not have"):
        suite.with_facts(stream)
