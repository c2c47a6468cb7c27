"""Declarations, projections, time helpers and sources."""

from dataclasses import replace
from datetime import UTC, date, datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import Entity, FeatureTable, Field, MissingConnectorError, SchemaError, Source, parse_refs
from tidemark.functions import codecs
from tidemark.functions.keys import joined_key, trimmed_name
from tidemark.functions.times import as_utc, normalise_time, time_literal, whole_seconds_between
from tidemark.functions.types import feature_type, feature_types, spark_type
from tidemark.operators.project import (
    effective_max_age,
    ingestion_window,
    map_columns,
    project_input,
    reverse_mapping,
)
from tidemark.sources.batch import columns_of, infer_event_timestamp, load, load_csv, read_batch
from tidemark.sources.spine import as_spine, stage_spine
from tidemark.sources.stream import broker_options, read_broker


def test_fourteen_types_round_trip():
    assert len(feature_types()) == 14
    for name in feature_types():
        assert feature_type(spark_type(name)) == name
    assert spark_type("int64_list") == T.ArrayType(T.LongType())
    for bad in (T.DateType(), T.DecimalType(10, 2), T.MapType(T.StringType(), T.StringType())):
        with pytest.raises(SchemaError):
            feature_type(bad)
    with pytest.raises(SchemaError):
        spark_type("INT128")


def test_refs_are_grouped_in_first_seen_order():
    assert parse_refs(["b:x", "a:y", "b:z", "b:x"]) == {"b": ["x", "z"], "a": ["y"]}
    for bad in ("plain", ":x", "t:"):
        with pytest.raises(SchemaError):
            parse_refs([bad])


def test_table_declarations():
    t = FeatureTable("t", (Entity("driver", "INT64", join_key="driver_id"),), (Field("a", "INT32"),), 60)
    assert t.keys == ["driver_id"] and t.max_age == timedelta(minutes=1)
    with pytest.raises(SchemaError, match="positive"):
        FeatureTable("t", t.entities, t.features, 0)
    with pytest.raises(SchemaError, match="distinct"):
        FeatureTable("t", t.entities, (Field("driver_id", "INT32"),))
    with pytest.raises(SchemaError, match="at least one entity"):
        FeatureTable("t", (), t.features)
    with pytest.raises(SchemaError, match="unknown features"):
        t.with_features(["b"])


def test_effective_max_age_uses_the_larger_value():
    def aged(max_age, **labels):
        return effective_max_age(
            FeatureTable("t", (Field("k", "INT32"),), (Field("a", "INT32"),), max_age, labels=labels)
        )

    assert aged(100, gcThresholdSec="200") == timedelta(seconds=200)
    assert aged(300, gcThresholdSec="200") == timedelta(seconds=300)
    assert aged(None, gcThresholdSec="200") == timedelta(seconds=200)
    assert aged(100, gcThresholdSec="soon") == timedelta(seconds=100)
    assert aged(None) is None


def test_ingestion_window():
    now = datetime(2024, 3, 2, 15, 4, tzinfo=UTC)
    assert ingestion_window(1, now) == (datetime(2024, 3, 2), datetime(2024, 3, 3))
    assert ingestion_window(3, now) == (datetime(2024, 2, 29), datetime(2024, 3, 3))
    with pytest.raises(ValueError):
        ingestion_window(0)


@pytest.mark.parametrize(
    "config, expected",
    [
        (
            {"file": {"format": {"json_class": "ParquetFormat"}, "path": "p", "event_timestamp_column": "ts",
                      "date_partition_column": "d", "created_timestamp_column": ""}},
            Source("parquet", "p", "ts", date_partition="d"),
        ),
        (
            {"file": {"format": "csv", "path": "p", "event_timestamp_column": "ts", "options": {"header": "true"}}},
            Source("csv", "p", "ts", options={"header": "true"}),
        ),
        (
            {"bq": {"project": "a", "dataset": "b", "table": "c", "event_timestamp_column": "ts",
                    "materialization": {"project": "x", "dataset": "y"}}},
            Source("bigquery", "a:b.c", "ts", options={"viewsEnabled": "true", "materializationProject": "x",
                                                      "materializationDataset": "y"}),
        ),
        (
            {"kafka": {"bootstrap_servers": "h:1", "topic": "t", "event_timestamp_column": "ts"}},
            Source("kafka", None, "ts", options={"kafka.bootstrap.servers": "h:1", "subscribe": "t"}),
        ),
        (
            {"jdbc": {"url": "u", "table": "t", "event_timestamp_column": "ts"}},
            Source("jdbc", None, "ts", options={"url": "u", "dbtable": "t"}),
        ),
        ({"table": {"table": "db.t", "event_timestamp_column": "ts"}}, Source("table", "db.t", "ts")),
    ],
)
def test_sources_from_config(config, expected):
    assert Source.from_dict(config) == expected


def test_bad_source_config():
    with pytest.raises(SchemaError):
        Source.from_dict({"ftp": {"event_timestamp_column": "ts"}})
    with pytest.raises(SchemaError):
        Source.from_dict({})


def test_column_map_renames_and_computes(spark):
    df = spark.createDataFrame([(1, 2)], "id int, v int")
    out = map_columns(df, {"customer_id": "id", "twice": "v * 2"})
    assert out.columns == ["customer_id", "v", "twice"]
    assert out.first() == (1, 2, 4)
    assert reverse_mapping({"customer_id": "id"}, ["customer_id", "v"]) == ["id", "v"]


def test_input_projection(spark):
    df = spark.createDataFrame([(1, 10, 0.5, datetime(2020, 1, 1))], "c int, level int, flow double, at timestamp_ntz")
    t = FeatureTable(
        "t", (Field("station", "INT32"),), (Field("plus", "INT32"), Field("flow", "DOUBLE")), tie_break=("level",)
    )
    source = Source(event_timestamp="at", field_mapping={"station": "c", "plus": "level + 1"})
    out = project_input(df, t, source)
    assert out.columns == ["plus", "flow", "station", "level", "event_timestamp"]
    assert out.first() == (11, 0.5, 1, 10, datetime(2020, 1, 1))


def test_keys_with_separators_stay_different(spark):
    df = spark.createDataFrame([("a#b", "c"), ("a", "b#c")], "x string, y string")
    plain = {r[0] for r in df.select(joined_key(["x", "y"], escape=False)).collect()}
    escaped = {r[0] for r in df.select(joined_key(["x", "y"])).collect()}
    assert plain == {"a#b#c"}
    assert len(escaped) == 2


def test_long_names_are_trimmed_and_stay_different():
    a, b = "p" * 60 + "a", "p" * 60 + "b"
    assert trimmed_name("short") == "short"
    assert len(trimmed_name(a)) == 50 and trimmed_name(a) != trimmed_name(b)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2021-03-04 05:06:07.123456", datetime(2021, 3, 4, 5, 6, 7, 123456)),
        ("2021-03-04T05:06:07Z", datetime(2021, 3, 4, 5, 6, 7)),
        ("2021-03-04 05:06:07+02:00", datetime(2021, 3, 4, 3, 6, 7)),
        ("2021-03-04 05:06:07-0330", datetime(2021, 3, 4, 8, 36, 7)),
        ("2021-03-04 05:06:07 -08", datetime(2021, 3, 4, 13, 6, 7)),
        ("2021-03-04 05:06:07 Asia/Tokyo", datetime(2021, 3, 3, 20, 6, 7)),
        ("2021-07-04 05:06:07 Europe/Berlin", datetime(2021, 7, 4, 3, 6, 7)),
        ("2021-03-04 05:06:07 UTC", datetime(2021, 3, 4, 5, 6, 7)),
        ("2021-03-04", datetime(2021, 3, 4)),
        ("soon", None),
        (None, None),
    ],
)
def test_mixed_zones(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(normalise_time("s")).first()[0] == expected


def test_time_literals_and_differences(spark):
    tokyo = datetime(2021, 1, 1, 9, tzinfo=timezone(timedelta(hours=9)))
    assert as_utc(tokyo) == datetime(2021, 1, 1)
    df = spark.range(1)
    for dtype in (T.TimestampType(), T.TimestampNTZType()):
        literal = time_literal(tokyo, dtype)
        out = df.select(literal.alias("t"), literal.cast("string").alias("s"))
        assert out.schema["t"].dataType == dtype
        assert out.first()["s"] == "2021-01-01 00:00:00"
    assert df.select(time_literal(datetime(2021, 1, 2, 3), T.DateType())).first()[0] == date(2021, 1, 2)
    a = F.lit("2021-01-01 00:00:00.9").cast("timestamp_ntz")
    b = F.lit("2021-01-01 00:00:01.1").cast("timestamp_ntz")
    assert df.select(whole_seconds_between(a, b)).first()[0] == 1


def test_event_time_inference(spark):
    df = spark.createDataFrame([], "a int, x timestamp, event_timestamp timestamp")
    assert infer_event_timestamp(df) == "event_timestamp"
    assert infer_event_timestamp(df.drop("event_timestamp")) == "x"
    with pytest.raises(SchemaError):
        infer_event_timestamp(df.select("a"))
    with pytest.raises(SchemaError):
        infer_event_timestamp(df.selectExpr("x", "x as y"))


def test_spine_forms(spark, folder):
    pdf = pd.DataFrame({"k": [1], "event_timestamp": [pd.Timestamp("2020-01-01")]})
    for form in (pdf, "select 1 as k, timestamp '2020-01-01' as event_timestamp", spark.createDataFrame(pdf)):
        assert as_spine(spark, form).columns == ["k", "event_timestamp"]
    staged = stage_spine(spark, pdf, f"{folder}/spine")
    assert staged.count() == 1
    source = Source(path=f"{folder}/spine", field_mapping={"id": "k"})
    assert as_spine(spark, source).columns == ["id", "event_timestamp"]


def test_file_sources(spark, folder):
    df = spark.createDataFrame(
        [(i, datetime(2020, 1, 1) + timedelta(hours=12 * i)) for i in range(8)], "k int, ts timestamp_ntz"
    ).withColumn("d", F.to_date("ts"))
    df.write.partitionBy("d").parquet(f"{folder}/p")
    source = Source(path=f"{folder}/p", event_timestamp="ts", date_partition="d")
    got = read_batch(spark, source, datetime(2020, 1, 2), datetime(2020, 1, 3, 12))
    assert sorted(r.k for r in got.collect()) == [2, 3, 4]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    assert "GreaterThanOrEqual(ts,2020-01-02T00:00)" in plan and "LessThan(ts,2020-01-03T12:00)" in plan
    assert columns_of(spark, source) == [("k", "int"), ("ts", "timestamp_ntz"), ("d", "date")]
    df.drop("d").write.csv(f"{folder}/c", header=True)
    csv = load(spark, Source("csv", f"{folder}/c", "ts", options={"header": "true", "inferSchema": "true"}))
    assert dict(csv.dtypes)["ts"].startswith("timestamp")
    df.createOrReplaceTempView("tm_view")
    assert load(spark, Source("table", "tm_view", "ts")).count() == 8


def test_csv_with_a_bad_row_fails(spark, folder):
    path = f"{folder}/bad.csv"
    with open(path, "w") as f:
        f.write("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        load_csv(spark, path, "a int, b int").collect()


def test_missing_connectors_say_so(spark, tmp_path):
    with pytest.raises(MissingConnectorError, match="bigquery"):
        load(spark, Source.warehouse("a", "b", "c", "ts"))
    with pytest.raises(MissingConnectorError, match="avro"):
        load(spark, Source("avro", "/tmp/none", "ts"))
    with pytest.raises(MissingConnectorError, match="kafka"):
        read_broker(spark, Source.broker("h:1", "t", "ts"))
    messages = spark.createDataFrame([(bytearray(b"x"),)], "value binary")
    with pytest.raises(MissingConnectorError, match="spark-avro"):
        codecs.decode_avro(messages, "value", '{"type":"record","name":"r","fields":[]}', "m")
    with pytest.raises(MissingConnectorError, match="spark-avro"):
        codecs.encode_avro(messages.selectExpr("struct(value) as s"), "s", "m")
    with pytest.raises(MissingConnectorError, match="spark-protobuf"):
        descriptor = tmp_path / "messages.desc"
        descriptor.write_bytes(b"")
        codecs.decode_protobuf(messages, "value", "M", str(descriptor), "m")


def test_broker_login_options():
    source = Source.broker("h:1", "t", "ts")
    assert broker_options(source)["failOnDataLoss"] == "false"
    strict = replace(source, options={**source.options, "failOnDataLoss": "true"})
    assert broker_options(strict)["failOnDataLoss"] == "true"
    options = broker_options(source, username="u", password="p")
    assert 'username="u"' in options["kafka.sasl.jaas.config"]


def test_json_decode_marks_malformed(spark):
    schema = T.StructType.fromDDL("a int, m map<string, int>, n struct<x: double>")
    df = spark.createDataFrame(
        [('{"a": 1, "m": {"k": 2}, "n": {"x": 0.5}}',), ("invalid",), ('{"a": "text"}',), ("{}",)], "v string"
    )
    out = codecs.decode_json(df, "v", schema, "r").select(
        "v", codecs.MALFORMED, "r.a", F.col("r.m")["k"].alias("k"), "r.n.x"
    )
    got = {r.v: tuple(r)[1:] for r in out.collect()}
    assert got['{"a": 1, "m": {"k": 2}, "n": {"x": 0.5}}'] == (False, 1, 2, 0.5)
    assert got["invalid"][0] and got['{"a": "text"}'][0]
    assert got["{}"] == (False, None, None, None)


def test_declared_tables_bucketed_and_plain(spark):
    from tidemark.sources.tables import append_rows, declare_table

    t = FeatureTable("t", (Field("k", "INT32"),), (Field("v", "INT64"), Field("tags", "STRING_LIST")))
    source = Source(event_timestamp="at", created_timestamp="made")
    rows = spark.range(100).selectExpr(
        "int(id) as k", "id as v", "array('x') as tags", "timestamp_ntz'2020-01-01' as at", "timestamp_ntz'2020-01-02' as made"
    )
    for name, buckets in (("tm_plain", None), ("tm_bucketed", 4)):
        declare_table(spark, name, t, source, buckets=buckets)
        assert spark.table(name).columns == ["k", "v", "tags", "at", "made"]
        for _ in range(2):
            append_rows(rows, name, t, source)
        assert spark.table(name).count() == 200
    assert len(spark.table("tm_bucketed").inputFiles()) <= 9
    plan = spark.table("tm_bucketed").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    with pytest.raises(SchemaError):
        append_rows(rows.drop("v"), "tm_plain", t, source)


def test_spark_frames_are_staged_without_the_driver(spark, folder, monkeypatch):
    frame = spark.range(5).withColumnRenamed("id", "user_id")
    monkeypatch.setattr(type(frame), "toPandas", None)
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    staged = stage_spine(spark, frame, f"{folder}/spark-spine")
    assert staged.dtypes == frame.dtypes and sorted(r["user_id"] for r in staged.collect()) == list(range(5))
