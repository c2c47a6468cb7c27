"""The given tables in their feature roles."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import FeatureInput, FeatureTable, Field, Source

USER = Field("user_id", "INT64")
VALUE = Field("value", "DOUBLE")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_source(sf_dir: str, **changes) -> Source:
    return Source(path=f"{sf_dir}/events.parquet", event_timestamp="ts", **changes)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usual spine: who bought when."""
    events = table(spark, sf_dir, "events")
    return events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")


def typed_events(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.filter(F.col("event_type") == event_type).withColumnRenamed("ts", "event_timestamp")


def views(spark: SparkSession, sf_dir: str, max_age: timedelta | None = None) -> FeatureInput:
    return FeatureInput(
        FeatureTable("views", (USER,), (VALUE,), max_age), typed_events(spark, sf_dir, "view")
    )


def clicks(spark: SparkSession, sf_dir: str) -> FeatureInput:
    return FeatureInput(FeatureTable("clicks", (USER,), (VALUE,)), typed_events(spark, sf_dir, "click"))


ORDER_FEATURES = (Field("o_totalprice", "DOUBLE"), Field("o_orderpriority", "STRING"))


def order_rows(spark: SparkSession, sf_dir: str, key: str = "o_custkey") -> DataFrame:
    """Orders with a creation time, which the table lacks: some days after the order date."""
    created = F.col("o_orderdate") + F.make_dt_interval(F.col("o_orderkey") % 5)
    orders = table(spark, sf_dir, "orders").withColumn("created_timestamp", created)
    orders = orders.withColumnRenamed("o_orderdate", "event_timestamp")
    return orders if key == "o_custkey" else orders.withColumnRenamed("o_custkey", key)


def orders(
    spark: SparkSession, sf_dir: str, max_age: timedelta | None = None, key: str = "o_custkey"
) -> FeatureInput:
    feature_table = FeatureTable(
        "orders", (Field(key, "INT64"),), ORDER_FEATURES, max_age, tie_break=("o_orderkey",)
    )
    return FeatureInput(feature_table, order_rows(spark, sf_dir, key))


def activity(spark: SparkSession, sf_dir: str) -> tuple[FeatureTable, DataFrame]:
    """All events as one feature table: value, and the value of purchases only."""
    feature_table = FeatureTable(
        "activity", (USER,), (VALUE, Field("pv", "DOUBLE")), tie_break=("event_id",)
    )
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "event_timestamp")
    events = events.withColumn("pv", F.when(F.col("event_type") == "purchase", F.col("value")))
    return feature_table, events


def anonymous_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a source with bad rows: errors carry no user."""
    events = table(spark, sf_dir, "events")
    return events.withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id")))
