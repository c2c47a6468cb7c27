"""One query per operator of the engine, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import (
    FeatureEngine,
    FeatureInput,
    FeatureTable,
    Field,
    OnlineTable,
    SchemaError,
    SkewOptions,
    Source,
    Suite,
    as_of_join,
    compact,
    expect,
    expect_between,
    expect_in_set,
    fold_batches,
    ingest_batch,
    ingest_stream,
    key_expiry,
    latest_per_key,
    multi_as_of,
    pull_all,
    push,
)
from tidemark.functions.codecs import decode_json
from tidemark.functions.shipped import load_function, save_function
from tidemark.functions.times import event_date, micros_between, normalise_time, time_literal, whole_seconds_between
from tidemark.functions.types import feature_type, is_timestamp
from tidemark.jobs import ingest as ingest_job
from tidemark.jobs import retrieve as retrieve_job
from tidemark.model import EVENT_TS
from tidemark.operators.delivery import StagedFolder, deliver
from tidemark.operators.ingest import checked_rows
from tidemark.operators.layouts import (
    column_layout,
    kv_layout,
    read_wide,
    register_schemas,
    schema_registry_rows,
    wide_layout,
)
from tidemark.operators.metrics import QUANTILES, RANK_ERROR, lag_sketches, lag_summary, merged_lag, row_counters
from tidemark.operators.online import update_online_tables, with_expiry
from tidemark.operators.project import (
    drop_incomplete,
    flatten,
    ingestion_window,
    map_columns,
    project_input,
    reverse_mapping,
    select_features,
)
from tidemark.operators.reduce import candidate_counts, semi_reduce, sketch_reduce, spine_bounds
from tidemark.operators.sinks import (
    append_logs,
    append_to_batch_store,
    on_demand,
    save_dataset,
    times_as_seconds,
    write_dead_letters,
    write_in_batches,
    write_result,
)
from tidemark.operators.validate import (
    VALID,
    check_report,
    check_spine,
    check_table_frame,
    frames_equal,
    observed_report,
    split_valid,
    with_validity,
)
from tidemark.plans.lineage import scratch_path
from tidemark.sources.batch import columns_of, infer_event_timestamp, load_csv, read_batch
from tidemark.sources.datasets import read_dead_letters, read_logs, read_saved_dataset
from tidemark.sources.spine import stage_spine
from tidemark.sources.stream import read_files
from tidemark.sources.tables import append_rows, declare_table
from tidemark.streaming.progress import IngestMetrics, ProgressTable, progress_frame
from tidemark.streaming.state import keep_state, state_rows
from workload.tables import (
    ORDER_FEATURES,
    USER,
    VALUE,
    activity,
    anonymous_events,
    clicks,
    event_source,
    order_rows,
    orders,
    purchases,
    table,
    typed_events,
    views,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SIX_HOURS = timedelta(hours=6)
SUITE = Suite((expect_between("value", 0, 50), expect_in_set("event_type", ("click", "view", "purchase"))))


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


# --------------------------------------------------------------------- scans, projections


@query("q_scan_range")
def scan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_batch(spark, event_source(sf_dir), datetime(2024, 1, 8), datetime(2024, 1, 15))
    return rows.select("event_id", "user_id", F.col("ts").alias("event_timestamp"), "value")


@query("q_date_partition")
def date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "batch-store")
    append_to_batch_store(table(spark, sf_dir, "events"), path, "ts")
    source = Source(path=path, event_timestamp="ts", date_partition="date")
    rows = read_batch(spark, source, date(2024, 1, 8), date(2024, 1, 15))
    return rows.groupBy(F.col("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))


@query("q_scan_aware_range")
def scan_aware_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range with an offset over a date-partitioned store: partitions are UTC days."""
    path = scratch_path(spark, "batch-store")
    append_to_batch_store(table(spark, sf_dir, "events"), path, "ts")
    source = Source(path=path, event_timestamp="ts", date_partition="date")
    zone = timezone(timedelta(hours=-5))
    rows = read_batch(spark, source, datetime(2024, 1, 3, 20, tzinfo=zone), datetime(2024, 1, 14, 23, tzinfo=zone))
    return rows.select("event_id", "ts")


@query("q_window_days")
def window_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last ten UTC days, counted from a time with an offset."""
    now = datetime(2024, 1, 20, 23, 30, tzinfo=timezone(timedelta(hours=-5)))
    rows = read_batch(spark, event_source(sf_dir), *ingestion_window(10, now))
    return rows.select("event_id", "ts")


@query("q_source_config")
def source_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source from a declaration with serialised format names."""
    declared = {
        "file": {
            "format": {"json_class": "ParquetFormat"},
            "path": f"{sf_dir}/orders.parquet",
            "event_timestamp_column": "o_orderdate",
        }
    }
    rows = read_batch(spark, Source.from_dict(declared), date(1995, 1, 1), date(1996, 1, 1))
    return rows.select("o_orderkey", "o_totalprice")


@query("q_source_columns")
def source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of a source, with the values each column has."""
    source = event_source(sf_dir)
    columns = columns_of(spark, source)
    counted = table(spark, sf_dir, "events").agg(*[F.count(c).alias(c) for c, _ in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(c).alias("n")) for c, t in columns]
    return counted.select(F.inline(F.array(*pairs)))


@query("q_type_mapping")
def type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature types of the columns of two tables, and the values each column has."""
    parts = None
    for name in ("events", "embeddings"):
        df = table(spark, sf_dir, name)
        fields = [f for f in df.schema.fields if not is_timestamp(f.dataType)]
        counted = df.agg(*[F.count(f.name).alias(f.name) for f in fields])
        rows = [
            F.struct(F.lit(f.name).alias("column"), F.lit(feature_type(f.dataType)).alias("type"), F.col(f.name).alias("n"))
            for f in fields
        ]
        part = counted.select(F.inline(F.array(*rows)))
        parts = part if parts is None else parts.union(part)
    return parts


@query("q_map_columns")
def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping that renames one column and computes another; the rest stays."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return map_columns(rows, {"customer": "o_custkey", "doubled": "o_totalprice * 2"})


@query("q_reverse_mapping")
def reversed_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source columns of final names, selected under these names."""
    names = ["customer", "o_totalprice", "placed"]
    columns = reverse_mapping({"customer": "o_custkey", "placed": "o_orderdate"}, names)
    return table(spark, sf_dir, "orders").select(*[F.col(c).alias(n) for c, n in zip(columns, names)])


@query("q_offset_times")
def offset_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds with an offset against naive UTC times."""
    events, zone = table(spark, sf_dir, "events"), timezone(timedelta(hours=5, minutes=30))
    low, high = (time_literal(datetime(2024, 1, d, 2, tzinfo=zone), events.schema["ts"].dataType) for d in (10, 12))
    return events.filter((F.col("ts") >= low) & (F.col("ts") < high)).select("event_id", "ts")


@query("q_inferred_time")
def inferred_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time column of frames that do not name it."""
    parts = None
    for name in ("events", "orders"):
        df = table(spark, sf_dir, name)
        column = infer_event_timestamp(df)
        part = df.agg(F.lit(name).alias("name"), F.lit(column).alias("column"), F.max(column).alias("latest"))
        parts = part if parts is None else parts.union(part)
    return parts


@query("q_mapping_expr")
def mapping_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature_table = FeatureTable(
        "mapped",
        (Field("customer_id", "INT64"),),
        (Field("event_id", "INT64"), Field("value_plus", "DOUBLE"), Field("mix", "DOUBLE")),
    )
    mapping = {"customer_id": "user_id", "value_plus": "value + 1", "mix": "value * 2 + event_id"}
    source = event_source(sf_dir, field_mapping=mapping)
    return project_input(table(spark, sf_dir, "events"), feature_table, source)


@query("q_nested_extract")
def nested_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    decoded = decode_json(table(spark, sf_dir, "events"), "props", schema, "features")
    return flatten(decoded, "features", keep=["event_id"])


@query("q_float_cast")
def float_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature_table = FeatureTable("parts", (Field("p_partkey", "INT64"),), (Field("p_retailprice", "FLOAT"),))
    source = Source(event_timestamp="made")
    parts = table(spark, sf_dir, "part").withColumn("made", F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz"))
    return select_features(parts, feature_table, source)


@query("q_time_normalise")
def time_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    ts = F.col("ts")

    def text(at, suffix: str):
        return F.concat(at.cast("string"), F.lit(suffix))

    tokyo = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Tokyo"), ts)
    mixed = (
        F.when(F.col("event_type") == "view", text(ts, "Z"))
        .when(F.col("event_type") == "click", text(ts + timedelta(hours=2), "+02:00"))
        .when(F.col("event_type") == "purchase", text(ts - timedelta(hours=3, minutes=30), "-0330"))
        .when(F.col("event_type") == "signup", text(tokyo, " Asia/Tokyo"))
        .otherwise(text(ts, ""))
    )
    return events.select("event_id", normalise_time(mixed).alias("event_timestamp"))


@query("q_csv_load")
def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv")
    customers.write.csv(path, header=True)
    return load_csv(spark, path, customers.schema)


# ------------------------------------------------------------------------ latest and pulls


@query("q_latest_per_key")
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(
        order_rows(spark, sf_dir),
        ["o_custkey"],
        [f.name for f in ORDER_FEATURES],
        EVENT_TS,
        "created_timestamp",
        datetime(1996, 1, 1),
        datetime(1999, 12, 31),
        tie_break=["o_orderkey"],
    ).drop("created_timestamp")


@query("q_global_latest")
def global_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return latest_per_key(events, [], ["event_id", "value"], "ts", tie_break=["event_id"])


@query("q_pull_all")
def pull_all_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", EVENT_TS)
    return pull_all(
        rows, ["o_custkey", "o_totalprice"], EVENT_TS, datetime(1997, 1, 1), datetime(1997, 12, 31)
    )


# ------------------------------------------------------------------------- point in time


def _pit(spark: SparkSession, sf_dir: str, *inputs: FeatureInput, **options) -> DataFrame:
    return multi_as_of(purchases(spark, sf_dir), "ts", inputs, **options)


@query("q_pit_unlimited")
def pit_unlimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pit(spark, sf_dir, views(spark, sf_dir))


@query("q_pit_max_age")
def pit_max_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pit(spark, sf_dir, views(spark, sf_dir, SIX_HOURS))


@query("q_pit_created_ties")
def pit_created_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.lit(datetime(1998, 6, 15)).cast("timestamp_ntz").alias("at"),
    )
    item = orders(spark, sf_dir, timedelta(days=365))
    return as_of_join(spine, "at", item.df, item.table).drop("at")


@query("q_pit_composite_key")
def pit_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    shipped = FeatureTable(
        "ship",
        (Field("l_partkey", "INT64"), Field("l_suppkey", "INT64")),
        (Field("l_quantity", "DOUBLE"),),
        tie_break=("l_orderkey", "l_linenumber"),
    )
    at = F.lit(datetime(1998, 6, 1)).cast("timestamp_ntz").alias("at")
    spine = lines.select("l_partkey", "l_suppkey").distinct().select("*", at)
    features = lines.withColumnRenamed("l_shipdate", EVENT_TS)
    return as_of_join(spine, "at", features, shipped).drop("at")


@query("q_pit_duplicate_spine")
def pit_duplicate_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    twice = purchases(spark, sf_dir).unionAll(purchases(spark, sf_dir))
    item = views(spark, sf_dir)
    return as_of_join(twice, "ts", item.df, item.table).drop("user_id")


@query("q_pit_multi")
def pit_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pit(
        spark,
        sf_dir,
        views(spark, sf_dir, SIX_HOURS),
        clicks(spark, sf_dir),
        orders(spark, sf_dir, key="user_id"),
    ).drop("orders__o_orderpriority")


@query("q_pit_two_keys")
def pit_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with different keys: one pass per key set."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    features = table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", EVENT_TS)

    def last(name: str, key: str, feature: str) -> FeatureInput:
        feature_table = FeatureTable(
            name,
            (Field(key, "INT64"),),
            (Field(feature, "DOUBLE"),),
            timedelta(days=90),
            tie_break=("l_orderkey", "l_linenumber", "l_extendedprice"),
        )
        return FeatureInput(feature_table, features)

    return multi_as_of(
        lines,
        "l_shipdate",
        [last("part", "l_partkey", "l_extendedprice"), last("supp", "l_suppkey", "l_discount")],
    )


@query("q_pit_hot_keys")
def pit_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys hold everything: the hot-key slices do the work."""
    spine = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linestatus").alias("status"), "l_shipdate"
    )
    features = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias(EVENT_TS),
        "o_orderkey",
        "o_totalprice",
    )
    by_status = FeatureTable(
        "status_orders",
        (Field("status", "STRING"),),
        (Field("o_totalprice", "DOUBLE"),),
        tie_break=("o_orderkey",),
    )
    skew = SkewOptions(hot_rows=2_000, sample_fraction=0.2)
    return as_of_join(spine, "l_shipdate", features, by_status, skew=skew)


@query("q_pit_partitioned")
def pit_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views in a date-partitioned store: the spine's times choose the partitions."""
    item = views(spark, sf_dir, SIX_HOURS)
    path = scratch_path(spark, "batch-store")
    append_to_batch_store(item.df, path)
    declared = replace(item.table, source=Source(path=path, event_timestamp=EVENT_TS, date_partition="date"))
    engine = FeatureEngine(spark, [declared])
    return engine.get_historical_features(purchases(spark, sf_dir), ["views:value"], spine_ts="ts")


def _in_store(spark: SparkSession, item: FeatureInput, rows: DataFrame, path: str) -> FeatureEngine:
    """An engine over a date-partitioned store of these rows, with room for snapshots."""
    append_to_batch_store(rows, path)
    source = Source(path=path, event_timestamp=EVENT_TS, date_partition="date")
    return FeatureEngine(spark, [replace(item.table, source=source)], snapshot_root=f"{path}-snapshots")


@query("q_pit_snapshot")
def pit_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlimited age from a snapshot: history before its cut is not read."""
    item = views(spark, sf_dir)
    engine = _in_store(spark, item, item.df, scratch_path(spark, "batch-store"))
    for day in (6, 13):
        engine.snapshot(date(2024, 1, day))
    late = purchases(spark, sf_dir).filter(F.col("ts") >= F.lit(datetime(2024, 1, 15, 7)).cast("timestamp_ntz"))
    return engine.get_historical_features(late, ["views:value"], spine_ts="ts")


@query("q_pit_snapshot_late")
def pit_snapshot_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows comes after the snapshots of their times were made."""
    item = views(spark, sf_dir)
    behind = F.col("event_id") % 3 == 1
    path = scratch_path(spark, "batch-store")
    engine = _in_store(spark, item, item.df.filter(~behind), path)
    for cut in (date(2024, 1, 8), datetime(2024, 1, 14, 12)):
        engine.snapshot(cut)
    append_to_batch_store(item.df.filter(behind), path)
    engine.absorb_late("views", item.df.filter(behind))
    late = purchases(spark, sf_dir).filter(F.col("ts") >= F.lit(datetime(2024, 1, 14, 12)).cast("timestamp_ntz"))
    return engine.get_historical_features(late, ["views:value"], spine_ts="ts")


@query("q_staged_spine")
def staged_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity frame staged for other jobs, written by the executors."""
    at = F.lit(datetime(1998, 6, 1)).cast("timestamp_ntz").alias("at")
    mine = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), at)
    spine = stage_spine(spark, mine, scratch_path(spark, "spine"))
    sold = FeatureTable(
        "sold", (Field("l_suppkey", "INT64"),), (Field("l_quantity", "DOUBLE"),), tie_break=("l_orderkey", "l_linenumber")
    )
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", EVENT_TS)
    return as_of_join(spine, "at", lines, sold).drop("at")


@query("q_declared_tables")
def declared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucketed tables from declarations, filled in two appends and joined."""
    item = views(spark, sf_dir)
    name, path = f"tidemark_declared_{uuid.uuid4().hex}", scratch_path(spark, "declared")
    declare_table(spark, name, item.table, Source(), buckets=8, path=f"{path}/table")
    odd = F.col("event_id") % 2 == 1
    for part in (odd, ~odd):
        append_rows(item.df.filter(part), name, item.table, Source())
    joined = as_of_join(purchases(spark, sf_dir), "ts", spark.table(name), item.table)
    joined.write.parquet(f"{path}/result")
    spark.sql(f"drop table {name}")
    return spark.read.parquet(f"{path}/result")


@query("q_retrieve_job")
def retrieve_by_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retrieval job: a request in, the path of the result out."""
    table(spark, sf_dir, "customer").createOrReplaceTempView("tidemark_customers")
    entities = [{"name": "user_id", "type": "INT64"}]
    request = {
        "tables": [
            {
                "name": "seen",
                "entities": entities,
                "features": [{"name": "value", "type": "DOUBLE"}, {"name": "event_type", "type": "STRING"}],
                "tie_break": ["event_id"],
                "source": {
                    "file": {"format": "parquet", "path": f"{sf_dir}/events.parquet", "event_timestamp_column": "ts"}
                },
            }
        ],
        "sql": "select c_custkey as user_id, timestamp_ntz'2024-01-20 12:00:00' as at from tidemark_customers",
        "features": ["seen:event_type", "seen:value"],
        "full_feature_names": False,
        "output": {"path": scratch_path(spark, "retrieved")},
    }
    return spark.read.parquet(retrieve_job.run(spark, request)).drop("at")


@query("q_pit_bare_names")
def pit_bare_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieval through the engine: SQL spine, references, bare names."""
    table(spark, sf_dir, "events").createOrReplaceTempView("tidemark_events")
    engine = FeatureEngine(
        spark,
        [
            FeatureTable("activity", (USER,), (VALUE, Field("event_type", "STRING")),
                         timedelta(hours=1), source=Source(event_timestamp="ts")),
        ],
        frames={"activity": table(spark, sf_dir, "events").filter("event_type <> 'purchase'")},
    )
    spine = "select event_id, user_id, ts from tidemark_events where event_type = 'purchase'"
    return engine.get_historical_features(
        spine, ["activity:event_type", "activity:value"], full_feature_names=False, reduce_by_spine=True
    )


@query("q_min_distance")
def min_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = typed_events(spark, sf_dir, "view").withColumn("seen", F.col(EVENT_TS))
    feature_table = FeatureTable("views", (USER,), (Field("seen", "INT64"),))
    matched = as_of_join(purchases(spark, sf_dir), "ts", seen, feature_table)
    age = whole_seconds_between(F.col("views__seen"), F.col("ts"), naive=True)
    return matched.select("event_id", age.alias("min_distance")).filter(F.col("min_distance").isNotNull())


@query("q_on_demand")
def on_demand_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = table(spark, sf_dir, "events").filter("event_type = 'purchase'").drop("props")
    item = views(spark, sf_dir)
    matched = as_of_join(spine, "ts", item.df, item.table)
    return on_demand(matched, {"ratio": "value / nullif(views__value, 0)"}, ["event_id", "ratio"])


@query("q_training_rows")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_incomplete(_pit(spark, sf_dir, views(spark, sf_dir, SIX_HOURS)), ["views__value"])


@query("q_semi_reduce")
def semi_reduce_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = purchases(spark, sf_dir).withColumnRenamed("user_id", "o_custkey")
    return semi_reduce(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), buyers, ["o_custkey"])


@query("q_sketch_reduce")
def sketch_reduce_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of parts that a spine has, by a bitmap of its keys: rows before and after, none lost,
    and those that passed by mistake are few."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    spine = table(spark, sf_dir, "part").filter("p_size <= 10").select(F.col("p_partkey").alias("l_partkey"))
    possible = sketch_reduce(lines, spine, ["l_partkey"])
    exact = semi_reduce(possible, spine, ["l_partkey"])
    counts = ("n_before", lines), ("n_possible", possible), ("n_kept", exact)
    parts = None
    for name, df in counts:
        part = df.agg(*[(F.count(F.lit(1)) if name == n else F.lit(0).cast("long")).alias(n) for n, _ in counts])
        parts = part if parts is None else parts.union(part)
    counted = parts.agg(*[F.sum(n).alias(n) for n, _ in counts])
    few = (F.col("n_possible") - F.col("n_kept") <= 0.05 * (F.col("n_before") - F.col("n_kept"))).alias("few_others")
    return counted.select("n_before", "n_kept", few)


@query("q_spine_bounds")
def spine_time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spine_bounds(purchases(spark, sf_dir), "ts")


@query("q_range_join_candidates")
def range_join_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_counts(
        purchases(spark, sf_dir), "ts", typed_events(spark, sf_dir, "view"), EVENT_TS, ["user_id"], SIX_HOURS
    )


# --------------------------------------------------------------------------------- online


def _online(spark: SparkSession, feature_table: FeatureTable, **options) -> OnlineTable:
    return OnlineTable(spark, scratch_path(spark, "online"), feature_table, **{"buckets": 8, **options})


@query("q_compact_batch")
def compact_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature_table, events = activity(spark, sf_dir)
    keep = FeatureTable("activity", (USER,), (Field("event_id", "INT64"), VALUE), tie_break=("event_id",))
    return compact(events, keep).withColumnRenamed(EVENT_TS, "ts")


def _two_features(spark: SparkSession, sf_dir: str) -> tuple[FeatureTable, DataFrame]:
    feature_table = FeatureTable(
        "scores", (USER,), (Field("f1", "DOUBLE"), Field("f2", "DOUBLE")), tie_break=("event_id",)
    )
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS)
    kind = F.col("event_type")
    return feature_table, events.withColumns(
        {
            "f1": F.when(kind.isin("purchase", "signup"), F.col("value")),
            "f2": F.when(kind != "error", F.col("value")),
        }
    )


@query("q_online_upsert")
def online_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second batch: newer for some users, stale for others."""
    feature_table, events = _two_features(spark, sf_dir)
    first = F.col("event_type").isin("purchase", "view")
    return fold_batches([events.filter(first), events.filter(~first)], feature_table)


@query("q_online_compacted")
def online_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stored batches with a fold into the bucketed base in between."""
    feature_table, events = _two_features(spark, sf_dir)
    online = _online(spark, feature_table, compact_after=2)
    ts = F.col(EVENT_TS)
    early, late = (time_literal(datetime(2024, 1, d), T.TimestampNTZType()) for d in (10, 20))
    for batch_id, part in enumerate([ts < early, (ts >= early) & (ts < late), ts >= late]):
        online.upsert(events.filter(part), batch_id=batch_id)
    online.upsert(events, batch_id=2)  # a retry: recognised and skipped
    return online.rows().drop("expiry_timestamp")


@query("q_online_lookup")
def online_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature_table, events = activity(spark, sf_dir)
    online = _online(spark, feature_table)
    push(feature_table, online, events)
    spine = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return online.lookup(spine, ["value"])


@query("q_lookup_expired_default")
def lookup_expired_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of 2024 have expired by now; they are served only when asked for."""
    aged = FeatureTable("aged", (USER,), (VALUE,), timedelta(days=10), tie_break=("event_id",))
    online = _online(spark, aged)
    online.upsert(table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS))
    spine = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    fresh = online.lookup(spine, full_feature_names=False)
    return online.lookup(fresh, include_expired=True, key_rows=spine)


@query("q_max_age_redeclared")
def max_age_redeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is loaded again with another max age."""
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS)
    path = scratch_path(spark, "online")
    for days in (30, 2):
        declared = FeatureTable("activity", (USER,), (VALUE,), timedelta(days=days), tie_break=("event_id",))
        online = OnlineTable(spark, path, declared, buckets=8)
        online.upsert(events)
    return online.rows()


@query("q_cleanup_label")
def cleanup_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean-up label that is longer than the max age decides, also through the engine."""
    declared = FeatureTable(
        "activity", (USER,), (VALUE,), timedelta(days=1), source=Source(event_timestamp="ts"),
        labels={"gcThresholdSec": str(10 * 86_400)}, tie_break=("event_id",),
    )
    engine = FeatureEngine(
        spark, [declared], frames={"activity": table(spark, sf_dir, "events")},
        online_root=scratch_path(spark, "label"), buckets=8,
    )
    engine.materialize(datetime(2000, 1, 1), datetime(2100, 1, 1))
    return engine.online_table("activity").rows()


@query("q_online_two_writers")
def online_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers at the same time, each with the events of its own users."""
    feature_table, events = activity(spark, sf_dir)
    path = scratch_path(spark, "online")

    def write(writer: int) -> None:
        online = OnlineTable(spark, path, feature_table, buckets=8, compact_after=3)
        own = events.filter(F.col("user_id") % 2 == writer)
        early = F.col(EVENT_TS) < time_literal(datetime(2024, 1, 15), T.TimestampNTZType())
        for batch_id, part in enumerate((early, ~early)):
            online.upsert(own.filter(part), batch_id=batch_id, writer=f"writer-{writer}")

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, range(2)))
    return OnlineTable(spark, path, feature_table).rows().select("user_id", EVENT_TS, "value")


@query("q_online_teardown")
def online_teardown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two tables one is dropped; what the folder still holds."""
    feature_table, events = activity(spark, sf_dir)
    root = scratch_path(spark, "teardown")
    tables = [replace(feature_table, name=n) for n in ("gone", "kept")]
    for declared in tables:
        OnlineTable(spark, f"{root}/{declared.name}", declared, buckets=8).upsert(events)
    left = update_online_tables(spark, root, tables[:1], tables[1:])
    rows = None
    for name in left:
        own = OnlineTable(spark, f"{root}/{name}", replace(feature_table, name=name)).rows()
        own = own.select(F.lit(name).alias("name"), "user_id", "value")
        rows = own if rows is None else rows.union(own)
    return rows


@query("q_online_lookup_hot")
def online_lookup_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spine with few, very frequent keys: hot keys are salted."""
    nations = FeatureTable("nation", (Field("c_nationkey", "INT32"),), (Field("n_name", "STRING"),))
    rows = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("c_nationkey"),
        "n_name",
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias(EVENT_TS),
    )
    online = _online(spark, nations)
    online.upsert(rows)
    spine = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return online.lookup(spine, skew=SkewOptions(hot_rows=40, sample_fraction=1.0))


@query("q_online_expired")
def online_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature_table, events = activity(spark, sf_dir)
    online = _online(spark, feature_table)
    online.upsert(events)
    online.set_max_age(timedelta(days=2))
    spine = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return online.lookup(spine, ["value"], as_of=datetime(2024, 1, 31), full_feature_names=False)


@query("q_ttl_change")
def ttl_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature_table, events = activity(spark, sf_dir)
    online = _online(spark, FeatureTable("activity", (USER,), (VALUE,), 600, tie_break=("event_id",)))
    online.upsert(events)
    online.set_max_age(timedelta(days=1))
    return online.rows()


@query("q_key_expiry")
def key_expiry_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for event_type, days in (("view", 30), ("click", 60)):
        newest = latest_per_key(typed_events(spark, sf_dir, event_type), ["user_id"], [], EVENT_TS)
        parts.append(with_expiry(newest, timedelta(days=days)))
    return key_expiry(parts, ["user_id"])


@query("q_materialize")
def materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest orders of a closed range to the online table, by the engine."""
    item = orders(spark, sf_dir, timedelta(days=365))
    declared = replace(item.table, source=Source(created_timestamp="created_timestamp"))
    engine = FeatureEngine(
        spark, [declared], frames={"orders": item.df}, online_root=scratch_path(spark, "materialize"), buckets=8
    )
    engine.materialize(datetime(1990, 1, 1), datetime(2010, 1, 1))
    return engine.online_table("orders").rows().drop("o_orderpriority")


@query("q_materialize_missing")
def materialize_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping ranges and late rows: each run reads what the ones before have not."""
    item, behind = views(spark, sf_dir), F.col("event_id") % 5 == 2
    path = scratch_path(spark, "batch-store")
    append_to_batch_store(item.df.filter(~behind), path)
    source = Source(path=path, event_timestamp=EVENT_TS, date_partition="date")
    engine = FeatureEngine(spark, [replace(item.table, source=source)], online_root=scratch_path(spark, "online"))
    for start, end in ((8, 12), (5, 15), (10, 20)):
        engine.materialize_missing(date(2024, 1, start), date(2024, 1, end))
    append_to_batch_store(item.df.filter(behind), path)
    engine.ledger("views").reopen_days(item.df.filter(behind))
    engine.materialize_missing(date(2024, 1, 5), date(2024, 1, 20))
    return engine.online_table("views").rows().drop("expiry_timestamp")


@query("q_push_online")
def push_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = Source(event_timestamp="ts", field_mapping={"spend": "value * 2"})
    spend = FeatureTable("spend", (USER,), (Field("spend", "DOUBLE"),), source=source)
    online = _online(spark, spend)
    push(spend, online, table(spark, sf_dir, "events").filter("event_type = 'purchase'"))
    return online.rows().drop("expiry_timestamp")


@query("q_embedding_pit")
def embedding_pit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as features: read at one time, asked a day later."""
    vectors = FeatureTable(
        "vec", (Field("vec_id", "INT64"),), (Field("embedding", "FLOAT_LIST"), Field("label", "INT32"))
    )
    made = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    rows = table(spark, sf_dir, "embeddings").withColumn(EVENT_TS, made)
    spine = rows.select("vec_id", (made + timedelta(days=1)).alias("at"))
    found = as_of_join(spine, "at", rows, vectors, full_feature_names=False)
    return found.select(
        "vec_id", "label", F.size("embedding").cast("long").alias("dim"),
        F.element_at("embedding", 1).alias("first"), F.element_at("embedding", -1).alias("last"),
        F.array_min("embedding").alias("least"), F.array_max("embedding").alias("most"),
    )


# -------------------------------------------------------------------------------- layouts


@query("q_kv_layout")
def kv_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature_table, events = activity(spark, sf_dir)
    entries = kv_layout(compact(events, feature_table), feature_table, value_type="double", with_times=False)
    return entries.select("entity_key", "field_hash", F.col("field").alias("feature"), F.col("value").alias("feature_value"))


@query("q_kv_times")
def kv_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `_ts` and `_ex` entries of the key-value layout."""
    _, events = activity(spark, sf_dir)
    aged = FeatureTable("activity", (USER,), (VALUE,), timedelta(days=30), tie_break=("event_id",))
    entries = kv_layout(compact(events, aged), aged).filter(F.col("field").startswith("_"))
    return entries.select("entity_key", "field", "field_hash", F.col("value").cast("timestamp_ntz").alias("value"))


def _shipped(spark: SparkSession, sf_dir: str) -> tuple[FeatureTable, DataFrame]:
    shipped = FeatureTable(
        "ship",
        (Field("l_partkey", "INT64"), Field("l_suppkey", "INT64")),
        (Field("l_quantity", "DOUBLE"),),
        timedelta(days=10),
        tie_break=("l_orderkey", "l_linenumber"),
    )
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", EVENT_TS)
    return shipped, compact(lines, shipped)


@query("q_wide_layout_key")
def wide_layout_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns; the value's bytes begin with the reference of its schema."""
    shipped, newest = _shipped(spark, sf_dir)
    wide = wide_layout(newest, shipped)
    return wide.select(F.col("key").alias("row_key"), "ts", "schema_ref", F.hex("value").alias("value"))


@query("q_wide_read_back")
def wide_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the wide layout, back in their columns."""
    shipped, newest = _shipped(spark, sf_dir)
    schema = T.StructType([T.StructField("l_quantity", T.DoubleType())])
    return read_wide(wide_layout(newest, shipped), schema).withColumnRenamed("key", "row_key")


@query("q_wide_empty_keys")
def wide_empty_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key is an empty text are left out."""
    kinds = FeatureTable("kinds", (Field("kind", "STRING"),), (VALUE,), tie_break=("event_id",))
    kind = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type"))
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS).withColumn("kind", kind)
    return wide_layout(compact(events, kinds), kinds).select("key", "ts")


@query("q_column_layout_rows")
def column_layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped, newest = _shipped(spark, sf_dir)
    return column_layout(newest, shipped).withColumn("ttl", F.col("ttl").cast("long"))


@query("q_schema_registry")
def schema_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas of two tables registered twice; the rows stored under each reference."""
    shipped, lines = _shipped(spark, sf_dir)
    feature_table, events = activity(spark, sf_dir)
    newest = compact(events, feature_table)
    path = scratch_path(spark, "registry")
    for _ in range(2):
        register_schemas(spark, path, schema_registry_rows(lines, [shipped]))
        registry = register_schemas(spark, path, schema_registry_rows(newest, [feature_table]))
    stored = wide_layout(lines, shipped).select("schema_ref").union(wide_layout(newest, feature_table).select("schema_ref"))
    counted = stored.groupBy("schema_ref").agg(F.count(F.lit(1)).alias("n"))
    return registry.join(counted, "schema_ref")


# ----------------------------------------------------------------------------- validation

EVENT_CHECKS = FeatureTable(
    "events", (USER,), (Field("event_id", "INT64"), VALUE, Field("event_type", "STRING"))
)


def _checked(spark: SparkSession, sf_dir: str, suite: Suite | None = None) -> DataFrame:
    return checked_rows(anonymous_events(spark, sf_dir), EVENT_CHECKS, Source(event_timestamp="ts"), suite)


@query("q_row_validity")
def row_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _checked(spark, sf_dir)
    return checked.groupBy(F.col(VALID).alias("is_valid")).agg(F.count(F.lit(1)).alias("n"))


@query("q_deadletter")
def deadletter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dead-letters")
    write_dead_letters(split_valid(_checked(spark, sf_dir))[1], path, "run-1")
    rejected = read_dead_letters(spark, path, "run-1")
    return rejected.select("event_id", F.explode("_failed_checks").alias("reason"))


@query("q_expectations")
def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS)
    checked = with_validity(events, EVENT_CHECKS, SUITE)
    return checked.select("event_id", F.col(VALID).alias("is_valid"))


@query("q_check_counts")
def check_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_report(table(spark, sf_dir, "events"), SUITE)


@query("q_rules_over_rows")
def rules_over_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break rules about other rows: repeated values, repeated pairs, too common values."""
    suite = Suite(
        (
            expect("expect_column_values_to_be_unique", "event_id"),
            expect("expect_compound_columns_to_be_unique", column_list=("user_id", "event_type")),
            expect("expect_column_value_shares_to_be_between", "event_type", max_value=0.2),
        )
    )
    return check_report(anonymous_events(spark, sf_dir), suite)


@query("q_observed_checks")
def observed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = Suite(
        (
            expect("expect_column_unique_value_count_to_be_between", "user_id", min_value=1),
            expect("expect_column_min_to_be_between", "value", min_value=1_000),
            expect("expect_column_max_to_be_between", "value", max_value=100),
            expect("expect_table_row_count_to_be_between", min_value=1),
            expect("expect_column_max_to_be_between", "no_such_column", max_value=1),
        )
    )
    return observed_report(table(spark, sf_dir, "events"), suite)


@query("q_two_sets_one_column")
def two_sets_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two checks of one column that differ in their lists only."""
    suite = Suite((expect_in_set("event_type", ("click", "view")), expect_in_set("event_type", ("view", "signup"))))
    return check_report(table(spark, sf_dir, "events"), suite)


@query("q_prefix_strip")
def prefix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks that name columns as retrieval does, on the table's own rows."""
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS)
    checked = with_validity(events, EVENT_CHECKS, Suite((expect_between("events__value", 0, 50),)))
    return checked.groupBy(F.col(VALID).alias("is_valid")).agg(F.count(F.lit(1)).alias("n"))


@query("q_any_feature")
def any_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with and without any feature."""
    _, events = activity(spark, sf_dir)
    bought = FeatureTable("bought", (USER,), (Field("pv", "DOUBLE"),))
    checked = with_validity(events, bought, need_feature=True)
    reason = F.concat_ws(",", "_failed_checks").alias("reason")
    return checked.groupBy(F.col(VALID).alias("is_valid"), reason).agg(F.count(F.lit(1)).alias("n"))


@query("q_declared_types")
def declared_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that do and do not have what tables declare, with the rows that would be used."""
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS)
    cases = {
        "declared": lambda: check_table_frame(events, EVENT_CHECKS),
        "other type": lambda: check_table_frame(events.withColumn("value", F.col("value").cast("int")), EVENT_CHECKS),
        "no column": lambda: check_table_frame(events.drop("event_type"), EVENT_CHECKS),
        "no time": lambda: check_table_frame(events.withColumn(EVENT_TS, F.lit("x")), EVENT_CHECKS),
        "spine": lambda: check_spine(events, EVENT_TS, EVENT_CHECKS),
        "spine without key": lambda: check_spine(events.drop("user_id"), EVENT_TS, EVENT_CHECKS),
    }
    parts = None
    for name, check in cases.items():
        try:
            check()
            usable = events
        except SchemaError:
            usable = events.limit(0)
        part = usable.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        parts = part if parts is None else parts.union(part)
    return parts


@query("q_frames_equal")
def equal_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows in another order and column order; and all rows twice."""
    events = table(spark, sf_dir, "events")
    turned = events.select(*reversed(events.columns)).orderBy(F.desc("event_id"))
    answers = [("same", frames_equal(events, turned)), ("twice", frames_equal(events, events.union(events)))]
    return spark.createDataFrame(answers, "name string, equal boolean")


@query("q_stored_function")
def stored_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A validation function that was stored as a file."""
    limit = 50

    def affordable(rows: pd.DataFrame) -> pd.Series:
        return rows["value"] <= limit

    path = f"{scratch_path(spark, 'functions')}/affordable.pickle"
    save_function(spark, affordable, path)
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS).drop("props")
    checked = with_validity(events, EVENT_CHECKS, Suite(function=load_function(spark, path)))
    return checked.groupBy(F.col(VALID).alias("is_valid")).agg(F.count(F.lit(1)).alias("n"))


@query("q_suite_function")
def suite_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity by a user's pandas function, Arrow batches."""

    def looks_right(rows: pd.DataFrame) -> pd.Series:
        return rows["value"].between(0, 50) & rows["event_type"].isin(["click", "view", "purchase"])

    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS).drop("props")
    checked = with_validity(events, EVENT_CHECKS, Suite(function=looks_right))
    return checked.groupBy("event_type", F.col(VALID).alias("is_valid")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------- ingestion, streams


@query("q_ingest_online")
def ingest_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated batch load: what reaches the online table."""
    online = _online(spark, EVENT_CHECKS)
    ingest_batch(
        spark,
        EVENT_CHECKS,
        online,
        datetime(2024, 1, 3),
        datetime(2024, 1, 29),
        source=Source(event_timestamp="ts"),
        df=anonymous_events(spark, sf_dir),
        suite=SUITE,
    )
    return online.rows().drop("expiry_timestamp")


@query("q_ingest_flagged")
def ingest_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and dead letters when rows failing the suite are kept as well."""
    online = _online(spark, EVENT_CHECKS)
    path = scratch_path(spark, "dead-letters")
    report = ingest_batch(
        spark,
        EVENT_CHECKS,
        online,
        source=Source(event_timestamp="ts"),
        df=anonymous_events(spark, sf_dir),
        suite=SUITE,
        dead_letters=path,
        on_invalid="flag",
        run_id="flagged",
    )
    rejected = read_dead_letters(spark, path, report.run_id)
    reasons = rejected.select(F.explode("_failed_checks").alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("q_ingest_job")
def ingest_by_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingestion job: a configuration in, the online table filled."""
    online = scratch_path(spark, "online")
    ingest_job.run(
        spark,
        {
            "mode": "offline",
            "table": {
                "name": "events",
                "entities": [{"name": "user_id", "type": "INT64"}],
                "features": [{"name": "event_id", "type": "INT64"}, {"name": "value", "type": "DOUBLE"}],
                "source": {
                    "file": {"format": "parquet", "path": f"{sf_dir}/events.parquet", "event_timestamp_column": "ts"}
                },
            },
            "online": {"path": online, "buckets": 8},
            "start": "2024-01-03T00:00:00",
            "end": "2024-01-29T00:00:00",
            "suite": [
                {
                    "expectation_type": "expect_column_values_to_be_between",
                    "kwargs": {"column": "value", "min_value": 0, "max_value": 50},
                }
            ],
        },
    )
    stored = replace(EVENT_CHECKS, features=(Field("event_id", "INT64"), VALUE))
    return OnlineTable(spark, online, stored).rows().drop("expiry_timestamp")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob pattern, so that the table may be one file or a folder of files.
    path = f"{sf_dir}/events.parque[t]"
    return read_files(spark, path, table(spark, sf_dir, "events").schema)


@query("q_stream_state")
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = FeatureTable("latest", (USER,), (Field("event_id", "INT64"), VALUE))
    online = _online(spark, latest)
    _streamed(spark, sf_dir, latest, online)
    return online.rows().drop("expiry_timestamp")


# Files of a part of the events.
ARRIVING_FILES = 8


def _keyed(spark: SparkSession, sf_dir: str, feature_table: FeatureTable, events: DataFrame) -> str:
    """The checkpoint of a query that has kept the state of these events, arriving in three parts."""
    arrivals, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "keyed-state")
    events.repartition(3 * ARRIVING_FILES, "event_id").write.parquet(arrivals)
    files = len(spark.read.schema(events.schema).parquet(arrivals).inputFiles())
    stream = read_files(spark, arrivals, events.schema, files_per_trigger=-(-files // 3))
    run = keep_state(stream, feature_table, checkpoint=checkpoint, trigger={"availableNow": True}, partitions=4)
    run.awaitTermination()
    return checkpoint


@query("q_keyed_state")
def keyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest values per key as keyed stream state, rows out of order."""
    latest = FeatureTable("latest", (USER,), (Field("event_id", "INT64"), VALUE))
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS)
    return state_rows(spark, _keyed(spark, sf_dir, latest, events), latest).drop("expiry_timestamp")


@query("q_keyed_expired")
def keyed_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of keys leaves with its max age, by the clock of the events."""
    feature_table, events = activity(spark, sf_dir)
    aged = replace(feature_table, max_age=timedelta(days=2))
    spine = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    current = state_rows(spark, _keyed(spark, sf_dir, aged, events), aged, as_of=datetime(2024, 1, 31))
    return spine.join(current.select("user_id", "value"), "user_id", "left")


def _streamed(spark: SparkSession, sf_dir: str, feature_table: FeatureTable, online: OnlineTable, **options):
    run = ingest_stream(
        _event_stream(spark, sf_dir),
        feature_table,
        online,
        source=Source(event_timestamp="ts"),
        checkpoint=scratch_path(spark, "stream"),
        trigger={"availableNow": True},
        **options,
    )
    run.awaitTermination()
    return run


@query("q_latest_message")
def latest_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a stream and the time of its last message."""
    latest = FeatureTable("latest", (USER,), (VALUE,))
    metrics = IngestMetrics()
    _streamed(spark, sf_dir, latest, _online(spark, latest), message_time="ts", metrics=metrics)
    return metrics.frame(spark).agg(
        F.sum("n_read").alias("n_read"), F.sum("n_stored").alias("n_stored"),
        F.max("latest_message").cast("timestamp_ntz").alias("latest_message"),
    )


@query("q_stream_progress")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = FeatureTable("latest", (USER,), (VALUE,))
    run = _streamed(spark, sf_dir, latest, _online(spark, latest))
    return progress_frame(spark, run).agg(F.sum("input_rows").alias("n"))


@query("q_stream_deadletter")
def stream_deadletter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages, some of them no JSON at all; two runs into one folder, read back by run."""
    counts = FeatureTable("counts", (USER,), (Field("k", "INT64"),), source=Source(event_timestamp="ts"))
    broken = F.when(F.col("event_type") == "error", F.lit("invalid")).otherwise(F.col("props"))
    messages = _event_stream(spark, sf_dir).select("user_id", "ts", broken.alias("message"))
    path = scratch_path(spark, "dead-letters")
    for _ in range(2):
        run = ingest_stream(
            messages,
            counts,
            _online(spark, counts),
            message={"format": "json", "column": "message", "schema": T.StructType([T.StructField("k", T.LongType())])},
            checkpoint=scratch_path(spark, "stream"),
            dead_letters=path,
            trigger={"availableNow": True},
        )
        run.awaitTermination()
    rejected = read_dead_letters(spark, path)
    runs = rejected.select("run_id").distinct().withColumn("run", F.rank().over(Window.orderBy("run_id")))
    reason = F.concat_ws(",", "_failed_checks").alias("reason")
    return rejected.join(runs, "run_id").select("run", "user_id", EVENT_TS, reason)


# ----------------------------------------------------------------- metrics, sinks, datasets


@query("q_lag_summary")
def lag_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and spread in whole seconds, where sums of floats agree."""
    summary = lag_summary(table(spark, sf_dir, "events"), datetime(2024, 2, 1), ["event_type"], "ts")
    seconds = [F.round(F.col(f"{c}_lag_us") / 1e6).cast("long").alias(f"{c}_lag_s") for c in ("mean", "stddev")]
    return summary.select("event_type", "n", "min_lag_us", "max_lag_us", "p50_lag_us", "p95_lag_us", "p99_lag_us", *seconds)


@query("q_lag_sketches")
def lag_by_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag over many stored batches from their sketches: counts and bounds exactly, quantiles
    within the stated error of their rank."""
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", EVENT_TS)
    now, path = datetime(2024, 2, 15), scratch_path(spark, "lag")
    batch = F.to_date(EVENT_TS)
    lag_sketches(events.withColumn("batch", batch), now, ["event_type", "batch"]).write.parquet(path)
    merged = merged_lag(spark.read.parquet(path), ["event_type"])
    lag = micros_between(F.col(EVENT_TS), time_literal(now, events.schema[EVENT_TS].dataType))
    marks = [(q, f"p{round(q * 100)}_lag_us") for q in QUANTILES]
    ranked = events.select("event_type", lag.alias("lag")).join(F.broadcast(merged), "event_type")

    def near(q: float, name: str):
        """The share of lags below the value, and of those up to it, lie around q."""
        below, upto = F.avg((F.col("lag") < F.col(name)).cast("double")), F.avg((F.col("lag") <= F.col(name)).cast("double"))
        return ((below <= q + RANK_ERROR) & (upto >= q - RANK_ERROR)).alias(f"p{round(q * 100)}_near")

    return ranked.groupBy("event_type", "n", "min_lag_us", "max_lag_us").agg(*[near(q, name) for q, name in marks])


@query("q_stream_totals")
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a stream in a table, over a restart and with more files than one batch takes."""
    latest = FeatureTable("latest", (USER,), (VALUE,))
    events, arrivals = table(spark, sf_dir, "events"), scratch_path(spark, "arrivals")
    online, progress = _online(spark, latest), ProgressTable(spark, scratch_path(spark, "progress"), fold_after=2)
    checkpoint = scratch_path(spark, "stream")
    for part in range(2):
        days = (F.dayofmonth("ts") - 1) % 2 == part
        events.filter(days).repartition(4).write.mode("append").parquet(arrivals)
        run = ingest_stream(
            read_files(spark, arrivals, events.schema, files_per_trigger=2), latest, online,
            source=Source(event_timestamp="ts"), checkpoint=checkpoint, trigger={"availableNow": True},
            message_time="ts", progress=ProgressTable(spark, progress.path, fold_after=2),
        )
        run.awaitTermination()
    lag = merged_lag(progress.batches()).select(F.col("n").alias("n_timed"))
    totals = progress.totals().select("n_read", "n_stored", "n_deadletter", "latest_message")
    return totals.join(lag, F.col("n_timed") == F.col("n_read"))


@query("q_row_counters")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counters(_checked(spark, sf_dir))


@query("q_saved_dataset")
def saved_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dataset")
    save_dataset(_pit(spark, sf_dir, views(spark, sf_dir), clicks(spark, sf_dir)), path)
    return read_saved_dataset(
        spark,
        path,
        ["views:value"],
        ["event_id", "user_id"],
        event_ts="ts",
        start=datetime(2024, 1, 5),
        end=datetime(2024, 1, 25),
    )


@query("q_feature_logs")
def feature_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "logs")
    served = table(spark, sf_dir, "events").withColumnRenamed("ts", "log_timestamp")
    append_logs(served, path)
    return read_logs(
        spark, path, ["event_id", "value"], start=datetime(2024, 1, 5, 12), end=datetime(2024, 1, 25, 12)
    )


@query("q_logs_aware_range")
def logs_aware_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of a range with an offset: log dates are UTC days."""
    path = scratch_path(spark, "logs")
    append_logs(table(spark, sf_dir, "events").withColumnRenamed("ts", "log_timestamp"), path)
    zone = timezone(timedelta(hours=-5))
    start, end = datetime(2024, 1, 5, 21, tzinfo=zone), datetime(2024, 1, 24, 22, tzinfo=zone)
    return read_logs(spark, path, ["event_id"], start=start, end=end)


@query("q_batched_write")
def batched_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows handed to a client in groups of at most 500, on the executors."""
    ids, groups = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def send(rows: list) -> None:
        ids.add(sum(r["event_id"] for r in rows))
        groups.add(int(len(rows) > 500))

    n = write_in_batches(table(spark, sf_dir, "events").select("event_id"), send, 500)
    return spark.createDataFrame([(n, ids.value, groups.value)], "n long, ids long, too_large long")


@query("q_delivered_rows")
def delivered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to a store by committed delivery: a failed job leaves nothing, a repeated one nothing more."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    store = StagedFolder(spark, scratch_path(spark, "store"), customers.schema)
    broken = customers.withColumn("c_acctbal", F.when(F.col("c_custkey") % 50 == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("c_acctbal")))
    try:
        deliver(broken, store, job="daily", batch_rows=10)
    except Exception as error:
        if "lost" not in str(error):
            raise
    for _ in range(2):
        deliver(customers, store, job="daily", batch_rows=500)
    return store.rows()


@query("q_record_file")
def record_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    write_result(times_as_seconds(table(spark, sf_dir, "orders"), "o_orderdate"), path)
    return spark.read.parquet(path).select("o_orderkey", "o_orderdate", "o_totalprice")


@query("q_daily_counts")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(event_date("ts").alias("d"), "event_type").agg(F.count(F.lit(1)).alias("n"))
