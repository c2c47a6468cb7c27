"""The engine: declared feature tables, and the questions asked of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import SchemaError
from tidemark.model import CREATED_TS, EVENT_TS, FeatureTable, Source, output_name, parse_refs
from tidemark.operators.asof import FeatureInput, multi_as_of
from tidemark.operators.ingest import IngestReport, ingest_batch, materialize, push
from tidemark.operators.ledger import Interval, IntervalLedger, materialize_missing
from tidemark.operators.online import OnlineTable, update_online_tables
from tidemark.operators.project import ingestion_window, select_features
from tidemark.operators.sinks import on_demand, save_dataset
from tidemark.operators.snapshots import SnapshotStore
from tidemark.plans.skew import SkewOptions
from tidemark.sources.batch import infer_event_timestamp, load
from tidemark.sources.spine import as_spine


_DAY = "__tm_day"


class FeatureEngine:
    """Feature tables of a project over their sources and online tables."""

    def __init__(
        self,
        spark: SparkSession,
        tables: Sequence[FeatureTable],
        *,
        frames: Mapping[str, DataFrame] | None = None,
        online_root: str | None = None,
        snapshot_root: str | None = None,
        buckets: int = 32,
        skew: SkewOptions | None = SkewOptions(),
    ) -> None:
        """`frames` gives source rows for tables whose source is already a DataFrame.
        Snapshots below `snapshot_root` spare point-in-time joins the history before them."""
        self.spark = spark
        self.tables = {t.name: t for t in tables}
        self.frames = dict(frames or {})
        self.online_root = online_root
        self.snapshot_root = snapshot_root
        self.buckets = buckets
        self.skew = skew

    def table(self, name: str) -> FeatureTable:
        if name not in self.tables:
            raise SchemaError(f"unknown feature table {name!r}, have {sorted(self.tables)}")
        return self.tables[name]

    def source_rows(self, table: FeatureTable) -> DataFrame:
        if table.name in self.frames:
            return self.frames[table.name]
        if table.source is None:
            raise SchemaError(f"{table.name}: no source declared")
        return load(self.spark, table.source)

    # ---------------------------------------------------------------- retrieval

    def get_historical_features(
        self,
        spine: DataFrame | pd.DataFrame | str | Source,
        refs: Sequence[str],
        *,
        spine_ts: str | None = None,
        full_feature_names: bool = True,
        on_demand_features: Mapping[str, str] | None = None,
        reduce_by_spine: bool | None = None,
        checkpoint_every: int | None = None,
    ) -> DataFrame:
        """Features as they were at each spine row's time, as one lazy frame.

        The spine is evaluated once, now; its times choose the date partitions and row groups
        that are read. `reduce_by_spine` drops feature rows of keys that the spine does not
        have before the join; by default that is done where its keys fit into a broadcast.
        """
        if isinstance(spine, Source):
            spine_ts = spine_ts or spine.event_timestamp
        spine = as_spine(self.spark, spine)
        spine_ts = spine_ts or infer_event_timestamp(spine)
        inputs = []
        for name, features in parse_refs(refs).items():
            table = self.table(name).with_features(features)
            created = CREATED_TS if table.source and table.source.created_timestamp else None
            stored = self.snapshots(name) if self.snapshot_root else None
            rows, day = self._feature_rows(table)
            inputs.append(FeatureInput(table, rows, EVENT_TS, created, day, stored))
        result = multi_as_of(
            spine,
            spine_ts,
            inputs,
            full_feature_names=full_feature_names,
            skew=self.skew,
            reduce_by_spine=reduce_by_spine,
            checkpoint_every=checkpoint_every,
        )
        return on_demand(result, dict(on_demand_features)) if on_demand_features else result

    def _feature_rows(self, table: FeatureTable) -> tuple[DataFrame, str | None]:
        """Canonical source rows, and the column with their UTC date if the source is partitioned by it."""
        source = table.source or Source()
        day = {_DAY: source.date_partition} if source.date_partition else {}
        return select_features(self.source_rows(table), table, source, keep=day), _DAY if day else None

    def snapshots(self, name: str) -> SnapshotStore:
        """The stored snapshots of a table's newest rows."""
        if self.snapshot_root is None:
            raise SchemaError("the engine has no snapshot_root")
        table = self.table(name)
        source = table.source or Source()
        origin = {
            "frame": name in self.frames,
            "format": source.format,
            "path": source.path,
            "event": source.event_timestamp,
            "created": source.created_timestamp,
            "mapping": dict(source.field_mapping),
            "options": dict(source.options),
        }
        path = f"{self.snapshot_root}/{table.name}"
        return SnapshotStore(self.spark, path, table, created=bool(source.created_timestamp), origin=origin)

    def snapshot(self, cut: date | datetime, names: Sequence[str] | None = None) -> None:
        """Store the newest rows per key before `cut` (the end of that day for a date) of all (or
        some) tables. Requests for times from there on then read the history only from there."""
        for name in names or list(self.tables):
            rows, day = self._feature_rows(self.table(name))
            self.snapshots(name).build(rows, cut, day=day)

    def absorb_late(self, name: str, df: DataFrame) -> int:
        """Merge source rows that came after snapshots of their times into these snapshots."""
        table = self.table(name)
        return self.snapshots(name).absorb(select_features(df, table, table.source or Source()))

    def save_dataset(self, result: DataFrame, path: str) -> None:
        save_dataset(result, path)

    # ------------------------------------------------------------------- online

    def online_table(self, name: str, event_ts_type=None) -> OnlineTable:
        if self.online_root is None:
            raise SchemaError("the engine has no online_root")
        table = self.table(name)
        return OnlineTable(
            self.spark,
            f"{self.online_root}/{table.name}",
            table,
            buckets=self.buckets,
            event_ts_type=event_ts_type,
        )

    def materialize(
        self, start: datetime, end: datetime, names: Sequence[str] | None = None
    ) -> None:
        """Newest rows of a closed time range to the online tables of all (or some) tables."""
        for name in names or list(self.tables):
            table = self.table(name)
            materialize(
                self.spark, table, self.online_table(name), start, end, df=self.source_rows(table)
            )

    def ledger(self, name: str) -> IntervalLedger:
        """The times from which a table's online values were filled by `materialize_missing`."""
        return IntervalLedger(self.spark, self.online_table(name).path)

    def materialize_missing(
        self, start: date | datetime, end: date | datetime, names: Sequence[str] | None = None
    ) -> dict[str, list[Interval]]:
        """Like `materialize` for `[start, end)`, but reads only what earlier runs have not covered.
        Returns what was read of each table."""
        read = {}
        for name in names or list(self.tables):
            table, online = self.table(name), self.online_table(name)
            read[name] = materialize_missing(self.spark, table, online, start, end, self.ledger(name), df=self.source_rows(table))
        return read

    def push(self, name: str, df: DataFrame | pd.DataFrame) -> None:
        if not isinstance(df, DataFrame):
            df = self.spark.createDataFrame(df)
        push(self.table(name), self.online_table(name), df)

    def ingest(
        self, name: str, start: datetime | None = None, end: datetime | None = None, **options
    ) -> IngestReport:
        """Validated load of a time range of one table; see `ingest_batch`."""
        table = self.table(name)
        if "days" in options:
            start, end = ingestion_window(options.pop("days"))
        return ingest_batch(
            self.spark, table, self.online_table(name), start, end, df=self.source_rows(table), **options
        )

    def get_online_features(
        self,
        rows: DataFrame | Sequence[Mapping],
        refs: Sequence[str],
        *,
        as_of: datetime | None = None,
        include_expired: bool = False,
        full_feature_names: bool = True,
    ) -> DataFrame | list[dict]:
        """Current values: a frame for a frame, a list in input order for a list. Values that
        have expired by `as_of` (now by default) are null unless `include_expired`."""
        grouped = parse_refs(refs)
        if isinstance(rows, DataFrame):
            result = rows
            for name, features in grouped.items():
                result = self.online_table(name).lookup(
                    result,
                    features,
                    as_of=as_of,
                    include_expired=include_expired,
                    full_feature_names=full_feature_names,
                    skew=self.skew,
                    key_rows=rows,
                )
            return result
        answers = [dict(r) for r in rows]
        for name, features in grouped.items():
            found = self.online_table(name).get(
                answers,
                features,
                as_of=as_of,
                include_expired=include_expired,
                full_feature_names=full_feature_names,
            )
            wanted = [output_name(name, f, full_feature_names) for f in features]
            for answer, values in zip(answers, found):
                answer.update({w: values[w] for w in wanted})
        return answers

    def update_online(self, delete: Sequence[str] = ()) -> list[str]:
        """Drop the online tables named in `delete`; keep all others."""
        gone = [self.table(n) for n in delete]
        keep = [t for t in self.tables.values() if t.name not in set(delete)]
        return update_online_tables(self.spark, self.online_root, gone, keep)

    def describe(self) -> DataFrame:
        """Declared tables: one row per feature."""
        rows = [
            (t.project, t.name, ",".join(t.keys), f.name, f.dtype.upper())
            for t in self.tables.values()
            for f in t.features
        ]
        return self.spark.createDataFrame(
            rows, "project string, feature_table string, entities string, feature string, type string"
        ).orderBy(F.col("feature_table"), F.col("feature"))
