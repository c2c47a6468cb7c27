"""Declarations: fields, sources, feature tables and feature references."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta

from pyspark.sql import types as T

from tidemark.errors import SchemaError
from tidemark.functions.types import spark_type

EVENT_TS = "event_timestamp"
CREATED_TS = "created_timestamp"

# Serialised file format names and the Spark formats they mean.
FORMAT_NAMES = {"ParquetFormat": "parquet", "AvroFormat": "avro", "CSVFormat": "csv"}


@dataclass(frozen=True)
class Field:
    """A named, typed column: an entity key or a feature."""

    name: str
    dtype: str

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.dtype)


@dataclass(frozen=True)
class Entity:
    """A key concept; `join_key` is the column that holds it (default: its name)."""

    name: str
    dtype: str
    join_key: str | None = None

    def as_field(self) -> Field:
        return Field(self.join_key or self.name, self.dtype)


@dataclass(frozen=True)
class Source:
    """Where rows come from, and which of their columns carry time.

    `field_mapping` maps final column name -> source column or Spark SQL expression.
    """

    format: str = "parquet"
    path: str | None = None
    event_timestamp: str = EVENT_TS
    created_timestamp: str | None = None
    date_partition: str | None = None
    field_mapping: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | str | None = None

    @staticmethod
    def warehouse(
        project: str,
        dataset: str,
        table: str,
        event_timestamp: str,
        *,
        format: str = "bigquery",
        materialization: Mapping[str, str] | None = None,
        **kwargs,
    ) -> Source:
        """A warehouse table or view read through a user-supplied connector."""
        # The connector's option names.
        options = {"viewsEnabled": "true"}
        if materialization:
            options["materializationProject"] = materialization["project"]
            options["materializationDataset"] = materialization["dataset"]
        return Source(
            format=format,
            path=f"{project}:{dataset}.{table}",
            event_timestamp=event_timestamp,
            options=options,
            **kwargs,
        )

    @staticmethod
    def sql_server(
        table: str, url: str, event_timestamp: str, *, options: Mapping[str, str] | None = None, **kwargs
    ) -> Source:
        """A database table read over JDBC with a user-supplied driver."""
        return Source(
            format="jdbc",
            event_timestamp=event_timestamp,
            options={"url": url, "dbtable": table, **(options or {})},
            **kwargs,
        )

    @staticmethod
    def broker(bootstrap_servers: str, topic: str, event_timestamp: str, **kwargs) -> Source:
        """A message broker topic."""
        # Spark's option names.
        return Source(
            format="kafka",
            event_timestamp=event_timestamp,
            options={"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic},
            **kwargs,
        )

    @staticmethod
    def from_dict(config: Mapping) -> Source:
        """Build a source from `{"file"|"bq"|"kafka"|"jdbc"|"table": {...}}`."""
        if len(config) != 1:
            raise SchemaError(f"a source has exactly one kind, got {sorted(config)}")
        ((kind, body),) = config.items()
        common = {
            "event_timestamp": body["event_timestamp_column"],
            "created_timestamp": body.get("created_timestamp_column") or None,
            "date_partition": body.get("date_partition_column") or None,
            "field_mapping": dict(body.get("field_mapping") or {}),
        }
        if kind == "file":
            fmt = body["format"]
            name = fmt["json_class"] if isinstance(fmt, Mapping) else fmt
            return Source(
                format=FORMAT_NAMES.get(name, name),
                path=body["path"],
                options=dict(body.get("options") or {}),
                **common,
            )
        if kind == "bq":
            return Source.warehouse(
                body["project"], body["dataset"], body["table"],
                materialization=body.get("materialization"), **common,
            )
        if kind == "kafka":
            return Source.broker(body["bootstrap_servers"], body["topic"], **common)
        if kind == "jdbc":
            return Source.sql_server(
                body["table"], body["url"], options=body.get("options"), **common
            )
        if kind == "table":
            return Source(format="table", path=body["table"], **common)
        raise SchemaError(f"unknown source kind {kind!r}")


def _as_timedelta(value) -> timedelta | None:
    if value is None or isinstance(value, timedelta):
        return value
    return timedelta(seconds=value)


@dataclass(frozen=True)
class FeatureTable:
    """Features of one or more entity keys over time.

    `max_age` (timedelta or seconds) limits how old a value may be; None is unlimited.
    `tie_break` names source columns that order rows with equal event and created time;
    the feature values themselves decide what is left.
    """

    name: str
    entities: tuple[Field, ...]
    features: tuple[Field, ...]
    max_age: timedelta | None = None
    project: str = "default"
    source: Source | None = None
    labels: Mapping[str, str] = field(default_factory=dict)
    tie_break: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        as_fields = tuple(
            e.as_field() if isinstance(e, Entity) else e for e in self.entities
        )
        object.__setattr__(self, "entities", as_fields)
        object.__setattr__(self, "features", tuple(self.features))
        object.__setattr__(self, "tie_break", tuple(self.tie_break))
        object.__setattr__(self, "max_age", _as_timedelta(self.max_age))
        if self.max_age is not None and self.max_age <= timedelta(0):
            raise SchemaError(f"{self.name}: max_age must be positive; use None for unlimited")
        if not self.entities:
            raise SchemaError(f"{self.name}: a feature table needs at least one entity")
        names = self.keys + self.feature_names
        if len(set(names)) != len(names):
            raise SchemaError(f"{self.name}: column names must be distinct, got {names}")

    @property
    def keys(self) -> list[str]:
        return [e.name for e in self.entities]

    @property
    def feature_names(self) -> list[str]:
        return [f.name for f in self.features]

    def with_features(self, names: Sequence[str]) -> FeatureTable:
        """The same table reduced to the named features, in the order given."""
        by_name = {f.name: f for f in self.features}
        missing = [n for n in names if n not in by_name]
        if missing:
            raise SchemaError(f"{self.name}: unknown features {missing}")
        return replace(self, features=tuple(by_name[n] for n in names))

    @staticmethod
    def from_dict(config: Mapping, source: Source | None = None) -> FeatureTable:
        def fields(items: Iterable[Mapping]) -> tuple[Field, ...]:
            return tuple(Field(i["name"], i["type"]) for i in items)

        return FeatureTable(
            name=config["name"],
            entities=fields(config["entities"]),
            features=fields(config["features"]),
            max_age=config.get("max_age"),
            project=config.get("project") or "default",
            source=source,
            labels=dict(config.get("labels") or {}),
            tie_break=tuple(config.get("tie_break") or ()),
        )


def parse_refs(refs: Sequence[str]) -> dict[str, list[str]]:
    """`["t:a", "u:b", "t:c"]` -> `{"t": ["a", "c"], "u": ["b"]}`, first-seen order."""
    grouped: dict[str, list[str]] = {}
    for ref in refs:
        table, sep, feature = ref.partition(":")
        if not (sep and table and feature):
            raise SchemaError(f"a feature reference looks like table:feature, got {ref!r}")
        features = grouped.setdefault(table, [])
        if feature not in features:
            features.append(feature)
    return grouped


def output_name(table: str, feature: str, full: bool) -> str:
    return f"{table}__{feature}" if full else feature
