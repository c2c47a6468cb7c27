"""tidemark: point-in-time feature data on Spark."""

from tidemark.engine import FeatureEngine
from tidemark.errors import CommitConflict, MissingConnectorError, SchemaError
from tidemark.model import Entity, FeatureTable, Field, Source, parse_refs
from tidemark.operators.asof import FeatureInput, as_of_join, multi_as_of
from tidemark.operators.ingest import IngestReport, ingest_batch, materialize, push
from tidemark.operators.latest import compact, latest_per_key, pull_all
from tidemark.operators.online import OnlineTable, fold_batches, key_expiry
from tidemark.operators.snapshots import SnapshotStore
from tidemark.operators.validate import Suite, expect, expect_between, expect_in_set, frames_equal
from tidemark.plans.skew import SkewOptions
from tidemark.streaming.ingest import ingest_stream

__all__ = [
    "CommitConflict",
    "Entity",
    "FeatureEngine",
    "FeatureInput",
    "FeatureTable",
    "Field",
    "IngestReport",
    "MissingConnectorError",
    "OnlineTable",
    "SchemaError",
    "SkewOptions",
    "SnapshotStore",
    "Source",
    "Suite",
    "as_of_join",
    "compact",
    "expect",
    "expect_between",
    "expect_in_set",
    "fold_batches",
    "frames_equal",
    "ingest_batch",
    "ingest_stream",
    "key_expiry",
    "latest_per_key",
    "materialize",
    "multi_as_of",
    "parse_refs",
    "pull_all",
    "push",
]
