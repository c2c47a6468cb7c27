"""Errors raised at plan time, before any row is read."""


class SchemaError(ValueError):
    """A frame does not have the columns or types that were declared for it."""


class MissingConnectorError(RuntimeError):
    """An optional Spark package (broker, Avro, protobuf, JDBC driver, ...) is absent."""


class CommitConflict(RuntimeError):
    """Another writer committed the same version of an online table first."""
