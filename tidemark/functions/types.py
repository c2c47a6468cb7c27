"""The closed set of feature types and how they map to Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.errors import SchemaError

# The seven scalar feature types and their Spark types.
# Each scalar NAME also has a list form NAME_LIST.
_SCALARS: dict[str, T.DataType] = {
    "BYTES": T.BinaryType(),
    "STRING": T.StringType(),
    "INT32": T.IntegerType(),
    "INT64": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOL": T.BooleanType(),
}

TIMESTAMP_TYPES = (T.TimestampType, T.TimestampNTZType)


def feature_types() -> list[str]:
    """All fourteen feature type names."""
    return list(_SCALARS) + [f"{name}_LIST" for name in _SCALARS]


def spark_type(feature_type: str) -> T.DataType:
    """Spark type of a feature type name (case does not matter)."""
    name = feature_type.upper()
    if name in _SCALARS:
        return _SCALARS[name]
    element = _SCALARS.get(name.removesuffix("_LIST"))
    if element is None:
        raise SchemaError(f"unknown feature type {feature_type!r}")
    return T.ArrayType(element)


def feature_type(dtype: T.DataType) -> str:
    """Feature type name of a Spark type; raises for types features cannot have."""
    suffix = ""
    if isinstance(dtype, T.ArrayType):
        dtype, suffix = dtype.elementType, "_LIST"
    for name, candidate in _SCALARS.items():
        if candidate == dtype:
            return name + suffix
    raise SchemaError(f"{dtype.simpleString()} is not a feature type")


def same_type(declared: T.DataType, actual: T.DataType) -> bool:
    """Type equality that ignores whether array elements may be null."""
    return declared.simpleString() == actual.simpleString()


def castable(actual: T.DataType, declared: T.DataType) -> bool:
    """The only implicit cast is a double source column declared as float."""
    return isinstance(actual, T.DoubleType) and isinstance(declared, T.FloatType)


def is_timestamp(dtype: T.DataType) -> bool:
    return isinstance(dtype, TIMESTAMP_TYPES)
