"""Message decoding as columns. Undecodable messages become null structs, never errors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import MissingConnectorError

MALFORMED = "_malformed"


def _decoded(what: str, package: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Run a decoder of an optional Spark package; a clear error when it is absent."""
    try:
        return make()
    except (TypeError, AnalysisException) as error:
        if "JavaPackage" in str(error) or "NOT_LOADED" in str(error):
            raise MissingConnectorError(f"{what} needs {package}; add it with --packages") from error
        raise


def decode_json(df: DataFrame, column: str, schema: T.StructType, into: str) -> DataFrame:
    """JSON text to a struct; `_malformed` is true for text that is not the schema's JSON."""
    marker = "__tm_corrupt"
    wide = T.StructType([*schema.fields, T.StructField(marker, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": marker}
    parsed = F.from_json(F.col(column).cast("string"), wide, options)
    out = df.withColumn("__tm_parsed", parsed)
    bad = F.col("__tm_parsed").isNull() | F.col(f"__tm_parsed.{marker}").isNotNull()
    clean = F.struct(*[F.col("__tm_parsed")[f.name].alias(f.name) for f in schema.fields])
    return out.withColumn(MALFORMED, bad).withColumn(into, F.when(~bad, clean)).drop("__tm_parsed")


def encode_json(column: str | Column) -> Column:
    return F.to_json(column)


def decode_avro(df: DataFrame, column: str, json_schema: str, into: str) -> DataFrame:
    """Avro bytes to a struct (needs the spark-avro package)."""
    from pyspark.sql.avro.functions import from_avro

    out = _decoded(
        "Avro decoding",
        "spark-avro",
        lambda: df.withColumn(into, from_avro(F.col(column), json_schema, {"mode": "PERMISSIVE"})),
    )
    # A permissive decode yields a struct of nulls for bytes it cannot read.
    some = F.lit(False)
    for name in out.schema[into].dataType.names:
        some = some | F.col(into)[name].isNotNull()
    return out.withColumn(MALFORMED, ~F.coalesce(some, F.lit(False)))


def encode_avro(df: DataFrame, column: str, into: str, json_schema: str = "") -> DataFrame:
    """A struct as Avro bytes (needs the spark-avro package)."""
    from pyspark.sql.avro.functions import to_avro

    return _decoded(
        "Avro encoding",
        "spark-avro",
        lambda: df.withColumn(into, to_avro(F.col(column), json_schema)),
    )


def decode_protobuf(
    df: DataFrame, column: str, message: str, descriptor_file: str, into: str
) -> DataFrame:
    """Protobuf bytes to a struct, schema inferred from a descriptor file (needs the
    spark-protobuf package). Enums become strings, well-known timestamps timestamps."""
    from pyspark.sql.protobuf.functions import from_protobuf

    def make() -> DataFrame:
        decoded = from_protobuf(F.col(column), message, descriptor_file, {"mode": "PERMISSIVE"})
        return df.withColumn(into, decoded)

    out = _decoded("protobuf decoding", "spark-protobuf", make)
    return out.withColumn(MALFORMED, F.col(into).isNull())
