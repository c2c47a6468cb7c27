"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.errors import MissingConnectorError
from tidemark.model import Source


def broker_options(
    source: Source,
    *,
    username: str | None = None,
    password: str | None = None,
    mechanism: str = "PLAIN",
) -> dict[str, str]:
    """Reader options of a broker topic, with SASL login when a user name is given. A query goes
    on past messages that the topic no longer has, unless the source's own options say otherwise."""
    # Spark's and the broker client's option names.
    options = {"failOnDataLoss": "false", **source.options}
    if username is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options.update(
            {
                "kafka.sasl.mechanism": mechanism,
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.jaas.config": f'{login} required username="{username}" password="{password}";',
            }
        )
    return options


def read_broker(spark: SparkSession, source: Source, **login) -> DataFrame:
    """Messages of a topic (key, value, topic, partition, offset, timestamp)."""
    try:
        return spark.readStream.format("kafka").options(**broker_options(source, **login)).load()
    except Exception as error:
        if "Failed to find data source" in str(error) or "DATA_SOURCE_NOT_FOUND" in str(error):
            raise MissingConnectorError(
                "a broker source needs the spark-sql-kafka package; add it with --packages"
            ) from error
        raise


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "parquet",
    *,
    files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """Files that arrive in a folder (or match a glob pattern), as a stream."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
