"""Message sources and sinks: Kafka where the connector is installed, files anywhere."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strataflow.functions.messages import encode_json


def kafka_options(
    servers: str, topic: str, starting: str = "earliest", fail_on_data_loss: bool = False, **more: str
) -> dict[str, str]:
    """Options to subscribe to one topic. ``maxOffsetsPerTrigger`` bounds a micro-batch."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **more,
    }


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    schema: T.StructType | str | None = None,
    path: str | None = None,
) -> DataFrame:
    """An unbounded frame from any streaming source; file sources need a schema and a path."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_messages(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """As :func:`read_stream`, reduced to the message text in ``value``."""
    return read_stream(spark, fmt, options, path=path).selectExpr("CAST(value AS STRING) AS value")


def write_messages(df: DataFrame, fmt: str, options: Mapping[str, str], path: str | None = None) -> None:
    """Send each row as one JSON message, to Kafka or to text files."""
    writer = encode_json(df).write.format(fmt).options(**options)
    writer.save(path) if path else writer.save()
