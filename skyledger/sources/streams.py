"""Stream and bounded sources that deliver decoded flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.params import StreamSettings
from skyledger.sources.json_events import decode_flights


def _kafka_options(settings: StreamSettings) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.input_topic,
        "startingOffsets": "earliest",
    }


def kafka_flights(spark: SparkSession, settings: StreamSettings, ingest_from_broker: bool = False) -> DataFrame:
    """Unbounded flights from one topic, from the earliest offset. Needs the Kafka connector jar.

    Offsets live in the query checkpoint; the group id is only a prefix for the consumers.
    """
    messages = (
        spark.readStream.format("kafka").options(**_kafka_options(settings))
        .option("groupIdPrefix", settings.group_id)
        .option("maxOffsetsPerTrigger", settings.max_offsets_per_trigger).load()
    )
    stamp = F.unix_millis("timestamp") if ingest_from_broker else None
    return decode_flights(messages, "value", stamp)


def kafka_flights_bounded(spark: SparkSession, settings: StreamSettings) -> DataFrame:
    """Batch read of the topic up to the offsets that are latest now."""
    messages = (
        spark.read.format("kafka").options(**_kafka_options(settings)).option("endingOffsets", "latest").load()
    )
    return decode_flights(messages)


# Files of one micro-batch, unless the caller says otherwise.
MAX_FILES = 1000


def json_file_flights(spark: SparkSession, path: str, max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """Unbounded flights from a folder of JSON-lines files, oldest file first."""
    return decode_flights(spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path))


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = MAX_FILES
) -> DataFrame:
    """Unbounded rows from parquet files with a declared schema."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
