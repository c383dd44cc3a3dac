"""Result rows as keyed JSON messages, and writers for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.params import StreamSettings
from skyledger.schema import Q1_RESULT, Q2_RESULT, Q3_RESULT


def _encode(results: DataFrame, schema: T.StructType, key: Column) -> DataFrame:
    payload = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return results.select(key.cast("string").alias("key"), F.to_json(payload).alias("value"))


def encode_q1(results: DataFrame) -> DataFrame:
    """Keyed by carrier."""
    return _encode(results, Q1_RESULT, F.col("airline"))


def encode_q2(results: DataFrame) -> DataFrame:
    """Keyed by the airport id as text."""
    return _encode(results, Q2_RESULT, F.col("origin_airport_id"))


def encode_q3(results: DataFrame) -> DataFrame:
    """Without a key: spread evenly over the topic."""
    return _encode(results, Q3_RESULT, F.lit(None))


ENCODERS = {
    "q1": encode_q1,
    "q2_1h": encode_q2,
    "q2_6h": encode_q2,
    "q2_global": encode_q2,
    "q3_1d": encode_q3,
    "q3_7d": encode_q3,
    "q3_global": encode_q3,
}


def write_messages(results: DataFrame, query: str, settings: StreamSettings) -> None:
    """Batch write of one query's results to its own topic (also from ``foreachBatch``)."""
    (
        ENCODERS[query](results).write.format("kafka")
        .option("kafka.bootstrap.servers", settings.bootstrap_servers)
        .option("topic", settings.output_topics[query])
        .save()
    )


def message_sinks(settings: StreamSettings) -> dict[str, list[Callable[[DataFrame, int], None]]]:
    """Sinks for the whole streaming job: each result goes to its own topic. A replayed batch sends its rows again."""
    return {
        query: [lambda rows, _, query=query: write_messages(rows, query, settings)]
        for query in ENCODERS if query in settings.output_topics
    }


def as_plain_text(df: DataFrame, column: str) -> DataFrame:
    """One unkeyed text value per row, for the default destination or a text file."""
    return df.select(F.col(column).cast("string").alias("value"))


def write_plain_kafka(df: DataFrame, column: str, settings: StreamSettings) -> None:
    (
        as_plain_text(df, column).write.format("kafka")
        .option("kafka.bootstrap.servers", settings.bootstrap_servers)
        .option("topic", settings.default_topic)
        .save()
    )


def write_plain_text(df: DataFrame, column: str, path: str) -> None:
    as_plain_text(df, column).write.mode("overwrite").text(path)


def show_rows(df: DataFrame, n: int = 20) -> None:
    """Console sink for finished rows; streams use ``start_console``."""
    df.show(n, truncate=False)
