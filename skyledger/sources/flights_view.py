"""Flights derived from a generic event log, by arithmetic on the event id.

Test tables hold no flights. Every rule here is deterministic and per row, so the same view exists in
any SQL engine, over any number of events, in batch and in a stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.scalars import event_time
from skyledger.sources.streams import parquet_stream

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Fixed values of the view: carriers in turn.
VIEW_CARRIERS = ("AA", "DL", "UA", "WN", "B6", "OO")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a file stream. The glob also matches when the table is a folder of files."""
    return parquet_stream(spark, f"{sf_dir}/events.parquet*", EVENTS_SCHEMA)


def flights_from_events(events: DataFrame) -> DataFrame:
    """``event_id``, the ten flight columns, and ``publish_ms`` = ``ingest_ms``: the arrival time.

    One row in 19 arrives 1 to 30 minutes late.
    """
    carriers = ", ".join(f"'{c}'" for c in VIEW_CARRIERS)
    view = events.selectExpr(
        "event_id",
        "year(ts) AS year",
        "month(ts) AS month",
        "day(ts) AS day_of_month",
        f"if(event_id % 97 = 0, ' ', get(array({carriers}), int(event_id % {len(VIEW_CARRIERS)}))) AS airline",
        "CASE WHEN event_id % 101 = 0 THEN 1275 WHEN event_id % 211 = 0 THEN 2400"
        " ELSE hour(ts) * 100 + minute(ts) END AS crs_dep_time",
        "if(event_id % 17 = 0, NULL, floor(value) - 15D) AS dep_delay",
        "if(event_type = 'error' AND event_id % 5 = 0, 1D, 0D) AS cancelled",
        "if((event_type = 'signup' AND event_id % 7 = 0) OR (event_type = 'error' AND event_id % 55 = 0), 1D, 0D)"
        " AS diverted",
        "int(10000 + user_id % 10) AS origin_airport_id",
        "20000 + int(get_json_object(props, '$.k')) AS dest_airport_id",
    )
    at = event_time(F.col("year"), F.col("month"), F.col("day_of_month"), F.col("crs_dep_time"))
    late = F.expr("if(event_id % 19 = 7, 60000L * (1 + (event_id div 19) % 30), 0L)")
    flights = view.withColumn("publish_ms", F.unix_millis(at) + late).withColumn("ingest_ms", F.col("publish_ms"))
    # Observing the row count also ends the view: later filters are not rewritten into the rules above,
    # where each use of a column would repeat its rule. A stored flights table needs no such line.
    return flights.observe(f"flights_view_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows_in"))
