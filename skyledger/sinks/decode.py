"""Typed re-read of result messages, and the pivot from (field, value) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.schema import DELAYED_FLIGHTS, Q1_RESULT, Q3_RESULT


def _number(name: str, kind: str) -> Column:
    zero = F.lit(0).cast(kind)
    return F.coalesce(F.col(f"r.{name}").try_cast("double").cast(kind), zero).alias(name)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def decode_q2(messages: DataFrame, value: str = "value") -> DataFrame:
    """Rank and window type as text tags, numbers with default 0, the flight list as one JSON text."""
    fields = ("window_start", "window_end", "window_type", "rank", "origin_airport_id", "num_flights",
              "severe_delays", "dep_delay_mean", "dep_delay_max")
    schema = T.StructType([*_text_schema(fields).fields, T.StructField("delayed_flights", DELAYED_FLIGHTS)])
    flights = F.coalesce("r.delayed_flights", F.array().cast(DELAYED_FLIGHTS))
    return messages.select(F.from_json(value, schema).alias("r")).select(
        F.timestamp_millis(F.col("r.window_start").try_cast("long")).alias("time"),
        F.coalesce("r.rank", F.lit("")).alias("rank"),
        F.coalesce("r.window_type", F.lit("")).alias("window_type"),
        *[_number(n, "long") for n in ("origin_airport_id", "window_end", "num_flights", "severe_delays")],
        *[_number(n, "double") for n in ("dep_delay_mean", "dep_delay_max")],
        F.to_json(flights).alias("delayed_flights"),
    )


def _decode_plain(
    messages: DataFrame, value: str, schema: T.StructType, tags: Sequence[str], integers: Sequence[str]
) -> DataFrame:
    names = [f.name for f in schema.fields]
    fields = [n for n in names if n not in tags and n != "window_start"]
    return messages.select(F.from_json(value, _text_schema(names)).alias("r")).select(
        F.timestamp_millis(F.col("r.window_start").try_cast("long")).alias("time"),
        *[F.col(f"r.{t}").alias(t) for t in tags],
        *[
            F.col(f"r.{n}").try_cast("double").cast("long" if n in integers else "double").alias(n)
            for n in fields
        ],
    )


def decode_q1(messages: DataFrame, value: str = "value") -> DataFrame:
    """Carrier as a tag, the four counts as integers, everything else as doubles."""
    counts = ("num_flights", "completed", "cancelled", "diverted")
    return _decode_plain(messages, value, Q1_RESULT, ("airline",), counts)


def decode_q3(messages: DataFrame, value: str = "value") -> DataFrame:
    """Carrier, window type and hour as text tags; count and window end as integers."""
    return _decode_plain(messages, value, Q3_RESULT, ("airline", "window_type", "hour"), ("count", "window_end"))


def pivot_fields(points: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, field, value) rows to one wide row per key. The field list is given, so no extra pass."""
    return points.groupBy(*keys).pivot("field", list(fields)).agg(F.first("value", ignorenulls=True))


def unpivot_fields(wide: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One (keys, field, value) row per numeric field."""
    return wide.select(*keys, *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(
        list(keys), list(fields), "field", "value"
    )
