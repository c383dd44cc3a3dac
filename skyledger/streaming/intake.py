"""What every stream begins with: event time, watermark, counters, cleaning."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.scalars import flag_set
from skyledger.operators.clean import has_valid_time, reject_rule, with_event_time
from skyledger.session import make_folder, read_small

REJECT_RULES = ("completeness", "event_time", "contradiction")

# Date and time of the row that closes a bounded stream: no window ends behind it.
CLOSING_MS = 253_370_764_800_000
_CLOSING = {"year": 9999, "month": 1, "day_of_month": 1, "crs_dep_time": 0, "event_ms": CLOSING_MS}
# What event time, flags and reject rule are made of; nothing behind them reads it.
_MADE_OF = ("year", "month", "day_of_month", "crs_dep_time", "cancelled", "diverted")


def with_closing(flights: DataFrame, folder: str) -> DataFrame:
    """Flights, and the closing row once ``close`` has put it into the folder; ``closing`` tells them apart."""
    make_folder(flights.sparkSession, folder)
    fields = [T.StructField(f.name, f.dataType) for f in flights.schema.fields]
    marks = flights.sparkSession.readStream.schema(T.StructType(fields)).parquet(folder)
    return flights.withColumn("closing", F.lit(False)).unionByName(marks.withColumn("closing", F.lit(True)))


def close(spark: SparkSession, schema: T.StructType, folder: str) -> None:
    """Ends a bounded stream: the next run sees a row whose event time is behind every window."""
    row = spark.range(1).select(*[
        F.lit(_CLOSING.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
    row.coalesce(1).write.mode("overwrite").parquet(folder)


def _judged(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "event_ms": F.when(has_valid_time(), F.unix_millis("event_ts")),
        "dep_delay": F.coalesce("dep_delay", F.lit(0.0)),
        "is_cancelled": flag_set(F.col("cancelled")),
        "is_diverted": flag_set(F.col("diverted")),
        "reject_rule": reject_rule(),
    })


def judged_flights(flights: DataFrame) -> DataFrame:
    """All rows, rejected ones too, with event time, flags and reject rule in place of what these are made of.

    ``clean_stream`` takes them as it takes flights, so that several results need not work this out again.
    """
    return _judged(with_event_time(flights)).drop("event_ts", *_MADE_OF)


def _watermarked(flights: DataFrame, delay_minutes: int) -> DataFrame:
    judged = "reject_rule" in flights.columns
    rows = flights.withColumn("event_ts", F.timestamp_millis("event_ms")) if judged else with_event_time(flights)
    return rows.withWatermark("event_ts", f"{delay_minutes} minutes")


def clean_stream(inputs: Sequence[DataFrame], delay_minutes: int, name: str) -> DataFrame:
    """Clean rows of one or several inputs, flights or judged ones, behind a watermark, with the columns that ``clean`` gives.

    The watermark is set on raw rows, so a row that is rejected or filtered out moves it too: the filters stay above
    the observed counters. Several inputs each have a watermark of their own;
    ``spark.sql.streaming.multipleWatermarkPolicy`` says which of them counts. The counters are in the progress under
    ``name``.
    """
    rows = reduce(DataFrame.unionByName, [_watermarked(f, delay_minutes) for f in inputs])
    real = ~F.col("closing")
    timed = (rows if "reject_rule" in rows.columns else _judged(rows)).observe(
        name, F.count_if(real).alias("rows_in"),
        *[F.count_if(real & (F.col("reject_rule") == r)).alias(f"rejected_{r}") for r in REJECT_RULES])
    return timed.where(real & F.col("reject_rule").isNull()).drop(*_MADE_OF, "reject_rule", "closing")


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int | None:
    """The watermark of a micro-batch as Spark has logged it before the batch began; None before the first."""
    for line in read_small(spark, f"{checkpoint}/offsets/{batch_id}").splitlines():
        if "batchWatermarkMs" in line:
            return json.loads(line)["batchWatermarkMs"] or None
    return None
