"""Late data: disorder, watermark replay, lateness and latency statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import sketch
from skyledger.operators.windows import window_ms
from skyledger.params import HOUR_MS

MINUTE_MS = 60_000
_MINUTES_PER_DAY = 1440

LATENESS_QUANTILES = (("p50", 0.50), ("p90", 0.90), ("p95", 0.95), ("p99", 0.99))


def arrival_watermarks(flights: DataFrame, event: str = "event_ms", arrival: str = "publish_ms") -> DataFrame:
    """``arrival_minute, seen_ms``: the largest event time that arrived in earlier minutes.

    Flights collapse to one row per arrival minute before anything is ordered. The running maximum is
    taken within each day in parallel; only the one-row-per-day summary is ordered as a whole, and
    that is bounded by the calendar, not by the data.
    """
    minute = F.floor(F.col(arrival) / MINUTE_MS)
    per_minute = (
        flights.where(F.col(event).isNotNull())
        .groupBy(minute.alias("arrival_minute"))
        .agg(F.max(event).alias("newest"))
        .withColumn("arrival_day", F.floor(F.col("arrival_minute") / _MINUTES_PER_DAY))
    )
    earlier = (Window.unboundedPreceding, -1)
    within = Window.partitionBy("arrival_day").orderBy("arrival_minute").rowsBetween(*earlier)
    across = Window.orderBy("arrival_day").rowsBetween(*earlier)
    days = (
        per_minute.groupBy("arrival_day").agg(F.max("newest").alias("day_newest"))
        .select("arrival_day", F.max("day_newest").over(across).alias("before_day"))
    )
    return (
        per_minute.withColumn("before_minute", F.max("newest").over(within))
        # A left join adds no null filter to this side, so both sides share one aggregated exchange.
        .join(days, "arrival_day", "left")
        .select("arrival_minute", F.greatest("before_minute", "before_day").alias("seen_ms"))
    )


def _outcome(window_end: Column, seen: Column, delay: Column, lateness: Column) -> Column:
    """lost: past the end plus both grace times; update: the window has already been emitted."""
    return (
        F.when(window_end + (delay + lateness) * MINUTE_MS <= seen, F.lit("lost"))
        .when(window_end + delay * MINUTE_MS <= seen, F.lit("update"))
        .otherwise(F.lit("on_time"))
    )


@dataclass(frozen=True)
class LateCase:
    """One query window as the late-data report sees it."""

    query: str
    window: str
    target_only: bool
    active_only: bool


# Which rows each question keeps.
LATE_CASES = (
    LateCase("q1", "1h", True, False),
    LateCase("q2", "1h", False, True),
    LateCase("q2", "6h", False, True),
    LateCase("q3", "1d", True, True),
    LateCase("q3", "7d", True, True),
)


def _hour_minute_counts(cleaned: DataFrame, carriers: Sequence[str]) -> DataFrame:
    """Rows per event hour and arrival minute: all that any outcome depends on."""
    hour = F.col("event_ms") - F.pmod(F.col("event_ms"), F.lit(HOUR_MS).cast("long"))
    return cleaned.groupBy(
        hour.alias("hour_start"),
        F.floor(F.col("publish_ms") / MINUTE_MS).alias("arrival_minute"),
        F.col("airline").isin(list(carriers)).alias("is_target"),
        (~F.col("is_cancelled") & ~F.col("is_diverted")).alias("is_active"),
    ).agg(F.count(F.lit(1)).alias("cnt"))


def _window_end(hour_start: Column, size_ms: Column) -> Column:
    return hour_start - F.pmod(hour_start, size_ms) + size_ms


def late_report(
    cleaned: DataFrame, watermarks: DataFrame, carriers: Sequence[str],
    settings: Sequence[tuple[int, int]], cases: Sequence[LateCase] = LATE_CASES,
) -> DataFrame:
    """Rows on time, updating an emitted window, or lost, per query window and (D, L) setting.

    One pass over the flights serves every case: they are counted per event hour and arrival minute
    first, and those counts meet the watermark table.
    """
    counts = _hour_minute_counts(cleaned, carriers).join(watermarks, "arrival_minute", "left")
    variants = F.array(*[
        F.struct(
            F.lit(c.query).alias("query"), F.lit(c.window).alias("window_type"),
            F.lit(window_ms(c.window)).cast("long").alias("size_ms"),
            F.lit(c.target_only).alias("target_only"), F.lit(c.active_only).alias("active_only"),
            F.lit(d).alias("watermark_delay"), F.lit(l).alias("allowed_lateness"),
        )
        for c in cases for d, l in settings
    ])
    rows = counts.withColumn("v", F.explode(variants)).where(
        (~F.col("v.target_only") | F.col("is_target")) & (~F.col("v.active_only") | F.col("is_active"))
    )
    outcome = _outcome(
        _window_end(F.col("hour_start"), F.col("v.size_ms")), F.col("seen_ms"),
        F.col("v.watermark_delay"), F.col("v.allowed_lateness"),
    )

    def total(kind: str) -> Column:
        return F.sum(F.when(F.col("outcome") == kind, F.col("cnt")).otherwise(0)).alias(kind)

    return (
        rows.select("v.query", "v.window_type", "v.watermark_delay", "v.allowed_lateness", "cnt",
                    outcome.alias("outcome"))
        .groupBy("query", "window_type", "watermark_delay", "allowed_lateness")
        .agg(F.sum("cnt").alias("num_rows"), total("on_time"), total("update"), total("lost"))
    )


def _lateness_minutes(window_end: Column, seen: Column, delay: int, lateness: int) -> Column:
    return (seen - delay * MINUTE_MS - (window_end + lateness * MINUTE_MS)) / float(MINUTE_MS)


def _lost_pairs(rows: DataFrame, watermarks: DataFrame, window: str, delay: int, lateness: int) -> DataFrame:
    """Counts and lateness of the (window, arrival minute) pairs that lose their rows."""
    size = F.lit(window_ms(window)).cast("long")
    outcome = _outcome(F.col("window_end"), F.col("seen_ms"), F.lit(delay), F.lit(lateness))
    return (
        rows.groupBy(
            _window_end(F.col("event_ms"), size).alias("window_end"),
            F.floor(F.col("publish_ms") / MINUTE_MS).alias("arrival_minute"),
        )
        .agg(F.count(F.lit(1)).alias("cnt"))
        .join(watermarks, "arrival_minute")
        .where(outcome == "lost")
        .select(
            "window_end", "arrival_minute", "cnt",
            _lateness_minutes(F.col("window_end"), F.col("seen_ms"), delay, lateness).alias("lateness_min"),
        )
    )


def late_rows(
    rows: DataFrame, watermarks: DataFrame, window: str, delay: int, lateness: int, work_dir: str
) -> DataFrame:
    """The late side output: every lost row, whole, with its window end and lateness.

    The few losing (window, minute) pairs are written to ``work_dir`` first. Their true size is known then, so the
    flights meet them without being shuffled while they are few.
    """
    size = F.lit(window_ms(window)).cast("long")
    pairs = _lost_pairs(rows, watermarks, window, delay, lateness).drop("cnt")
    pairs.write.mode("overwrite").parquet(f"{work_dir}/lost_pairs")
    lost = rows.sparkSession.read.schema(pairs.schema).parquet(f"{work_dir}/lost_pairs")
    return rows.withColumns({
        "window_end": _window_end(F.col("event_ms"), size),
        "arrival_minute": F.floor(F.col("publish_ms") / MINUTE_MS),
    }).join(lost, ["window_end", "arrival_minute"]).drop("arrival_minute")


def lateness_summary(lateness: DataFrame, accuracy: float = sketch.DEFAULT_ACCURACY) -> DataFrame:
    """One row from ``lateness_min, cnt``: rows late by more than 0, whole-minute maximum, quantiles."""
    late = lateness.where(F.col("lateness_min") > 0).withColumn("scope", F.lit("all"))
    bins = sketch.bin_counts(late, ["scope"], "lateness_min", accuracy, "cnt")
    stats = sketch.quantiles(bins, ["scope"], LATENESS_QUANTILES, accuracy)
    # The outer aggregate also gives a row (of zeros) when nothing was late.
    return stats.agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total_late_records"),
        F.coalesce(F.floor(F.max("max")), F.lit(0)).cast("long").alias("max_lateness_minutes"),
        *[F.coalesce(F.max(name), F.lit(0.0)).alias(f"lateness_{name}") for name, _ in LATENESS_QUANTILES],
    )


def lateness_stats(
    rows: DataFrame, watermarks: DataFrame, window: str, delay: int, lateness: int
) -> DataFrame:
    """Lateness statistics of the lost rows, from counted pairs."""
    return lateness_summary(_lost_pairs(rows, watermarks, window, delay, lateness))
