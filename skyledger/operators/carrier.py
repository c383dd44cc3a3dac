"""Hourly carrier performance (Q1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.scalars import above, safe_divide_rounded, safe_percent
from skyledger.operators.clean import target_airlines
from skyledger.operators.windows import coarser_window, event_window, unpack_window
from skyledger.params import JobParams


def carrier_partials(cleaned: DataFrame, params: JobParams = JobParams(), window: str = "1h") -> DataFrame:
    """Additive counters per (window, carrier); one shuffle of already combined rows.

    Cancelled flights are left out of the delay sum by their flag; diverted ones stay in.
    """
    flown = ~F.col("is_cancelled")
    return (
        target_airlines(cleaned, params.carriers)
        .groupBy(event_window(window), "airline")
        .agg(
            F.count(F.lit(1)).alias("num_flights"),
            F.count_if(flown & ~F.col("is_diverted")).alias("completed"),
            F.count_if(F.col("is_cancelled")).alias("cancelled"),
            F.count_if(flown & F.col("is_diverted")).alias("diverted"),
            F.count_if(flown & above(F.col("dep_delay"), params.late_minutes)).alias("late"),
            F.sum(F.when(flown, F.col("dep_delay"))).alias("delay_sum"),
        )
    )


def finish_carrier(partials: DataFrame) -> DataFrame:
    """Result rows from counters. The two rates have different denominators."""
    flown = F.col("num_flights") - F.col("cancelled")
    return partials.select(
        "window_start", "window_end", "airline", "num_flights", "completed", "cancelled", "diverted",
        safe_divide_rounded(F.coalesce("delay_sum", F.lit(0.0)), flown).alias("dep_delay_mean"),
        safe_percent(F.col("cancelled"), F.col("num_flights")).alias("cancellation_rate"),
        safe_percent(F.col("late"), flown).alias("late_departure_rate"),
    )


def merge_carrier_partials(partials: DataFrame, window: str) -> DataFrame:
    """Counters of a coarser window from a finer one."""
    counters = ("num_flights", "completed", "cancelled", "diverted", "late", "delay_sum")
    return partials.groupBy(*coarser_window(window), "airline").agg(*[F.sum(c).alias(c) for c in counters])


def carrier_performance(cleaned: DataFrame, params: JobParams = JobParams()) -> DataFrame:
    """Q1 over one-hour windows; batch, or streaming behind a watermark."""
    return finish_carrier(unpack_window(carrier_partials(cleaned, params)))
