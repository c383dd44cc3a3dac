"""Cleaning rules, reject counts and the shared filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.scalars import (
    event_time,
    event_time_unchecked,
    flag_set,
    scheduled_hour,
    valid_date,
    valid_time_of_day,
)

_REQUIRED = (
    "year", "month", "day_of_month", "airline", "crs_dep_time", "origin_airport_id", "dest_airport_id",
)


def with_event_time(flights: DataFrame) -> DataFrame:
    """Adds ``event_ts`` (null when invalid) and ``dep_hour`` (-1 when invalid)."""
    hhmm = F.col("crs_dep_time")
    return flights.withColumns({
        "event_ts": event_time(F.col("year"), F.col("month"), F.col("day_of_month"), hhmm),
        "dep_hour": F.coalesce(scheduled_hour(hhmm), F.lit(-1)),
    })


def is_complete() -> Column:
    """All routing and time fields present; a blank carrier counts as missing."""
    present = F.trim("airline") != ""
    for name in _REQUIRED:
        present = present & F.col(name).isNotNull()
    return present


def has_valid_time() -> Column:
    """Event time computable, which also means an hour slot of 0 or more."""
    return valid_time_of_day(F.col("crs_dep_time")) & valid_date(F.col("year"), F.col("month"), F.col("day_of_month"))


def is_contradiction() -> Column:
    """Cancelled and diverted at once."""
    return flag_set(F.col("cancelled")) & flag_set(F.col("diverted"))


def reject_rule() -> Column:
    """Name of the first broken rule, null for a clean row."""
    return (
        F.when(~F.coalesce(is_complete(), F.lit(False)), F.lit("completeness"))
        .when(~F.coalesce(has_valid_time(), F.lit(False)), F.lit("event_time"))
        .when(is_contradiction(), F.lit("contradiction"))
    )


def clean(flights: DataFrame) -> DataFrame:
    """Rows that pass every rule, with event time and hour, null delay as 0.0 and flags as booleans.

    The filter uses source columns only, in plain comparisons: they reach a parquet scan, and the event
    time is computed once, for rows that stay. Date and time need no null check of their own, as a null
    makes them invalid. A short filter matters: past a size, the JVM no longer compiles the scan loop.
    """
    routed = (F.trim("airline") != "") & F.col("origin_airport_id").isNotNull() & F.col("dest_airport_id").isNotNull()
    hhmm = F.col("crs_dep_time")
    # The range repeats part of the time rule in a form that a parquet scan can use.
    passed = flights.where(routed).where(hhmm.between(0, 2400)).where(has_valid_time()).where(~is_contradiction())
    at = event_time_unchecked(F.col("year"), F.col("month"), F.col("day_of_month"), hhmm)
    return passed.withColumns({
        "event_ts": at,
        "dep_hour": scheduled_hour(hhmm),
        "dep_delay": F.coalesce("dep_delay", F.lit(0.0)),
        "is_cancelled": flag_set(F.col("cancelled")),
        "is_diverted": flag_set(F.col("diverted")),
    }).withColumn("event_ms", F.unix_millis("event_ts"))


def rejects(flights: DataFrame) -> DataFrame:
    """Quarantine: the dropped rows with the rule that dropped them."""
    return flights.withColumn("reject_rule", reject_rule()).where("reject_rule IS NOT NULL")


def rejects_by_rule(flights: DataFrame) -> DataFrame:
    return rejects(flights).groupBy("reject_rule").agg(F.count(F.lit(1)).alias("corrupted_records_total"))


def observe_rejects(flights: DataFrame, name: str = "rejects") -> DataFrame:
    """Passes rows through and reports reject counts as an observed metric (streams: in the progress)."""
    rule = reject_rule()
    return flights.observe(
        name,
        F.count_if(rule.isNotNull()).alias("corrupted_records_total"),
        *[F.count_if(rule == r).alias(r) for r in ("completeness", "event_time", "contradiction")],
    )


def active_flights(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(~F.col("is_cancelled") & ~F.col("is_diverted"))


def target_airlines(cleaned: DataFrame, carriers: Sequence[str]) -> DataFrame:
    """Exact membership; the stored carrier is not trimmed."""
    if carriers is None:
        raise ValueError("a carrier set is required")
    return cleaned.where(F.col("airline").isin(list(carriers)))


def global_average_delay(cleaned: DataFrame) -> DataFrame:
    """Mean delay of all clean rows, unrounded; partial sums, then one row."""
    return cleaned.agg((F.sum("dep_delay") / F.count(F.lit(1))).alias("avg_delay"))
