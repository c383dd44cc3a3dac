"""Departure-delay distributions per carrier and hour of day (Q3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import sketch
from skyledger.operators.clean import active_flights, target_airlines
from skyledger.operators.windows import (
    coarser_window,
    event_window,
    label_of,
    last_boundary,
    repeat_to,
    unpack_window,
)
from skyledger.params import JobParams

KEY = ("window_start", "window_end", "airline", "hour")


def delay_bins(cleaned: DataFrame, params: JobParams = JobParams(), window: str = "1d") -> DataFrame:
    """Sketch bins per (window, carrier, hour slot)."""
    return unpack_window(_windowed_bins(cleaned, params, window))


def _windowed_bins(cleaned: DataFrame, params: JobParams, window: str) -> DataFrame:
    rows = target_airlines(active_flights(cleaned), params.carriers)
    return sketch.bin_counts(
        rows, [event_window(window), "airline", F.col("dep_hour").alias("hour")],
        "dep_delay", params.sketch_accuracy,
    )


def merge_delay_bins(bins: DataFrame, window: str) -> DataFrame:
    """Bins of a coarser window from a finer one."""
    return sketch.merge_bins(bins, [*coarser_window(window), "airline", "hour"])


def finish_delays(bins: DataFrame, window_type: str, params: JobParams = JobParams()) -> DataFrame:
    rows = sketch.quantiles(bins, KEY, params.quantiles, params.sketch_accuracy, params.sketch_max_bins)
    return rows.select(
        "window_start", "window_end", F.lit(window_type).alias("window_type"), "airline", "hour",
        "count", "min", *[name for name, _ in params.quantiles], "max",
    )


def delay_distribution(cleaned: DataFrame, window: str, params: JobParams = JobParams()) -> DataFrame:
    """Q3 over tumbling windows of one size."""
    return finish_delays(delay_bins(cleaned, params, window), window, params)


def delay_distribution_stream(cleaned: DataFrame, window: str, params: JobParams = JobParams()) -> DataFrame:
    """Q3 over tumbling windows of a stream: bins first, then a key's finished bins as one list."""
    keys = ("window", "airline", "hour")
    listed = _windowed_bins(cleaned, params, window).groupBy(*keys).agg(*sketch.bin_list())
    rows = sketch.list_quantiles(listed, keys, params.quantiles, params.sketch_accuracy, params.sketch_max_bins)
    return unpack_window(rows).withColumn("window_type", F.lit(window)).select(
        "window_start", "window_end", "window_type", "airline", "hour",
        "count", "min", *[name for name, _ in params.quantiles], "max")


def delay_snapshots(
    bins: DataFrame, params: JobParams = JobParams(), interval_ms: int | None = None, start_ms: int | None = None,
    last: Column | None = None,
) -> DataFrame:
    """Q3 since the start of the data, repeated at every interval boundary (default daily) up to ``last``.

    Counts accumulate per single bin, which spreads one carrier-hour over many tasks; each running
    count is then repeated up to the bin's next change. Without ``last``, the last interval with data is the end.
    """
    interval = interval_ms or params.delay_snapshot_ms
    begin = params.dataset_start_ms if start_ms is None else start_ms
    order = Window.partitionBy("airline", "hour", "bin").orderBy("window_end")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if last is None:
        last = last_boundary(bins, "airline", "hour", "bin", "cnt", "lo", "hi")
    cumulative = bins.select(
        "airline", "hour", "bin", "window_end",
        F.sum("cnt").over(running).alias("cnt"),
        F.min("lo").over(running).alias("lo"),
        F.max("hi").over(running).alias("hi"),
        F.lead("window_end").over(order).alias("next_end"),
    )
    until = F.coalesce(F.col("next_end") - interval, last)
    repeated = repeat_to(cumulative, until, interval, "boundary").select(
        F.lit(begin).cast("long").alias("window_start"), F.col("boundary").alias("window_end"),
        "airline", "hour", "bin", "cnt", "lo", "hi",
    )
    return finish_delays(repeated, "global", params)


def delay_since_start(cleaned: DataFrame, params: JobParams = JobParams(), start_ms: int | None = None) -> DataFrame:
    """Q3 since the start, straight from flights."""
    return delay_snapshots(delay_bins(cleaned, params, label_of(params.delay_snapshot_ms)), params, start_ms=start_ms)
