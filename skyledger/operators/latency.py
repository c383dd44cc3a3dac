"""Ingestion bounds and latency statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import sketch
from skyledger.functions.scalars import is_finite
from skyledger.operators.late import LATENESS_QUANTILES
from skyledger.operators.windows import event_window, unpack_window


def ingest_aggregates(ingest: str = "ingest_ms") -> list[Column]:
    """Newest, oldest, sum and count of ingestion times; times of 0 or less are ignored."""
    t = F.when(F.col(ingest) > 0, F.col(ingest))
    return [
        F.max(t).alias("newest_ingest_ms"),
        F.min(t).alias("oldest_ingest_ms"),
        F.coalesce(F.sum(t), F.lit(0).cast("long")).alias("sum_ingest_ms"),
        F.count(t).alias("ingest_count"),
    ]


def average_ingest() -> Column:
    """Integer division, null without any time."""
    n = F.col("ingest_count")
    whole = (F.col("sum_ingest_ms") - F.pmod(F.col("sum_ingest_ms"), n)) / n
    return F.when(n > 0, whole.cast("long")).alias("avg_ingest_ms")


def ingest_bounds(rows: DataFrame, window: str, *keys: str) -> DataFrame:
    """Ingestion-time bounds per window and key."""
    bounds = unpack_window(rows.groupBy(event_window(window), *keys).agg(*ingest_aggregates()))
    return bounds.withColumn("avg_ingest_ms", average_ingest())


def merge_bounds(bounds: DataFrame, *keys: str) -> DataFrame:
    """Bounds of windows that were summed up in parts."""
    merged = bounds.groupBy("window_start", "window_end", *keys).agg(
        F.max("newest_ingest_ms").alias("newest_ingest_ms"), F.min("oldest_ingest_ms").alias("oldest_ingest_ms"),
        F.sum("sum_ingest_ms").alias("sum_ingest_ms"), F.sum("ingest_count").alias("ingest_count"))
    return merged.withColumn("avg_ingest_ms", average_ingest())


def latencies(bounds: DataFrame, emit_ms: Column, step: str) -> DataFrame:
    """``step, metric, latency_ms``: emission minus newest, oldest and average ingestion, at least 0."""
    pairs = F.array(*[
        F.struct(F.lit(f"e2e_{name}_ms").alias("metric"), F.col(f"{name}_ingest_ms").alias("ingest"))
        for name in ("newest", "oldest", "avg")
    ])
    return (
        bounds.select(emit_ms.alias("emit_ms"), F.explode(pairs).alias("p"))
        .where(F.col("p.ingest") > 0)
        .select(
            F.lit(step).alias("step"),
            F.col("p.metric").alias("metric"),
            F.greatest(F.col("emit_ms") - F.col("p.ingest"), F.lit(0)).cast("double").alias("latency_ms"),
        )
    )


def latency_stats(samples: DataFrame, keys: Sequence[str] = ("step", "metric")) -> DataFrame:
    """p50, p90, p95, p99 and the exact maximum per step and metric; negative and non-finite are skipped."""
    value = F.col("latency_ms")
    kept = samples.where(is_finite(value) & (value >= 0))
    stats = sketch.quantiles(sketch.bin_counts(kept, list(keys), "latency_ms"), keys, LATENESS_QUANTILES)
    return stats.select(*keys, "count", *[n for n, _ in LATENESS_QUANTILES], "max")
