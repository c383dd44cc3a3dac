"""Tumbling event-time windows, aligned to the epoch."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.params import DAY_MS, HOUR_MS

_LABEL = re.compile(r"([1-9][0-9]*)([hd])")


def window_ms(label: str) -> int:
    """Milliseconds of a label such as ``1h``, ``6h``, ``7d``: any number of whole hours or days."""
    parts = _LABEL.fullmatch(label)
    if not parts:
        raise ValueError(f"'{label}' is not a number of hours or days, such as 6h or 7d")
    return int(parts[1]) * (HOUR_MS if parts[2] == "h" else DAY_MS)


def label_of(size_ms: int) -> str:
    """Label of a window of whole hours."""
    if size_ms <= 0 or size_ms % HOUR_MS:
        raise ValueError(f"{size_ms} ms is not a number of whole hours")
    return f"{size_ms // DAY_MS}d" if size_ms % DAY_MS == 0 else f"{size_ms // HOUR_MS}h"


def event_window(label: str, time: str = "event_ts") -> Column:
    """Works the same on a batch and behind a watermark. Seven-day windows start on Thursdays."""
    return F.window(time, f"{window_ms(label)} milliseconds").alias("window")


def end_of_window(ms: Column, size_ms: int) -> Column:
    """End of the window that holds an epoch millisecond."""
    return ms - F.pmod(ms, F.lit(size_ms).cast("long")) + size_ms


def unpack_window(df: DataFrame) -> DataFrame:
    """Replaces the window struct by epoch-millisecond bounds."""
    others = [c for c in df.columns if c != "window"]
    return df.select(
        F.unix_millis("window.start").alias("window_start"),
        F.unix_millis("window.end").alias("window_end"),
        *others,
    )


def coarser_window(label: str) -> tuple[Column, Column]:
    """Bounds of the window that holds ``window_start`` of a finer one."""
    size = window_ms(label)
    start = F.col("window_start") - F.pmod(F.col("window_start"), F.lit(size).cast("long"))
    return start.alias("window_start"), (start + size).alias("window_end")


def last_boundary(partials: DataFrame, *columns: str) -> Column:
    """Largest ``window_end``, as a scalar subquery.

    Carrying the other columns along keeps the subquery's exchange equal to the main query's, so the
    aggregated partials are reused; a bare maximum would be pruned to another plan and scan flights again.
    """
    return partials.select(F.max(F.struct("window_end", *columns))).scalar()["window_end"]


# Boundaries generated at once; one array never holds more.
_STRIDE = 1024


def repeat_to(df: DataFrame, until: Column, interval_ms: int, name: str) -> DataFrame:
    """Each row once for every boundary from its ``window_end`` to ``until``, both included.

    The boundaries are made in two steps, strides and then steps, so an array stays short even over a silence of
    thousands of years.
    """
    steps = ((until - F.col("window_end")) / interval_ms).cast("long")
    strides = df.withColumn("steps_left", steps).withColumn(
        "stride", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("steps_left") / _STRIDE))))
    begin = F.col("stride") * _STRIDE
    each = strides.withColumn(
        "step", F.explode(F.sequence(begin, F.least(begin + _STRIDE - 1, F.col("steps_left")))))
    return each.withColumn(name, F.col("window_end") + F.col("step") * interval_ms).drop("steps_left", "stride", "step")
