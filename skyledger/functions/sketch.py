"""Relative-error quantile sketch as plain columns.

A value falls into a logarithmic bin; a sketch is the table of bin counts, so adding is counting,
merging is summing, and a quantile is a running sum. The bin edges follow a cubic interpolation of
log2 between powers of two (Masson, Rim, Lee: "DDSketch", VLDB 2019, and its cubic mapping).

A bin is one signed integer that also sorts in value order: negative values get a negative number,
zero gets 0, positive values a positive number.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coefficients of the cubic interpolation.
CUBIC_A = 6.0 / 35.0
CUBIC_B = -3.0 / 5.0
CUBIC_C = 10.0 / 7.0

DEFAULT_ACCURACY = 0.01


# Fixed value: the interpolated logarithm is this far from a logarithm, at worst.
CORRECTION = 7.0 / (10.0 * math.log(2.0))


def _gamma(accuracy: float) -> float:
    return (1.0 + accuracy) / (1.0 - accuracy)


def _step(accuracy: float) -> float:
    """Ratio of neighbouring bins, narrowed so that interpolation keeps the accuracy."""
    return _gamma(accuracy) ** (1.0 / CORRECTION)


def _multiplier(accuracy: float) -> float:
    """Bins per power of two, which is ``0.7 / ln(gamma)``."""
    return math.log(2.0) / math.log(_step(accuracy))


def _kept_accuracy(accuracy: float) -> float:
    """The accuracy after both roundings above, so that bin values agree to the last digits."""
    return 1.0 - 2.0 / (1.0 + _step(accuracy) ** CORRECTION)


def _offset(accuracy: float) -> int:
    """Shift that makes every index of a finite double positive."""
    return math.ceil(_multiplier(accuracy) * 1100) + 1


def bin_of(value: str, accuracy: float = DEFAULT_ACCURACY) -> Column:
    """Signed bin of a finite value; null for null, NaN and infinities.

    Takes SQL text of a double: the formula is one parsed expression instead of dozens of driver calls. The index stands
    outside of any condition, as only there Spark works out its repeated parts once; other values stand in as 1.
    """
    smallest = sys.float_info.min * _gamma(accuracy)
    odd = f"({value} IS NULL OR isnan({value}) OR abs({value}) = double('Infinity'))"
    size = f"if({odd} OR abs({value}) <= {smallest!r}D, 1D, abs({value}))"
    guess = f"int(floor(log2({size})))"
    # log2 is a ratio of logarithms and may be one off at powers of two.
    exponent = (
        f"({guess} - if(power(2D, {guess}) > {size}, 1, 0) + if(power(2D, {guess} + 1) <= {size}, 1, 0))"
    )
    s = f"({size} / power(2D, {exponent}) - 1D)"
    level = f"({exponent} + (({CUBIC_A!r}D * {s} + {CUBIC_B!r}D) * {s} + {CUBIC_C!r}D) * {s})"
    index = f"(int(floor({_multiplier(accuracy)!r}D * {level})) + {_offset(accuracy)})"
    sign = f"CASE WHEN {odd} THEN NULL WHEN abs({value}) <= {smallest!r}D THEN 0 WHEN {value} > 0 THEN 1 ELSE -1 END"
    return F.expr(f"{index} * {sign}")


def bin_value(bin_: str, accuracy: float = DEFAULT_ACCURACY) -> Column:
    """Value that stands for a bin, within ``accuracy`` of everything that fell into it."""
    y = f"((abs({bin_}) - {_offset(accuracy)}) / {_multiplier(accuracy)!r}D)"
    whole = f"floor({y})"
    d0 = CUBIC_B * CUBIC_B - 3.0 * CUBIC_A * CUBIC_C
    d1_whole = 2.0 * CUBIC_B ** 3 - 9.0 * CUBIC_A * CUBIC_B * CUBIC_C
    d1 = f"({d1_whole!r}D - {27.0 * CUBIC_A * CUBIC_A!r}D * ({y} - {whole}))"
    p = f"cbrt(({d1} - sqrt({d1} * {d1} - {4.0 * d0 ** 3!r}D)) / 2D)"
    significand = f"(1D - ({CUBIC_B!r}D + {p} + {d0!r}D / {p}) / {3.0 * CUBIC_A!r}D)"
    size = f"power(2D, {whole}) * {significand} * {1.0 + _kept_accuracy(accuracy)!r}D"
    return F.expr(f"CASE WHEN {bin_} = 0 THEN 0D WHEN {bin_} > 0 THEN {size} WHEN {bin_} < 0 THEN -{size} END")


def bin_counts(
    df: DataFrame, keys: Sequence[str | Column], value: str, accuracy: float = DEFAULT_ACCURACY,
    weight: str = "1",
) -> DataFrame:
    """Sketch table: one row per (keys, bin) with ``cnt`` and the exact ``lo`` and ``hi``.

    Partial aggregation runs before the exchange, so a key that holds most of the rows still sends at
    most one row per bin and map task. Non-finite values leave a row with a null bin and count 0, so
    their key stays visible.
    """
    counted = df.groupBy(*keys, bin_of(value, accuracy).alias("bin")).agg(
        F.expr(f"sum(bigint({weight})) AS cnt"), F.expr(f"min({value}) AS lo"), F.expr(f"max({value}) AS hi")
    )
    return counted.withColumns({
        "cnt": F.expr("if(bin IS NULL, 0L, cnt)"),
        "lo": F.expr("if(bin IS NULL, NULL, lo)"),
        "hi": F.expr("if(bin IS NULL, NULL, hi)"),
    })


def merge_bins(bins: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Union of sketches under coarser keys: counts add, bounds widen. No rows are revisited."""
    return bins.groupBy(*keys, "bin").agg(
        F.sum("cnt").alias("cnt"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def quantiles(
    bins: DataFrame, keys: Sequence[str], probabilities: Sequence[tuple[str, float]],
    accuracy: float = DEFAULT_ACCURACY, max_bins: int = 2048,
) -> DataFrame:
    """``keys, count, min, <quantiles>, max`` per key, 0.0 everywhere for a key without finite values.

    Bins below the ``max_bins`` highest of each sign are folded into the lowest kept one. A window
    over at most ``2 * max_bins + 1`` folded bins per key gives the running counts; the closing
    group-by reuses its partitioning.
    """
    for _, q in probabilities:
        if not 0.0 <= q <= 1.0:
            raise ValueError("quantile must be between 0.0 and 1.0")
    key = ", ".join(keys)
    total = f"OVER (PARTITION BY {key})"
    running = bins.selectExpr(
        *keys, "cnt", "lo", "hi",
        f"""CASE WHEN bin > 0 THEN greatest(bin, max(bin) {total} - {max_bins - 1})
                 WHEN bin < 0 THEN least(bin, min(bin) {total} + {max_bins - 1}) ELSE bin END AS folded""",
        f"sum(cnt) {total} AS total",
    ).selectExpr(
        "*",
        f"sum(cnt) OVER (PARTITION BY {key} ORDER BY folded ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen",
    )
    per_key = running.groupBy(*keys).agg(
        F.expr("sum(cnt) AS count"), F.expr("coalesce(min(lo), 0D) AS min"), F.expr("coalesce(max(hi), 0D) AS max"),
        *[F.expr(f"min(if(seen > {q}D * (total - 1), folded, NULL)) AS {name}") for name, q in probabilities],
    )
    return per_key.select(
        *keys, "count", "min",
        *[F.coalesce(bin_value(name, accuracy), F.lit(0.0)).alias(name) for name, _ in probabilities],
        "max",
    )


def bin_list() -> list[Column]:
    """Aggregates that gather the bins of a key into one ordered list, for where no window function is allowed.

    A double has a bin for each factor of ``1 + 2 * accuracy`` in its range, so the list has a bound.
    """
    listed = F.sort_array(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "cnt"))))
    return [listed.alias("bins"), F.sum("cnt").alias("count"), F.min("lo").alias("min"), F.max("hi").alias("max")]


def list_quantiles(
    listed: DataFrame, keys: Sequence[str], probabilities: Sequence[tuple[str, float]],
    accuracy: float = DEFAULT_ACCURACY, max_bins: int = 2048,
) -> DataFrame:
    """What ``quantiles`` gives, from the lists of ``bin_list``, in expressions over a single row."""
    for _, q in probabilities:
        if not 0.0 <= q <= 1.0:
            raise ValueError("quantile must be between 0.0 and 1.0")
    found = listed.select("*", *[
        F.expr(f"""aggregate(bins, named_struct('seen', 0L, 'hit', CAST(NULL AS INT)), (a, x) -> named_struct(
            'seen', a.seen + x.cnt, 'hit', coalesce(a.hit, if(a.seen + x.cnt > {q}D * (count - 1), x.bin, NULL))),
            a -> a.hit)""").alias(name)
        for name, q in probabilities])
    folded = found.select(*keys, "count", "min", "max", *[
        F.expr(f"""CASE WHEN {name} > 0 THEN greatest({name}, bins[size(bins) - 1].bin - {max_bins - 1})
                        WHEN {name} < 0 THEN least({name}, bins[0].bin + {max_bins - 1}) ELSE {name} END""").alias(name)
        for name, _ in probabilities])
    return folded.select(
        *keys, "count", F.coalesce("min", F.lit(0.0)).alias("min"),
        *[F.coalesce(bin_value(name, accuracy), F.lit(0.0)).alias(name) for name, _ in probabilities],
        F.coalesce("max", F.lit(0.0)).alias("max"))
