"""CSV exports of result tables, and run statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.scalars import delayed_flight_text, format_ms
from skyledger.params import HOUR_MS
from skyledger.schema import DELAYED_FLIGHTS

Q1_COLUMNS = (
    "window_start", "window_end", "airline", "num_flights", "completed", "cancelled", "diverted",
    "dep_delay_mean", "cancellation_rate", "late_departure_rate",
)
Q2_COLUMNS = (
    "ts", "rank", "origin_airport_id", "num_flights", "severe_delays", "dep_delay_mean", "dep_delay_max",
    "delayed_flights",
)
Q3_COLUMNS = ("ts", "airline", "hour", "count", "min", "p25", "p50", "p75", "p90", "max")


def _present(df: DataFrame, names: Sequence[str], default: Column) -> DataFrame:
    """The named columns in order; a missing one gets the default."""
    return df.select(*[F.col(n) if n in df.columns else default.alias(n) for n in names])


def export_q1(results: DataFrame) -> DataFrame:
    """Text bounds; the end is taken as start plus one hour."""
    return _present(
        results.withColumns({
            "window_end": format_ms(F.col("window_start") + HOUR_MS),
            "window_start": format_ms(F.col("window_start")),
        }),
        Q1_COLUMNS, F.lit(0),
    )


def flights_text(flights: Column) -> Column:
    """``[(AA,13303,1766.00), ...]``, ``[]`` for none."""
    items = F.transform(
        F.coalesce(flights, F.array().cast(DELAYED_FLIGHTS)),
        lambda f: delayed_flight_text(
            F.coalesce(f["carrier"], F.lit("")), F.coalesce(f["dest"], F.lit("")),
            F.coalesce(f["dep_delay"], F.lit(0.0)), 2,
        ),
    )
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def export_q2(results: DataFrame) -> DataFrame:
    """Ordered by time, then by rank as text (1, 10, 2, ...): rank is a text tag in the result table."""
    rows = results.withColumns({
        "ts": format_ms(F.col("window_start")),
        "rank": F.col("rank").cast("string"),
        "delayed_flights": flights_text(F.col("delayed_flights")),
    })
    return _present(rows, Q2_COLUMNS, F.lit("")).orderBy("ts", "rank")


def export_q3(results: DataFrame) -> DataFrame:
    """Ordered by time, hour as a number, carrier."""
    rows = results.withColumns({"ts": format_ms(F.col("window_start")), "hour": F.col("hour").cast("int")})
    return _present(rows, Q3_COLUMNS, F.lit(0)).orderBy("ts", "hour", "airline")


def write_csv(rows: DataFrame, path: str) -> None:
    """A folder of CSV parts, each with a header. Values hold no line breaks."""
    rows.write.mode("overwrite").option("header", "true").csv(path)


def write_q2_csv(rows: DataFrame, path: str) -> None:
    """Like ``write_csv``, but the flight list stays unquoted although it holds commas.

    Each line is built as one text column named by the whole header line. With a tab as separator the
    writer finds nothing to quote.
    """
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns])
    whole = rows.select(line.alias(",".join(rows.columns)))
    whole.write.mode("overwrite").option("header", "true").option("sep", "\t").csv(path)


def run_stats(runs: DataFrame, values: Sequence[str], code: str = "code") -> DataFrame:
    """Mean and sample deviation over runs; the code holds a scenario letter and the parallelism."""
    trimmed = F.trim(code)
    aggregates = []
    for v in values:
        aggregates.append(F.avg(v).alias(f"{v}_mean"))
        # One run has no deviation.
        aggregates.append(F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias(f"{v}_std"))
    return (
        runs.where(F.col(code).isNotNull())
        .groupBy(
            F.substring(trimmed, 1, 1).alias("scenario"),
            trimmed.substr(F.lit(2), F.length(trimmed)).alias("parallelism"),
        )
        .agg(*aggregates)
    )
