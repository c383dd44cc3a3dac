"""All seven results from one set of flights, which is read and cleaned once."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import airports, carrier, delays
from skyledger.operators.clean import clean
from skyledger.params import HOUR_MS, JobParams

_NARROW = (
    "airline", "origin_airport_id", "dest_airport_id", "dep_delay", "is_cancelled", "is_diverted", "dep_hour", "event_ts",
)
RESULTS = ("q1", "q2_1h", "q2_6h", "q2_global", "q3_1d", "q3_7d", "q3_global")


def run_batch(
    spark: SparkSession, flights: DataFrame, work_dir: str, out_dir: str, params: JobParams = JobParams(),
    start_ms: int | None = None,
) -> dict[str, DataFrame]:
    """Writes every result under ``out_dir`` and returns them as tables.

    The source is read once: clean flights are written with the columns that the results need, as a source such as CSV
    costs far more to read than they do. They are reduced to hourly airport partials, hourly worst flights and daily sketch bins. These
    small tables are written to ``work_dir`` (a folder all executors can reach), so a lost executor
    costs no second pass over the flights, and their true sizes let the planner choose broadcasts.
    The writes of one wave do not depend on each other and run side by side.
    """
    clean(flights).select(*_NARROW).write.mode("overwrite").parquet(f"{work_dir}/clean")
    cleaned = spark.read.parquet(f"{work_dir}/clean")

    def write_all(plans: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
        def write(item: tuple[str, tuple[DataFrame, str]]) -> None:
            name, (rows, base) = item
            rows.write.mode("overwrite").parquet(f"{base}/{name}")

        with ThreadPoolExecutor(max_workers=len(plans)) as pool:
            list(pool.map(write, plans.items()))
        return {name: spark.read.parquet(f"{base}/{name}") for name, (_, base) in plans.items()}

    first = write_all({
        "q1": (carrier.carrier_performance(cleaned, params), out_dir),
        "airport_partials": (airports.airport_partials(cleaned, params, "1h"), work_dir),
        "worst_flights": (airports.worst_flights(cleaned, params, "1h"), work_dir),
        "delay_bins": (delays.delay_bins(cleaned, params, "1d"), work_dir),
    })
    partials, lists, bins = first["airport_partials"], first["worst_flights"], first["delay_bins"]
    span = partials.agg((F.max("window_end") - F.min("window_end")).alias("ms")).first().ms
    intervals = (span or 0) // HOUR_MS + 1
    hourly = airports.rank_airports(airports.airport_stats(partials, params.min_flights), params.top_airports)
    second = write_all({
        "q2_1h": (airports.airport_result(hourly, lists, "1h"), out_dir),
        "q2_6h": (airports.airport_ranking_from_partials(partials, lists, "6h", params), out_dir),
        "q2_global": (airports.airport_snapshots(
            partials, lists, params, start_ms=start_ms, intervals=intervals), out_dir),
        "q3_1d": (delays.finish_delays(bins, "1d", params), out_dir),
        "q3_7d": (delays.finish_delays(delays.merge_delay_bins(bins, "7d"), "7d", params), out_dir),
        "q3_global": (delays.delay_snapshots(bins, params, start_ms=start_ms), out_dir),
    })
    return {name: (first | second)[name] for name in RESULTS}
