"""Every operator as a named query over the given tables (the flights view of the event log)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import scalars, sketch
from skyledger.operators import airports, carrier, delays, late, latency
from skyledger.operators import clean as cleaning
from skyledger.operators.windows import last_boundary
from skyledger.params import JobParams
from skyledger.schema import Q1_RESULT, SOURCE_FIELDS
from skyledger.session import drop_folder, scratch_dir
from skyledger.sinks import decode, encode, export, result_table
from skyledger.sources.csv_scan import first_by_event_time, read_ontime_csv
from skyledger.sources.flights_view import flights_from_events, read_events, stream_events
from skyledger.sources.json_events import decode_flights, encode_source
from skyledger.sources.streams import parquet_stream
from skyledger.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# The event log starts here, so "since the start" does.
LOG_START_MS = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
PARAMS = JobParams(dataset_start_ms=LOG_START_MS)
# The log is thinner than real traffic: few airports reach 30 flights in a short window.
PARAMS_1H = replace(PARAMS, min_flights=2)
PARAMS_6H = replace(PARAMS, min_flights=5)

LATE_SETTINGS = ((30, 0), (5, 25), (10, 0), (0, 0))
FIRST_N = 500


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_events(read_events(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(_flights(spark, sf_dir))


def _stable(value: Column | str) -> Column:
    """Sketch values to six decimals: engines differ in the last bit of a cube root."""
    return scalars.round_half_up(F.col(value) if isinstance(value, str) else value, 6)


def _stable_quantiles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: _stable(n) for n in names})


def _list_as_json(df: DataFrame) -> DataFrame:
    return df.withColumn("delayed_flights", F.to_json("delayed_flights"))


# --- cleaning and scalars ---------------------------------------------------------------------------


def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.with_event_time(_flights(spark, sf_dir)).select(
        "event_id", "crs_dep_time", F.unix_millis("event_ts").alias("event_ms"), "dep_hour"
    )


_CLEAN_COLUMNS = (
    "event_id", "year", "month", "day_of_month", "airline", "crs_dep_time", "dep_delay", "is_cancelled",
    "is_diverted", "origin_airport_id", "dest_airport_id", "event_ms", "dep_hour",
)


def clean_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select(*_CLEAN_COLUMNS)


def rejects_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rejects_by_rule(_flights(spark, sf_dir))


def active_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.active_flights(_clean(spark, sf_dir)).select("event_id", "airline", "origin_airport_id", "dep_delay")


def target_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.target_airlines(_clean(spark, sf_dir), PARAMS.carriers)
    return rows.select("event_id", "airline", "is_cancelled", "is_diverted", "dep_delay")


def global_avg_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.global_average_delay(_clean(spark, sf_dir))


def round_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Eighths hit exact halves at two decimals; the shift gives negative ones.
    value = F.floor("value") / 8.0 - 4.0
    return read_events(spark, sf_dir).select(
        "event_id",
        scalars.round_half_up(value).alias("two_decimals"),
        scalars.round_half_up(value, 1).alias("one_decimal"),
        scalars.round_half_up(value, 0).alias("whole"),
    )


def safe_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    num, den = F.floor("value"), F.col("user_id") - 75
    return read_events(spark, sf_dir).select(
        "event_id",
        scalars.safe_divide(num, den).alias("ratio"),
        scalars.safe_divide_rounded(num, den).alias("ratio_rounded"),
        scalars.safe_percent(num, den).alias("percent"),
    )


def ts_format_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = cleaning.with_event_time(_flights(spark, sf_dir))
    text = scalars.format_ms(F.unix_millis("event_ts"))
    return flights.select(
        "event_id", text.alias("event_text"), scalars.parse_ms(text).alias("parsed_ms"),
        scalars.window_start_ms(scalars.parse_ms(text), 3_600_000).alias("hour_start_ms"),
    )


# --- the three questions ------------------------------------------------------------------------------


def q1_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carrier.carrier_performance(_clean(spark, sf_dir), PARAMS)


def q2_airport_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airports.airport_stats(airports.airport_partials(_clean(spark, sf_dir), PARAMS_1H, "1h"), PARAMS_1H.min_flights)


def q2_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    worst = airports.worst_flights(_clean(spark, sf_dir), PARAMS, "6h")
    return _list_as_json(worst.select(*airports.KEY, airports.published_list(F.col("worst")).alias("delayed_flights")))


def q2_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _list_as_json(airports.airport_ranking(_clean(spark, sf_dir), "1h", PARAMS_1H))


def q2_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _list_as_json(airports.airport_ranking(_clean(spark, sf_dir), "6h", PARAMS_6H))


def q2_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _list_as_json(airports.airport_since_start(
        _clean(spark, sf_dir), PARAMS, work_dir=scratch_dir(spark, "q2_global")))


_QUANTILES = tuple(name for name, _ in PARAMS.quantiles)


def q3_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stable_quantiles(delays.delay_distribution(_clean(spark, sf_dir), "1d", PARAMS), *_QUANTILES)


def q3_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stable_quantiles(delays.delay_distribution(_clean(spark, sf_dir), "7d", PARAMS), *_QUANTILES)


def q3_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stable_quantiles(delays.delay_since_start(_clean(spark, sf_dir), PARAMS), *_QUANTILES)


def ddsketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unrounded values of both signs per event type."""
    bins = sketch.bin_counts(read_events(spark, sf_dir), ["event_type"], "(value - 15)")
    probabilities = (("p01", 0.01), ("p25", 0.25), ("p50", 0.50), ("p90", 0.90), ("p99", 0.99))
    rows = sketch.quantiles(bins, ["event_type"], probabilities)
    return _stable_quantiles(rows, *[n for n, _ in probabilities])


def ddsketch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly distributions from merged daily sketches."""
    daily = delays.delay_bins(_clean(spark, sf_dir), PARAMS, "1d")
    return _stable_quantiles(delays.finish_delays(delays.merge_delay_bins(daily, "7d"), "7d", PARAMS), *_QUANTILES)


def merge_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour airport results from merged hourly partials and lists."""
    cleaned = _clean(spark, sf_dir)
    hourly = airports.airport_partials(cleaned, PARAMS_6H, "1h")
    lists = airports.worst_flights(cleaned, PARAMS_6H, "1h")
    return _list_as_json(airports.airport_ranking_from_partials(hourly, lists, "6h", PARAMS_6H))


def merge_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily carrier performance from merged hourly counters."""
    hourly = carrier.unpack_window(carrier.carrier_partials(_clean(spark, sf_dir), PARAMS))
    return carrier.finish_carrier(carrier.merge_carrier_partials(hourly, "1d"))


# --- cuts and gaps that the log itself does not reach -------------------------------------------------


def q2_1h_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = replace(PARAMS_1H, top_airports=3, top_flights=3)
    return _list_as_json(airports.airport_ranking(_clean(spark, sf_dir), "1h", params))


def q2_6h_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = replace(PARAMS_6H, top_airports=3, top_flights=3)
    return _list_as_json(airports.airport_ranking(_clean(spark, sf_dir), "6h", params))


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with null carriers, airports, times and years."""
    holes = {"airline": 59, "origin_airport_id": 61, "dest_airport_id": 67, "crs_dep_time": 71, "year": 73}
    return _flights(spark, sf_dir).withColumns({
        name: F.when(F.col("event_id") % every != 0, F.col(name)) for name, every in holes.items()})


def rejects_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rejects_by_rule(_with_gaps(spark, sf_dir))


def clean_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(_with_gaps(spark, sf_dir)).select("event_id", "event_ms", "airline")


def q3_7d_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some delays are no number, some very large."""
    delay = F.when(F.col("event_id") % 13 == 0, F.lit(float("nan"))).when(
        F.col("event_id") % 47 == 0, F.col("dep_delay") * 100_000).otherwise(F.col("dep_delay"))
    rows = _flights(spark, sf_dir).withColumn("dep_delay", delay)
    return _stable_quantiles(delays.delay_distribution(cleaning.clean(rows), "7d", PARAMS), *_QUANTILES)


# --- late data and latency ------------------------------------------------------------------------------


def disorder_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.with_event_time(_flights(spark, sf_dir)).where("event_ts IS NOT NULL").select(
        "event_id", F.unix_millis("event_ts").alias("event_ms"), "publish_ms"
    )


def _watermarks(flights: DataFrame) -> DataFrame:
    """From every row with a valid time: the watermark belongs to the source, not to a query."""
    timed = cleaning.with_event_time(flights).withColumn("event_ms", F.unix_millis("event_ts"))
    return late.arrival_watermarks(timed)


def late_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = _flights(spark, sf_dir)
    return late.late_report(cleaning.clean(flights), _watermarks(flights), PARAMS.carriers, LATE_SETTINGS)


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = _flights(spark, sf_dir)
    rows = cleaning.active_flights(cleaning.clean(flights))
    lost = late.late_rows(rows, _watermarks(flights), "1h", 10, 0, scratch_dir(spark, "late_rows"))
    return lost.select("event_id", "event_ms", "publish_ms", "window_end", _stable("lateness_min").alias("lateness_min"))


def lateness_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = _flights(spark, sf_dir)
    rows = cleaning.active_flights(cleaning.clean(flights))
    stats = late.lateness_stats(rows, _watermarks(flights), "1h", 0, 0)
    return _stable_quantiles(stats, *[f"lateness_{n}" for n, _ in late.LATENESS_QUANTILES])


def ingest_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.ingest_bounds(cleaning.target_airlines(_clean(spark, sf_dir), PARAMS.carriers), "1h", "airline")


def ingest_bounds_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.ingest_bounds(cleaning.active_flights(_clean(spark, sf_dir)), "1h", "origin_airport_id")


def ingest_bounds_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.target_airlines(cleaning.active_flights(_clean(spark, sf_dir)), PARAMS.carriers)
    return latency.ingest_bounds(rows.withColumnRenamed("dep_hour", "hour"), "1d", "airline", "hour")


def latency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency of Q1 windows, taking emission as the moment a 30-minute watermark closes the window."""
    samples = latency.latencies(ingest_bounds(spark, sf_dir), F.col("window_end") + 30 * 60_000, "q1_window")
    return _stable_quantiles(latency.latency_stats(samples), *[n for n, _ in late.LATENESS_QUANTILES])


# --- sources ------------------------------------------------------------------------------------------


def _source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as a 27-column source row plus ``event_id``; the flight number carries the event id."""
    known = {
        "YEAR": F.col("year"), "MONTH": F.col("month"), "DAY_OF_MONTH": F.col("day_of_month"),
        "OP_UNIQUE_CARRIER": F.col("airline"), "OP_CARRIER_FL_NUM": F.col("event_id").cast("string"),
        "ORIGIN_AIRPORT_ID": F.col("origin_airport_id"), "DEST_AIRPORT_ID": F.col("dest_airport_id"),
        "CRS_DEP_TIME": F.col("crs_dep_time"), "DEP_DELAY": F.col("dep_delay"),
        "CANCELLED": F.col("cancelled"), "DIVERTED": F.col("diverted"),
        "DISTANCE": (F.col("event_id") % 3000).cast("double"),
    }
    kinds = {"int": "int", "double": "double", "string": "string"}
    return _flights(spark, sf_dir).select(
        "event_id",
        *[known.get(n, F.lit(None)).cast(kinds[k]).alias(n) for n, k in SOURCE_FIELDS.items()],
    )


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the view as on-time CSV text with broken rows in it, and scans that."""
    eid = F.col("event_id")
    rows = _source_rows(spark, sf_dir)
    cells = {n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in SOURCE_FIELDS}
    # Integers as decimals, a year with text behind it, an unreadable month, a blank scheduled time, and short lines.
    cells["CRS_DEP_TIME"] = F.when(eid % 43 == 0, F.lit("")).otherwise(
        F.col("CRS_DEP_TIME").cast("double").cast("string")
    )
    cells["YEAR"] = F.when(eid % 41 == 0, F.lit("20x4")).otherwise(F.col("YEAR").cast("string"))
    cells["MONTH"] = F.when(eid % 53 == 0, F.lit("Jan")).otherwise(F.col("MONTH").cast("string"))
    line = F.when(eid % 37 == 0, F.lit("2024,1,1")).otherwise(F.concat_ws(",", *cells.values()))
    path = scratch_dir(spark, "scan_csv")
    header = ",".join(f" {n.lower()}" if n == "MONTH" else n for n in SOURCE_FIELDS)
    rows.select(line.alias(header)).write.option("header", "true").option("sep", "\t").csv(path)
    scanned = read_ontime_csv(spark, path, "*.csv")
    return scanned.select(*[
        F.col(n).alias(n.lower()) for n in (
            "YEAR", "MONTH", "DAY_OF_MONTH", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN_AIRPORT_ID",
            "DEST_AIRPORT_ID", "CRS_DEP_TIME", "DEP_DELAY", "CANCELLED", "DIVERTED", "DISTANCE", "ORIGIN_STATE_ABR",
        )
    ])


def first_n_by_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = first_by_event_time(_flights(spark, sf_dir), FIRST_N, "event_id")
    return rows.select("event_id", "replay_ms", "airline", "crs_dep_time")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as JSON messages, some of them broken, null or unreadable."""
    eid = F.col("event_id")
    good = encode_source(_source_rows(spark, sf_dir), "event_id")
    return good.withColumn(
        "value",
        F.when(eid % 23 == 0, F.col("value").substr(1, 40))
        .when(eid % 29 == 0, F.lit(None))
        .when(eid % 31 == 0, F.regexp_replace("value", '"MONTH":[0-9]+', '"MONTH":"Jan"'))
        .otherwise(F.col("value")),
    )


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_flights(_messages(spark, sf_dir), "value", F.lit(1), "event_id")
    return cleaning.with_event_time(decoded).select(
        "event_id", "year", "month", "day_of_month", "airline", "crs_dep_time", "dep_delay", "cancelled",
        "diverted", "origin_airport_id", "dest_airport_id", F.unix_millis("event_ts").alias("event_ms"),
    )


# --- results ------------------------------------------------------------------------------------------


def _q2_6h_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airports.airport_ranking(_clean(spark, sf_dir), "6h", PARAMS_6H)


def encode_q3_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distributions as messages without a key; quantiles rounded, as engines differ in their last bit."""
    return encode.encode_q3(q3_1d(spark, sf_dir))


def encode_results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    q1 = encode.encode_q1(q1_1h(spark, sf_dir)).withColumn("query", F.lit("q1"))
    q2 = encode.encode_q2(_q2_6h_rows(spark, sf_dir)).withColumn("query", F.lit("q2_6h"))
    return q1.unionByName(q2).select("query", "key", "value")


def plain_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The average delay as one text message."""
    return encode.as_plain_text(global_avg_delay(spark, sf_dir).select(scalars.round_half_up(F.col("avg_delay")).alias("v")), "v")


def typed_decode_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.decode_q2(encode.encode_q2(_q2_6h_rows(spark, sf_dir)))
    return decoded.withColumn("time_ms", F.unix_millis("time")).drop("time")


def lww_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 results written three times: all rows, two carriers again, one carrier's even hours again."""
    path = scratch_dir(spark, "lww_upsert")
    results = q1_1h(spark, sf_dir)
    keys = result_table.RESULT_KEYS["q1"]
    result_table.upsert(results, path, 0, keys)
    first = result_table.read_results(spark, path, Q1_RESULT)

    def scaled(rows: DataFrame, by: int) -> DataFrame:
        return rows.withColumn("num_flights", (F.col("num_flights") * by).cast("long"))

    two = scaled(first.where(F.col("airline").isin("AA", "UA")), 10)
    even = (F.col("airline") == "AA") & (F.col("window_start") % (2 * 3_600_000) == 0)
    # Taken from the first version, before the table changes under it.
    result_table.write_batch(scaled(first.where(even), 100), f"{path}/third", 2)
    third = spark.read.schema(Q1_RESULT).parquet(f"{path}/third/batch_id=2")
    result_table.upsert(two, path, 1, keys)
    result_table.upsert(third, path, 2, keys)
    # A replayed batch changes nothing.
    result_table.upsert(third, path, 2, keys)
    return result_table.read_results(spark, path, Q1_RESULT)


_Q1_FIELDS = (
    "num_flights", "completed", "cancelled", "diverted", "dep_delay_mean", "cancellation_rate", "late_departure_rate",
)


def pivot_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("window_start", "airline")
    points = decode.unpivot_fields(q1_1h(spark, sf_dir), keys, _Q1_FIELDS)
    return decode.pivot_fields(points, keys, _Q1_FIELDS)


def export_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.export_q1(q1_1h(spark, sf_dir))


def export_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.export_q2(_q2_6h_rows(spark, sf_dir))


def export_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.export_q3(q3_7d(spark, sf_dir))


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs made of the log: one per day, scenario letter and parallelism."""
    letter = F.substring(F.lit("SMF"), (F.col("user_id") % 3 + 1).cast("int"), F.lit(1))
    level = F.substring(F.lit("136"), (F.col("event_id") % 3 + 1).cast("int"), F.lit(1))
    runs = read_events(spark, sf_dir).groupBy(
        F.concat(letter, level).alias("code"), F.dayofmonth("ts").alias("run")
    ).agg(F.count(F.lit(1)).cast("double").alias("rows_in"), F.sum(F.floor("value")).cast("double").alias("value_sum"))
    stats = export.run_stats(runs, ("rows_in", "value_sum"))
    return _stable_quantiles(stats, "rows_in_mean", "rows_in_std", "value_sum_mean", "value_sum_std")


# --- streams ------------------------------------------------------------------------------------------

# Grace 30 minutes: what the log's disorder needs, so nothing is lost.
STREAM_PARAMS = replace(PARAMS, watermark_delay=5, allowed_lateness=25)
# Too little for it: some rows are lost.
TIGHT_PARAMS = replace(PARAMS, watermark_delay=10, allowed_lateness=0)
# The log in arrival order, cut at these days of the month.
ARRIVAL_CUTS = (8, 16, 24)


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_events(stream_events(spark, sf_dir))


def sized(spark: SparkSession, sf_dir: str, params: JobParams) -> JobParams:
    """A state task for each split of the log, two at least."""
    return replace(params, state_partitions=max(2, read_events(spark, sf_dir).rdd.getNumPartitions()))


def _drained(stream: jobs.RunningStream, path: str, name: str) -> DataFrame:
    stream.finish()
    return jobs.read_stream_results(stream.spark, path, name)


def _arrivals(spark: SparkSession, sf_dir: str, path: str, slower: int = 1) -> tuple[str, T.StructType]:
    """Writes the log once, cut by arrival day into one folder per part; returns the folder and the schema.

    ``slower`` stretches the arrival delays, so that late rows cross a cut.
    """
    flights = cleaning.with_event_time(_flights(spark, sf_dir)).where("publish_ms IS NOT NULL")
    delay = F.col("publish_ms") - F.unix_millis("event_ts")
    flights = flights.withColumn("publish_ms", F.col("publish_ms") + delay * (slower - 1)).drop("event_ts", "dep_hour")
    day = F.floor((F.col("publish_ms") - LOG_START_MS) / 86_400_000)
    part = sum(((day >= cut).cast("int") for cut in ARRIVAL_CUTS), F.lit(0))
    flights.withColumn("part", part).write.partitionBy("part").parquet(f"{path}/arrivals")
    return f"{path}/arrivals", flights.schema


def _in_arrival_parts(
    spark: SparkSession, sf_dir: str, path: str, run: Callable[[DataFrame], jobs.RunningStream], slower: int = 1
) -> None:
    """Feeds the log in arrival order, a part at a time; the query is stopped and restarted in between."""
    folder, schema = _arrivals(spark, sf_dir, path, slower)
    for part in range(len(ARRIVAL_CUTS) + 1):
        # The folders up to this part; files of earlier ones are in the checkpoint already.
        stream = run(parquet_stream(spark, f"{folder}/part=[0-{part}]", schema))
        stream.awaitTermination()
    stream.finish()
    drop_folder(spark, folder)


def stream_q1_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stream_q1_1h")
    return _drained(jobs.start_q1(_stream(spark, sf_dir), path, sized(spark, sf_dir, STREAM_PARAMS)), path, "q1")


def _corrected(spark: SparkSession, sf_dir: str, name: str, run: Callable) -> DataFrame:
    """A result over four arrival parts with enough allowed lateness: early rows, corrected by later ones."""
    path = scratch_dir(spark, f"stream_{name}")
    _in_arrival_parts(spark, sf_dir, path, lambda flights: run(flights, path))
    return jobs.read_stream_results(spark, path, name)


def stream_q1_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emits filling windows too; the result table keeps the last version."""
    params = sized(spark, sf_dir, STREAM_PARAMS)
    return _corrected(spark, sf_dir, "q1", lambda f, path: jobs.start_q1(f, path, params, corrections=True))


def stream_q2_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings that late rows change after they were emitted."""
    params = sized(spark, sf_dir, replace(STREAM_PARAMS, min_flights=PARAMS_1H.min_flights))
    return _list_as_json(_corrected(spark, sf_dir, "q2_1h", lambda f, path: jobs.start_q2(f, path, "1h", params, corrections=True)))


def stream_q3_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = sized(spark, sf_dir, STREAM_PARAMS)
    rows = _corrected(spark, sf_dir, "q3_1d", lambda f, path: jobs.start_q3(f, path, "1d", params, corrections=True))
    return _stable_quantiles(rows, *_QUANTILES)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs of one checkpointed query with a tight watermark."""
    path = scratch_dir(spark, "stream_restart")
    params = sized(spark, sf_dir, TIGHT_PARAMS)
    _in_arrival_parts(spark, sf_dir, path, lambda flights: jobs.start_q1(flights, path, params), slower=60)
    return jobs.read_stream_results(spark, path, "q1")


def stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a tight hourly airport stream loses."""
    path = scratch_dir(spark, "stream_late_split")
    _in_arrival_parts(
        spark, sf_dir, path, lambda flights: jobs.start_late_split(flights, path, "1h", TIGHT_PARAMS), slower=60
    )
    lost = spark.read.parquet(f"{path}/late")
    return lost.select("event_id", "window_end", _stable("lateness_min").alias("lateness_min"))


def _stream_q2(spark: SparkSession, sf_dir: str, window: str, min_flights: int) -> DataFrame:
    path = scratch_dir(spark, f"stream_q2_{window}")
    params = sized(spark, sf_dir, replace(STREAM_PARAMS, min_flights=min_flights))
    stream = jobs.start_q2(_stream(spark, sf_dir), path, window, params)
    return _list_as_json(_drained(stream, path, f"q2_{window}"))


def stream_q2_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_q2(spark, sf_dir, "1h", PARAMS_1H.min_flights)


def stream_q2_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_q2(spark, sf_dir, "6h", PARAMS_6H.min_flights)


def _q2_snapshots(spark: SparkSession, sf_dir: str, params: JobParams, slower: int = 1) -> DataFrame:
    path, params = scratch_dir(spark, "stream_q2_global"), sized(spark, sf_dir, params)
    _in_arrival_parts(spark, sf_dir, path, lambda flights: jobs.start_q2_global(flights, path, params), slower)
    return _list_as_json(jobs.read_stream_results(spark, path, "q2_global"))


def stream_q2_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly snapshots over four runs; totals are carried across them."""
    return _q2_snapshots(spark, sf_dir, replace(PARAMS, watermark_delay=30))


def stream_q2_global_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last snapshot where many rows come after the snapshot of their time: it holds all of them."""
    rows = _q2_snapshots(spark, sf_dir, TIGHT_PARAMS, slower=60)
    return rows.where(F.col("window_end") == last_boundary(rows))


def _stream_q3(spark: SparkSession, sf_dir: str, window: str) -> DataFrame:
    path = scratch_dir(spark, f"stream_q3_{window}")
    stream = jobs.start_q3(_stream(spark, sf_dir), path, window, sized(spark, sf_dir, STREAM_PARAMS))
    return _stable_quantiles(_drained(stream, path, f"q3_{window}"), *_QUANTILES)


def stream_q3_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_q3(spark, sf_dir, "1d")


def stream_q3_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_q3(spark, sf_dir, "7d")


def _q3_snapshots(spark: SparkSession, sf_dir: str, params: JobParams, slower: int = 1) -> DataFrame:
    path, params = scratch_dir(spark, "stream_q3_global"), sized(spark, sf_dir, params)
    _in_arrival_parts(spark, sf_dir, path, lambda flights: jobs.start_q3_global(flights, path, params), slower)
    return _stable_quantiles(jobs.read_stream_results(spark, path, "q3_global"), *_QUANTILES)


def stream_q3_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily snapshots over four runs; sketch bins are carried across them."""
    return _q3_snapshots(spark, sf_dir, replace(PARAMS, watermark_delay=30))


def stream_q3_global_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _q3_snapshots(spark, sf_dir, TIGHT_PARAMS, slower=60)
    return rows.where(F.col("window_end") == last_boundary(rows))


def stream_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole streaming job: rows and flights of each of its seven results."""
    path = scratch_dir(spark, "stream_all")
    started = jobs.start_all(_stream(spark, sf_dir), path, sized(spark, sf_dir, replace(STREAM_PARAMS, min_flights=2)))
    started.finish()
    for intake in started.intakes:
        drop_folder(spark, f"{intake.path}/rows")
    counts = []
    for name in jobs.RESULT_NAMES:
        rows = jobs.read_stream_results(spark, f"{path}/{name}", name)
        flights = F.sum("count" if name.startswith("q3") else "num_flights").alias("flights")
        counts.append(rows.agg(F.count(F.lit(1)).alias("result_rows"), flights).select(
            F.lit(name).alias("query"), "result_rows", "flights"))
    return reduce(DataFrame.unionByName, counts)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        event_time, clean_flights, rejects_by_rule, active_flights, target_airlines, global_avg_delay,
        round_half_up, safe_math, ts_format_parse,
        q1_1h, q2_airport_stats, q2_top20, q2_1h, q2_6h, q2_global, q3_1d, q3_7d, q3_global,
        q2_1h_top3, q2_6h_top3, rejects_with_gaps, clean_with_gaps, q3_7d_special,
        ddsketch_quantiles, ddsketch_merge, merge_equivalence, merge_carrier,
        disorder_assign, late_report, late_rows, lateness_stats, ingest_bounds, ingest_bounds_q2, ingest_bounds_q3,
        latency_stats,
        scan_csv, first_n_by_event_time, decode_json,
        encode_results_json, encode_q3_json, plain_string, typed_decode_q2, lww_upsert, pivot_fields,
        export_q1, export_q2, export_q3, run_stats,
        stream_q1_1h, stream_q1_lateness, stream_restart, stream_late_split,
        stream_q2_1h, stream_q2_6h, stream_q2_global, stream_q3_1d, stream_q3_7d, stream_q3_global,
        stream_q2_lateness, stream_q3_lateness, stream_q2_global_late, stream_q3_global_late, stream_all,
    )
}
