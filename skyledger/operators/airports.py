"""Airport delay statistics, worst flights and ranking (Q2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.scalars import above, safe_divide_rounded
from skyledger.operators.clean import active_flights
from skyledger.operators.windows import (
    coarser_window,
    event_window,
    label_of,
    last_boundary,
    repeat_to,
    unpack_window,
    window_ms,
)
from skyledger.params import JobParams

KEY = ("window_start", "window_end", "origin_airport_id")

TOTALS = ("num_flights", "severe_delays", "delay_sum", "dep_delay_max")

# Worst flights travel as an array of (minus delay, carrier, dest): its natural order is the wanted
# order (longest delay first, then carrier, then destination), so merging two lists is concat,
# sort_array, slice.
EMPTY_LIST = "CAST(array() AS array<struct<neg:double,carrier:string,dest:string>>)"


def airport_partials(cleaned: DataFrame, params: JobParams = JobParams(), window: str = "1h") -> DataFrame:
    """Additive statistics per (window, airport) of active flights, not yet filtered or rounded."""
    delay = F.col("dep_delay")
    # A maximum that ignores NaN, as a greater-than test does.
    largest = F.max(F.when(~F.isnan(delay), delay))
    return unpack_window(
        active_flights(cleaned)
        .groupBy(event_window(window), "origin_airport_id")
        .agg(
            F.count(F.lit(1)).alias("num_flights"),
            F.count_if(above(delay, params.severe_minutes)).alias("severe_delays"),
            F.sum(delay).alias("delay_sum"),
            largest.alias("dep_delay_max"),
        )
    )


def merge_airport_partials(partials: DataFrame, window: str) -> DataFrame:
    """Statistics of a coarser window from a finer one."""
    return partials.groupBy(*coarser_window(window), "origin_airport_id").agg(
        F.sum("num_flights").alias("num_flights"),
        F.sum("severe_delays").alias("severe_delays"),
        F.sum("delay_sum").alias("delay_sum"),
        F.max("dep_delay_max").alias("dep_delay_max"),
    )


def airport_stats(partials: DataFrame, min_flights: int) -> DataFrame:
    """Finished statistics of airports with enough flights. The mean is rounded before any ranking."""
    return partials.where(F.col("num_flights") >= min_flights).select(
        *KEY, "num_flights", "severe_delays",
        safe_divide_rounded(F.col("delay_sum"), F.col("num_flights")).alias("dep_delay_mean"),
        "dep_delay_max",
    )


def worst_flights(cleaned: DataFrame, params: JobParams = JobParams(), window: str = "1h") -> DataFrame:
    """The ``top_flights`` longest severe delays per (window, airport), as ``worst``.

    The rank filter is applied inside every map task before the exchange (a window group limit), so an
    airport that holds a third of all rows still sends at most ``top_flights`` rows per task and window.
    """
    severe = active_flights(cleaned).where(above(F.col("dep_delay"), params.severe_minutes))
    rows = unpack_window(severe.select(
        event_window(window),
        "origin_airport_id",
        F.col("dep_delay"),
        F.col("airline").alias("carrier"),
        F.col("dest_airport_id").cast("string").alias("dest"),
    ))
    return collect_worst(rows, params.top_flights)


def collect_worst(rows: DataFrame, n: int) -> DataFrame:
    """``worst`` lists from (key, dep_delay, carrier, dest) rows, bounded before they are collected."""
    order = Window.partitionBy(*KEY).orderBy(F.desc("dep_delay"), "carrier", "dest")
    entry = F.struct((-F.col("dep_delay")).alias("neg"), "carrier", "dest")
    return (
        rows.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= n)
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(entry)).alias("worst"))
    )


def merge_worst_flights(lists: DataFrame, window: str, n: int) -> DataFrame:
    """Lists of a coarser window from lists of a finer one; every input list is already bounded."""
    rows = lists.select(*coarser_window(window), "origin_airport_id", F.explode("worst").alias("f")).select(
        *KEY, (-F.col("f.neg")).alias("dep_delay"), "f.carrier", "f.dest"
    )
    return collect_worst(rows, n)


def published_list(worst: Column) -> Column:
    """Result form of a worst-flight list."""
    full = F.coalesce(worst, F.expr(EMPTY_LIST))
    return F.transform(full, lambda f: F.struct(
        f["carrier"].alias("carrier"), f["dest"].alias("dest"), (-f["neg"]).alias("dep_delay")
    ))


def rank_airports(stats: DataFrame, n: int) -> DataFrame:
    """Top ``n`` per window end: severe delays, then rounded mean, then the lower airport id.

    Bounded per task before the exchange by the same window group limit.
    """
    order = Window.partitionBy("window_end").orderBy(
        F.desc("severe_delays"), F.desc("dep_delay_mean"), F.asc("origin_airport_id")
    )
    return stats.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def airport_result(ranked: DataFrame, lists: DataFrame, window_type: str) -> DataFrame:
    """Attaches the worst flights to ranked rows; both sides are small by now."""
    return _result(ranked.join(lists, list(KEY), "left"), window_type)


def _result(rows: DataFrame, window_type: str) -> DataFrame:
    return rows.select(
        "window_start", "window_end", F.lit(window_type).alias("window_type"), "rank", "origin_airport_id",
        "num_flights", "severe_delays", "dep_delay_mean", "dep_delay_max",
        published_list(F.col("worst")).alias("delayed_flights"),
    )


def airport_ranking(cleaned: DataFrame, window: str, params: JobParams = JobParams()) -> DataFrame:
    """Q2 over tumbling windows of one size."""
    stats = airport_stats(airport_partials(cleaned, params, window), params.min_flights)
    ranked = rank_airports(stats, params.top_airports)
    return airport_result(ranked, worst_flights(cleaned, params, window), window)


def airport_ranking_from_partials(
    partials: DataFrame, lists: DataFrame, window: str, params: JobParams = JobParams()
) -> DataFrame:
    """The same from finer partials, without touching flights again."""
    stats = airport_stats(merge_airport_partials(partials, window), params.min_flights)
    ranked = rank_airports(stats, params.top_airports)
    return airport_result(ranked, merge_worst_flights(lists, window, params.top_flights), window)


# Passes of ``cumulative_worst`` that cover every hour a timestamp of four-digit years can name.
_ALL_PASSES = 14


def cumulative_worst(lists: DataFrame, n: int, intervals: int | None = None) -> DataFrame:
    """Running list per airport: row ``window_end`` holds the worst flights of all windows up to it.

    A running collect would hold every earlier list again in every row. Instead a pass merges each row
    with the rows 1, 2 and 3 steps before it, and the step grows fourfold from pass to pass, so a row never
    holds more than ``n`` flights, and all passes share one exchange and one sort. Without ``intervals``,
    a bound on an airport's rows that the caller knows, there are passes for all representable dates.
    """
    order = "OVER (PARTITION BY origin_airport_id ORDER BY window_end)"
    keep = ("origin_airport_id", "window_end")
    out = lists.select(*keep, "worst")
    covered = 1
    for _ in range(_ALL_PASSES):
        if intervals is not None and covered >= intervals:
            break
        earlier = ", ".join(f"lag(worst, {covered * i}, {EMPTY_LIST}) {order}" for i in (1, 2, 3))
        out = out.selectExpr(*keep, f"slice(sort_array(concat(worst, {earlier})), 1, {n}) AS worst")
        covered *= 4
    return out


def airport_snapshots(
    partials: DataFrame, lists: DataFrame, params: JobParams = JobParams(), interval_ms: int | None = None,
    start_ms: int | None = None, last: Column | None = None, intervals: int | None = None,
) -> DataFrame:
    """Q2 since the start of the data, repeated at every interval boundary (default hourly) up to ``last``.

    ``partials`` and ``lists`` are per interval. Statistics accumulate on the sparse rows; only then is
    every airport repeated up to its next change, so silent airports stay in the ranking. Ranking runs
    on narrow rows, and the lists are attached to the winners alone.
    Without ``last``, the last interval with data is the end.
    """
    interval = interval_ms or params.airport_snapshot_ms
    begin = params.dataset_start_ms if start_ms is None else start_ms
    order = Window.partitionBy("origin_airport_id").orderBy("window_end")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if last is None:
        last = last_boundary(partials, "origin_airport_id", *TOTALS)
    cumulative = partials.select(
        "origin_airport_id",
        "window_end",
        F.sum("num_flights").over(running).alias("num_flights"),
        F.sum("severe_delays").over(running).alias("severe_delays"),
        F.sum("delay_sum").over(running).alias("delay_sum"),
        F.max("dep_delay_max").over(running).alias("dep_delay_max"),
        F.max(F.when(F.col("severe_delays") > 0, F.col("window_end"))).over(running).alias("list_end"),
        F.lead("window_end").over(order).alias("next_end"),
    ).where(F.col("num_flights") >= params.min_flights)
    until = F.coalesce(F.col("next_end") - interval, last)
    stats = repeat_to(cumulative, until, interval, "boundary").select(
        F.lit(begin).cast("long").alias("window_start"),
        F.col("boundary").alias("window_end"),
        "origin_airport_id", "num_flights", "severe_delays",
        safe_divide_rounded(F.col("delay_sum"), F.col("num_flights")).alias("dep_delay_mean"),
        "dep_delay_max", "list_end",
    )
    ranked = rank_airports(stats, params.top_airports)
    as_of = cumulative_worst(lists, params.top_flights, intervals).withColumnRenamed("window_end", "list_end")
    return _result(ranked.join(as_of, ["origin_airport_id", "list_end"], "left"), "global")


def airport_since_start(
    cleaned: DataFrame, params: JobParams = JobParams(), start_ms: int | None = None, work_dir: str | None = None
) -> DataFrame:
    """Q2 since the start, straight from flights.

    With a ``work_dir`` that all executors reach, narrow flights and the partials of an interval are written there: the
    source is read once, and the number of merge passes follows from the intervals that there are.
    """
    label = label_of(params.airport_snapshot_ms)
    if work_dir is None:
        return airport_snapshots(
            airport_partials(cleaned, params, label), worst_flights(cleaned, params, label), params, start_ms=start_ms)
    spark = cleaned.sparkSession

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{work_dir}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{work_dir}/{name}")

    narrow = written(active_flights(cleaned).select(
        "event_ts", "origin_airport_id", "dep_delay", "airline", "dest_airport_id", "is_cancelled", "is_diverted"), "flights")
    partials = written(airport_partials(narrow, params, label), "partials")
    lists = written(worst_flights(narrow, params, label), "worst")
    span = partials.agg((F.max("window_end") - F.min("window_end")).alias("ms")).first().ms
    return airport_snapshots(
        partials, lists, params, start_ms=start_ms, intervals=(span or 0) // params.airport_snapshot_ms + 1)


# --- streams ------------------------------------------------------------------------------------------

_STATS = (("num_flights", "sum"), ("severe_delays", "sum"), ("delay_sum", "sum"), ("dep_delay_max", "max"))
_ENTRY = T.StructType([
    T.StructField("neg", T.DoubleType()), T.StructField("carrier", T.StringType()), T.StructField("dest", T.StringType())])


def reduced_flights(cleaned: DataFrame, params: JobParams = JobParams(), window: str = "1h") -> DataFrame:
    """What a task has seen of each (window, airport): additive statistics and its worst flights.

    A streaming aggregation has no bounded list, so a task cuts its own first: however many flights an airport has, the
    state gets ``top_flights`` entries of it from a task and micro-batch at most. ``event_ts`` is the window's start and
    keeps the watermark of the column that it comes from.
    """
    size, n = window_ms(window) * 1000, params.top_flights
    delay = F.col("dep_delay")
    rows = active_flights(cleaned).select(
        "event_ts", "origin_airport_id", F.lit(1).cast("long").alias("num_flights"),
        above(delay, params.severe_minutes).cast("long").alias("severe_delays"), delay.alias("delay_sum"),
        F.when(~F.isnan(delay), delay).alias("dep_delay_max"), F.col("airline").alias("carrier"),
        F.col("dest_airport_id").cast("string").alias("dest"))
    schema = T.StructType([
        rows.schema["event_ts"], rows.schema["origin_airport_id"], *[
            T.StructField(name, rows.schema[name].dataType) for name, _ in _STATS],
        T.StructField("worst", T.ArrayType(_ENTRY))])
    key = ["event_ts", "origin_airport_id"]
    narrow = pa.schema([
        ("event_ts", pa.int64()), ("origin_airport_id", pa.int32()), ("num_flights", pa.int64()),
        ("severe_delays", pa.int64()), ("delay_sum", pa.float64()), ("dep_delay_max", pa.float64())])

    def totals(table: pa.Table) -> pa.Table:
        found = table.group_by(key).aggregate(list(_STATS))
        named = found.select([*key, *(f"{c}_{how}" for c, how in _STATS)]).rename_columns(narrow.names)
        return named.cast(narrow)

    def longest(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        table = table.sort_by([(c, "ascending") for c in (*key, "neg", "carrier", "dest")])
        at, airport = (table[c].to_numpy() for c in key)
        new = np.ones(len(table), bool)
        new[1:] = (at[1:] != at[:-1]) | (airport[1:] != airport[:-1])
        begin = np.flatnonzero(new)
        place = np.arange(len(table)) - np.repeat(begin, np.diff(np.append(begin, len(table))))
        kept = place < n
        return table.filter(pa.array(kept)), new[kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats, worst = [], []
        for batch in batches:
            at = batch.column(0).cast(pa.int64()).to_numpy()
            table = pa.Table.from_batches([batch]).set_column(0, "event_ts", pa.array(at - at % size))
            stats = [totals(pa.concat_tables([*stats, table.select(narrow.names).cast(narrow)]))]
            severe = table.filter(pc.equal(table["severe_delays"], 1))
            flights = pa.table({
                "event_ts": severe["event_ts"], "origin_airport_id": severe["origin_airport_id"],
                "carrier": severe["carrier"], "dest": severe["dest"], "neg": pc.negate(severe["delay_sum"])})
            worst = [longest(pa.concat_tables([*worst, flights]))[0]]
        if not stats:
            return
        table, new = longest(worst[0])
        ends = np.append(np.flatnonzero(new), len(table))
        entries = pa.StructArray.from_arrays(
            [table[c].combine_chunks() for c in _ENTRY.names], _ENTRY.names) if len(table) else None
        place = {pair: i for i, pair in enumerate(zip(*(table[c].to_numpy()[new].tolist() for c in key)))}
        for out in stats[0].to_batches():
            own = [place.get(pair) for pair in zip(*(out[c].to_pylist() for c in key))]
            lists = [[] if i is None else entries[ends[i]:ends[i + 1]].to_pylist() for i in own]
            kind = pa.list_(pa.struct([("neg", pa.float64()), ("carrier", pa.string()), ("dest", pa.string())]))
            yield pa.RecordBatch.from_arrays([
                out["event_ts"].cast(pa.timestamp("us", "UTC")), *(out[name] for name in schema.names[1:-1]),
                pa.array(lists, kind)], names=schema.names)

    return rows.mapInArrow(run, schema)


def airport_windows(reduced: DataFrame, params: JobParams = JobParams(), window: str = "1h") -> DataFrame:
    """Statistics and worst flights per (window, airport), summed up in the state of a stream."""
    lists = F.sort_array(F.flatten(F.collect_list("worst")))
    return reduced.groupBy(event_window(window), "origin_airport_id").agg(
        *[getattr(F, how)(name).alias(name) for name, how in _STATS],
        F.slice(lists, 1, params.top_flights).alias("worst"))


def airport_ranking_stream(cleaned: DataFrame, window: str, params: JobParams = JobParams()) -> DataFrame:
    """Q2 over tumbling windows of a stream: airports first, then the first of each window among the finished ones.

    A stream cannot number rows, so the second aggregation cuts an ordered list of a window's airports. Its rows are
    narrow but for the winners' flights, and an airport is in it once.
    """
    finished = airport_windows(reduced_flights(cleaned, params, window), params, window)
    mean = safe_divide_rounded(F.col("delay_sum"), F.col("num_flights"))
    entry = F.struct(
        "severe_delays", mean.alias("dep_delay_mean"), (-F.col("origin_airport_id")).alias("lower"), "num_flights",
        "dep_delay_max", "worst")
    first = F.slice(F.sort_array(F.collect_list(entry), asc=False), 1, params.top_airports)
    windows = finished.where(F.col("num_flights") >= params.min_flights).groupBy("window").agg(first.alias("first"))
    ranked = windows.select("window", F.posexplode("first").alias("place", "a")).select(
        "window", (F.col("place") + 1).alias("rank"), (-F.col("a.lower")).alias("origin_airport_id"), "a.num_flights",
        "a.severe_delays", "a.dep_delay_mean", "a.dep_delay_max", "a.worst")
    return _result(unpack_window(ranked), window)
