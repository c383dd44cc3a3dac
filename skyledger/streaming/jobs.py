"""The seven result streams and what goes with them, on Spark's own event time, state and recovery.

Every stream sets its watermark on the raw rows, so rejected and filtered rows move it too. Windowed results are
streaming aggregations: in append mode a window is emitted once, when the watermark (delay plus allowed lateness) has
passed it; with corrections, in update mode, it is emitted whenever it changes, until then. Rankings and distributions
chain two aggregations. Rows that the aggregation drops as late leave the same query as a second kind of row, told
apart by the watermark that Spark has logged for the batch.

Results since the start add up finished intervals. A row that is late for its interval counts in the next snapshot.

What leaves a micro-batch goes to a last-write-wins table under the number of the batch, so a batch that is delivered
again changes nothing. All state is in Spark's checkpoint, but for the totals since the start, which are a table too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyledger.functions import sketch
from skyledger.operators import airports, carrier, delays, latency
from skyledger.operators.clean import active_flights, target_airlines
from skyledger.operators.late import MINUTE_MS
from skyledger.operators.windows import end_of_window, label_of, unpack_window, window_ms
from skyledger.params import DAY_MS, JobParams
from skyledger.schema import Q1_RESULT, Q2_RESULT, Q3_RESULT
from skyledger.session import drop_folder, make_folder
from skyledger.sinks.result_table import RESULT_KEYS, batch_ids, read_results, upsert, write_batch
from skyledger.sources.streams import parquet_stream
from skyledger.streaming.checkpoints import trigger
from skyledger.streaming.intake import CLOSING_MS, batch_watermark, clean_stream, close, judged_flights, with_closing
from skyledger.streaming.progress import ProgressWriter, counters, dropped_rows

__all__ = ["counters", "dropped_rows"]

# Gets the finished rows of one batch; must tolerate a repeated batch id.
BatchSink = Callable[[DataFrame, int], None]
# One input, or several with a watermark each.
Flights = DataFrame | Sequence[DataFrame]


# --- running ------------------------------------------------------------------------------------------


@dataclass
class RunningStream:
    """A started stream, and how a bounded one is closed."""

    query: StreamingQuery
    spark: SparkSession
    path: str
    schema: T.StructType
    start: Callable[[], StreamingQuery]
    waiting: bool = True

    def awaitTermination(self) -> None:  # noqa: N802 - named as on the query
        """Waits for the query, and until its progress has been written."""
        try:
            self.query.awaitTermination()
        finally:
            if self.waiting:
                ProgressWriter.of(self.spark).wait(str(self.query.runId))
                self.waiting = False

    def again(self) -> None:
        """Starts the query once more, from its checkpoint."""
        self.query = self.start()
        self.waiting = True

    def finish(self) -> None:
        """Waits for a drained run and closes what is open, as at the end of a bounded source.

        A closing row passes the watermark and is dropped before any aggregation. Rows of later runs are late.
        """
        self.awaitTermination()
        close(self.spark, self.schema, f"{self.path}/closing")
        self.again()
        self.awaitTermination()


@dataclass
class RunningStreams:
    """Several streams side by side, and the intakes that they read from."""

    streams: list[RunningStream]
    intakes: list[RunningStream]

    def awaitTermination(self) -> None:  # noqa: N802 - named as on the query
        for stream in [*self.intakes, *self.streams]:
            stream.awaitTermination()

    def finish(self) -> None:
        self.awaitTermination()
        for stream in self.streams:
            close(stream.spark, stream.schema, f"{stream.path}/closing")
            stream.again()
        self.awaitTermination()


def _start(
    flights: Flights, path: str, name: str, delay: int, params: JobParams, interval: str | None,
    build: Callable[[DataFrame], DataFrame], handle: Callable[[DataFrame, int], None], mode: str = "append",
) -> RunningStream:
    inputs = [flights] if isinstance(flights, DataFrame) else list(flights)
    spark = inputs[0].sparkSession
    schema = inputs[0].schema

    out = build(clean_stream([with_closing(f, f"{path}/closing") for f in inputs], delay, f"rows_{name}"))
    # A query keeps these as they are when it starts, whatever the session is set to later.
    own = {"spark.sql.streaming.multipleWatermarkPolicy": params.watermark_policy}
    if params.state_partitions:
        own["spark.sql.shuffle.partitions"] = str(params.state_partitions)

    def start() -> StreamingQuery:
        ProgressWriter.of(spark).follow(name, path)
        before = {key: spark.conf.get(key) for key in own}
        for key, value in own.items():
            spark.conf.set(key, value)
        try:
            return (
                out.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", f"{path}/checkpoint")
                .trigger(**trigger(interval)).foreachBatch(handle).start()
            )
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)

    return RunningStream(start(), spark, path, schema, start)


def read_stream_results(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Current rows of a result stream that has emitted at least one window."""
    schema = {"q1": Q1_RESULT, "q2": Q2_RESULT, "q3": Q3_RESULT}[query.split("_")[0]]
    return read_results(spark, f"{path}/results", schema)


def late_rows_seen(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows that a windowed result has left out as late; None where there were none."""
    return spark.read.parquet(f"{path}/late") if batch_ids(spark, f"{path}/late") else None


# --- windowed results ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Result:
    """One windowed result: which rows it takes, its finished form in a stream, and its form with corrections.

    With corrections ``partials`` is the aggregation that a stream updates, ``keys`` are the columns that name one of
    its rows, and ``finish`` makes results of the stored rows of some windows; None where partials are results.
    """

    name: str
    window: str
    keep: Callable[[DataFrame], DataFrame]
    stream: Callable[[DataFrame], DataFrame]
    partials: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    finish: Callable[[DataFrame], DataFrame] | None
    schema: T.StructType


def _q1(params: JobParams) -> Result:
    performance = lambda rows: carrier.carrier_performance(rows, params)
    return Result(
        "q1", "1h", lambda rows: target_airlines(rows, params.carriers), performance, performance, (), None, Q1_RESULT)


def _q2(window: str, params: JobParams) -> Result:
    def partials(rows: DataFrame) -> DataFrame:
        reduced = airports.reduced_flights(rows, params, window)
        return unpack_window(airports.airport_windows(reduced, params, window))

    def finish(stored: DataFrame) -> DataFrame:
        stats = airports.airport_stats(stored, params.min_flights)
        ranked = airports.rank_airports(stats, params.top_airports)
        lists = stored.where("severe_delays > 0").select(*airports.KEY, "worst")
        return airports.airport_result(ranked, lists, window)

    return Result(
        f"q2_{window}", window, active_flights, lambda rows: airports.airport_ranking_stream(rows, window, params),
        partials, ("window_start", "origin_airport_id"), finish, Q2_RESULT)


def _q3(window: str, params: JobParams) -> Result:
    return Result(
        f"q3_{window}", window, lambda rows: target_airlines(active_flights(rows), params.carriers),
        lambda rows: delays.delay_distribution_stream(rows, window, params),
        lambda rows: delays.delay_bins(rows, params, window), ("window_start", "airline", "hour", "bin"),
        lambda stored: delays.finish_delays(stored, window, params), Q3_RESULT)


def _with_late(results: DataFrame, rows: DataFrame, window: str) -> DataFrame:
    """Finished results and the rows that may be late, as two columns of one stream; a row has one of them."""
    late = rows.withColumn("window_end", end_of_window(F.col("event_ms"), window_ms(window)))
    nothing = lambda df: F.lit(None).cast(T.StructType(
        [T.StructField(f.name, f.dataType) for f in df.schema.fields]))
    return results.select(F.struct("*").alias("result"), nothing(late).alias("late")).unionByName(
        late.select(nothing(results).alias("result"), F.struct("*").alias("late")))


def _is_late(mark: int | None) -> Column:
    """Spark drops a row whose window end the watermark has reached."""
    return F.col("late.window_end") <= F.lit(-1 if mark is None else mark)


def _late_part(batch: DataFrame, mark: int | None) -> DataFrame:
    return batch.where("late IS NOT NULL").select("late.*").withColumn(
        "lateness_min", (F.lit(mark).cast("long") - F.col("window_end")) / float(MINUTE_MS))


def _deliver(rows: DataFrame, path: str, batch_id: int, keys: Sequence[str], sinks: Sequence[BatchSink], days=None) -> None:
    upsert(rows, f"{path}/results", batch_id, keys, days)
    for sink in sinks:
        sink(rows, batch_id)


def _window_stream(
    flights: Flights, result: Result, path: str, params: JobParams, interval: str | None, sinks: Sequence[BatchSink],
    corrections: bool,
) -> RunningStream:
    delay = params.watermark_delay + params.lateness_for(result.name)
    keys = RESULT_KEYS[result.name]
    first = result.partials if corrections else result.stream

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = batch_watermark(spark, f"{path}/checkpoint", batch_id)
        kept = batch.where(F.col("result").isNotNull() | _is_late(mark)).persist()
        try:
            found = kept.agg(
                F.count("late").alias("late"), F.collect_set(F.floor(F.col("result.window_start") / DAY_MS)).alias("days")
            ).first()
            if found.late:
                write_batch(_late_part(kept, mark), f"{path}/late", batch_id)
            if found.days:
                rows = kept.where("result IS NOT NULL").select("result.*")
                if corrections and result.finish:
                    rows = _corrected(rows, result, path, batch_id, found.days)
                _deliver(rows, path, batch_id, keys, sinks, found.days)
        finally:
            kept.unpersist()

    return _start(
        flights, path, result.name, delay, params, interval,
        lambda rows: _with_late(first(rows), result.keep(rows), result.window), handle,
        "update" if corrections else "append")


def _corrected(changed: DataFrame, result: Result, path: str, batch_id: int, days: Sequence[int]) -> DataFrame:
    """Results of the windows that a batch has changed, from all their stored partials."""
    spark = changed.sparkSession
    upsert(changed, f"{path}/partials", batch_id, result.keys, days)
    stored = read_results(spark, f"{path}/partials", changed.schema, min(days), max(days))
    touched = changed.select("window_start").distinct()
    return result.finish(stored.join(touched, "window_start", "left_semi").select(*stored.columns))


def start_q1(
    flights: Flights, path: str, params: JobParams = JobParams(), interval: str | None = None,
    sinks: Sequence[BatchSink] = (), corrections: bool = False,
) -> RunningStream:
    """Carrier performance per hour, once per window; with ``corrections`` whenever a window changes."""
    return _window_stream(flights, _q1(params), path, params, interval, sinks, corrections)


def start_q2(
    flights: Flights, path: str, window: str, params: JobParams = JobParams(), interval: str | None = None,
    sinks: Sequence[BatchSink] = (), corrections: bool = False,
) -> RunningStream:
    """Airport ranking over tumbling windows; with ``corrections`` a row ranks its whole window anew."""
    return _window_stream(flights, _q2(window, params), path, params, interval, sinks, corrections)


def start_q3(
    flights: Flights, path: str, window: str, params: JobParams = JobParams(), interval: str | None = None,
    sinks: Sequence[BatchSink] = (), corrections: bool = False,
) -> RunningStream:
    """Delay distribution over tumbling windows; the state is one counter per sketch bin."""
    return _window_stream(flights, _q3(window, params), path, params, interval, sinks, corrections)


# --- results since the start --------------------------------------------------------------------------


@dataclass(frozen=True)
class SinceStart:
    """A result since the start: rows become partials (``single``), a stream sums them up per interval (``closed``),
    ``merge`` adds partials of the same ``window_end``, and ``snapshots`` makes results up to a boundary."""

    name: str
    interval: int
    closed: Callable[[DataFrame], DataFrame]
    single: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    snapshots: Callable[[DataFrame, Column, int], DataFrame]
    schema: T.StructType


def _q2_global(params: JobParams, start_ms: int | None) -> SinceStart:
    window = label_of(params.airport_snapshot_ms)
    columns = ("window_end", "origin_airport_id", *airports.TOTALS, "worst")

    def closed(rows: DataFrame) -> DataFrame:
        reduced = airports.reduced_flights(rows, params, window)
        return unpack_window(airports.airport_windows(reduced, params, window)).select(*columns)

    def single(rows: DataFrame) -> DataFrame:
        reduced = airports.reduced_flights(rows, params, window)
        end = F.unix_millis("event_ts") + params.airport_snapshot_ms
        return reduced.withColumn("window_end", end).select(*columns)

    def merge(partials: DataFrame) -> DataFrame:
        lists = F.sort_array(F.flatten(F.collect_list("worst")))
        return partials.groupBy("window_end", "origin_airport_id").agg(
            *[F.sum(c).alias(c) for c in airports.TOTALS[:3]], F.max("dep_delay_max").alias("dep_delay_max"),
            F.slice(lists, 1, params.top_flights).alias("worst")).select(*columns)

    def snapshots(partials: DataFrame, last: Column, intervals: int) -> DataFrame:
        lists = partials.where("severe_delays > 0").select("window_end", "origin_airport_id", "worst")
        return airports.airport_snapshots(
            partials, lists, params, start_ms=start_ms, last=last, intervals=intervals)

    return SinceStart("q2_global", params.airport_snapshot_ms, closed, single, merge, snapshots, Q2_RESULT)


def _q3_global(params: JobParams, start_ms: int | None) -> SinceStart:
    window = label_of(params.delay_snapshot_ms)
    columns = ("window_end", "airline", "hour", "bin", "cnt", "lo", "hi")

    def single(rows: DataFrame) -> DataFrame:
        kept = target_airlines(active_flights(rows), params.carriers)
        bins = kept.select(
            end_of_window(F.col("event_ms"), params.delay_snapshot_ms).alias("window_end"), "airline",
            F.col("dep_hour").alias("hour"), sketch.bin_of("dep_delay", params.sketch_accuracy).alias("bin"), "dep_delay")
        known = F.col("bin").isNotNull()
        return bins.select(
            "window_end", "airline", "hour", "bin", known.cast("long").alias("cnt"),
            F.when(known, F.col("dep_delay")).alias("lo"), F.when(known, F.col("dep_delay")).alias("hi"))

    def merge(partials: DataFrame) -> DataFrame:
        return sketch.merge_bins(partials, ["window_end", "airline", "hour"]).select(*columns)

    return SinceStart(
        "q3_global", params.delay_snapshot_ms, lambda rows: delays.delay_bins(rows, params, window).select(*columns),
        single, merge, lambda partials, last, _: delays.delay_snapshots(partials, params, start_ms=start_ms, last=last),
        Q3_RESULT)


def _boundary(mark: int | None, interval: int) -> int | None:
    """The last boundary that a watermark has passed."""
    return None if mark is None else mark // interval * interval


def _since_start_stream(
    flights: Flights, job: SinceStart, path: str, params: JobParams, interval: str | None, sinks: Sequence[BatchSink],
) -> RunningStream:
    def build(rows: DataFrame) -> DataFrame:
        closed, single = job.closed(rows), job.single(rows)
        return closed.withColumn("closed", F.lit(True)).unionByName(single.withColumn("closed", F.lit(False)))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = batch_watermark(spark, f"{path}/checkpoint", batch_id)
        if mark is None:
            # Nothing is closed or late yet, but the state has to be written.
            batch.write.format("noop").mode("overwrite").save()
            return
        done = _boundary(batch_watermark(spark, f"{path}/checkpoint", batch_id - 1), job.interval)
        upto = _boundary(mark, job.interval)
        # A late row counts in the first interval behind the last boundary.
        new = batch.where(F.col("closed") | (F.col("window_end") <= mark)).withColumn(
            "window_end", F.when(F.col("closed"), F.col("window_end")).otherwise(
                F.greatest("window_end", F.lit(upto + job.interval).cast("long")))).drop("closed")
        before = [b for b in batch_ids(spark, f"{path}/totals") if b < batch_id]
        if before:
            known = spark.read.schema(new.schema).parquet(f"{path}/totals/batch_id={before[-1]}")
            new = known.unionByName(new)
        rows = job.merge(new).persist()
        try:
            span = rows.agg(F.min("window_end").alias("low"), F.max("window_end").alias("high")).first()
            if span.low is None:
                return
            if mark >= CLOSING_MS - params.watermark_delay * MINUTE_MS:
                upto = span.high
            if span.low <= upto and (done is None or done < upto):
                shots = job.snapshots(
                    rows.where(F.col("window_end") <= upto), F.lit(upto).cast("long"),
                    (upto - span.low) // job.interval + 1)
                if done is not None:
                    shots = shots.where(F.col("window_end") > done)
                shots = shots.select(*[F.col(f.name).cast(f.dataType) for f in job.schema.fields])
                _deliver(shots, path, batch_id, RESULT_KEYS[job.name], sinks)
            # From here on the intervals up to the boundary are one.
            totals = job.merge(rows.withColumn("window_end", F.greatest("window_end", F.lit(upto).cast("long"))))
            write_batch(totals, f"{path}/totals", batch_id)
        finally:
            rows.unpersist()
        for old in before[:-1]:
            drop_folder(spark, f"{path}/totals/batch_id={old}")

    return _start(flights, path, job.name, params.watermark_delay, params, interval, build, handle)


def start_q2_global(
    flights: Flights, path: str, params: JobParams = JobParams(), interval: str | None = None,
    sinks: Sequence[BatchSink] = (), start_ms: int | None = None,
) -> RunningStream:
    """Ranking since the start, one snapshot per interval that the watermark has passed."""
    return _since_start_stream(flights, _q2_global(params, start_ms), path, params, interval, sinks)


def start_q3_global(
    flights: Flights, path: str, params: JobParams = JobParams(), interval: str | None = None,
    sinks: Sequence[BatchSink] = (), start_ms: int | None = None,
) -> RunningStream:
    """Distribution since the start, one snapshot per interval that the watermark has passed."""
    return _since_start_stream(flights, _q3_global(params, start_ms), path, params, interval, sinks)


# --- late rows and latency ----------------------------------------------------------------------------


def start_late_split(
    flights: Flights, path: str, window: str, params: JobParams = JobParams(), interval: str | None = None,
    keep: Callable[[DataFrame], DataFrame] = active_flights, query: str = "q2",
) -> RunningStream:
    """Only the late side output of one query window, in ``late``: the rows that the result itself leaves out."""
    delay = params.watermark_delay + params.lateness_for(query if query == "q1" else f"{query}_{window}")

    def build(rows: DataFrame) -> DataFrame:
        ended = keep(rows).withColumn("window_end", end_of_window(F.col("event_ms"), window_ms(window)))
        return ended.select(F.struct("*").alias("late"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        mark = batch_watermark(batch.sparkSession, f"{path}/checkpoint", batch_id)
        write_batch(_late_part(batch.where(_is_late(mark)), mark), f"{path}/late", batch_id)

    return _start(flights, path, f"late_{query}_{window}", delay, params, interval, build, handle)


def start_latency(
    flights: Flights, path: str, window: str, params: JobParams = JobParams(), interval: str | None = None,
    keep: Callable[[DataFrame], DataFrame] = active_flights, key: str = "origin_airport_id", step: str = "q2_window",
) -> RunningStream:
    """Latency samples of one windowed step: when a window is emitted against when its rows came in.

    Samples go to ``path/samples``; ``latency_stats`` over them gives the percentiles.
    """
    delay = params.watermark_delay + params.allowed_lateness

    def handle(batch: DataFrame, batch_id: int) -> None:
        emitted = F.unix_millis(F.current_timestamp())
        write_batch(latency.latencies(batch, emitted, step), f"{path}/samples", batch_id)

    return _start(
        flights, path, f"latency_{step}_{window}", delay, params, interval,
        lambda rows: latency.ingest_bounds(keep(rows), window, key), handle)


# --- the whole job ------------------------------------------------------------------------------------

RESULT_NAMES = ("q1", "q2_1h", "q2_6h", "q2_global", "q3_1d", "q3_7d", "q3_global")


def _start_intake(flights: DataFrame, path: str, name: str, interval: str | None) -> RunningStream:
    """Judges each row of a source once and keeps it in ``path/rows``, where any number of streams read it.

    Spark's file sink lists what a batch has written in one step, so a batch that is run again is not read twice.
    """
    spark, rows = flights.sparkSession, judged_flights(flights)
    make_folder(spark, f"{path}/rows")

    def start() -> StreamingQuery:
        ProgressWriter.of(spark).follow(name, path)
        return (
            rows.writeStream.queryName(name).option("checkpointLocation", f"{path}/checkpoint")
            .trigger(**trigger(interval)).format("parquet").start(f"{path}/rows")
        )

    return RunningStream(start(), spark, path, rows.schema, start)


def start_all(
    flights: Flights, base: str, params: JobParams = JobParams(), interval: str | None = None,
    sinks: dict[str, Sequence[BatchSink]] | None = None,
) -> RunningStreams:
    """The whole job, a query to a result: seven results, late rows of the windowed ones, counters, latency samples.

    Each result has its own folder ``base/<name>``, with a checkpoint of its own, and fails or restarts alone. Each input
    is read and judged by one query, whose rows in ``base/intake_<n>`` all results read; a drained run waits for it first.
    """
    inputs = [flights] if isinstance(flights, DataFrame) else list(flights)
    intakes = [_start_intake(f, f"{base}/intake_{i}", f"intake_{i}", interval) for i, f in enumerate(inputs)]
    if not interval:
        for intake in intakes:
            intake.awaitTermination()
    flights = [parquet_stream(i.spark, f"{i.path}/rows", i.schema) for i in intakes]
    extra = sinks or {}
    at = lambda name: (f"{base}/{name}", params, interval, extra.get(name, ()))
    started = [_window_stream(flights, r, *at(r.name), False) for r in (
        _q1(params), _q2("1h", params), _q2("6h", params), _q3("1d", params), _q3("7d", params))]
    started += [_since_start_stream(flights, job, *at(job.name)) for job in (
        _q2_global(params, None), _q3_global(params, None))]
    started.append(start_latency(flights, f"{base}/latency", "1h", params, interval))
    return RunningStreams(started, intakes)


def start_console(df: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Console sink for a stream of rows."""
    return (
        df.writeStream.format("console").option("truncate", "false")
        .option("checkpointLocation", checkpoint).trigger(**trigger(interval)).start()
    )
