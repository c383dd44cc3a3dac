"""Streams against the batch answer, over fixed micro-batches."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from skyledger.operators import airports, carrier, delays
from skyledger.operators.clean import clean
from skyledger.operators.latency import latency_stats
from skyledger.params import JobParams
from skyledger.plans.registry import LOG_START_MS, PARAMS
from skyledger.schema import FLIGHT_SCHEMA
from skyledger.sinks import encode
from skyledger.sources.flights_view import flights_from_events, read_events
from skyledger.sources.json_events import encode_source
from skyledger.sources.streams import json_file_flights, parquet_stream
from skyledger.streaming import jobs
from skyledger.streaming.checkpoints import checkpoint_uri, trigger
from skyledger.sinks.result_table import batch_ids
from skyledger.streaming.progress import step_durations
from tests.conftest import SF_SMALL
from tests.helpers import flights

NO_GRACE = JobParams(watermark_delay=0, allowed_lateness=0, min_flights=1, state_partitions=1)


def _feed(spark, path, run, *parts):
    """One drained run per part; the query restarts from its checkpoint every time."""
    queries = []
    for part in parts:
        part.write.mode("append").parquet(f"{path}/in")
        query = run(parquet_stream(spark, f"{path}/in", FLIGHT_SCHEMA))
        query.awaitTermination()
        queries.append(query)
    return queries


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_q1_closes_windows_and_drops_late_rows(spark, tmp_path):
    base = str(tmp_path)
    queries = _feed(
        spark, base, lambda f: jobs.start_q1(f, base, NO_GRACE),
        flights(spark, dict(crs_dep_time=805), dict(crs_dep_time=910)),
        # Late for 08, which has closed; in time for 09.
        flights(spark, dict(crs_dep_time=830), dict(crs_dep_time=920), dict(crs_dep_time=1000)),
    )
    out = jobs.read_stream_results(spark, base, "q1").orderBy("window_start").collect()
    assert [(r.window_start % 86_400_000 // 3_600_000, r.num_flights) for r in out] == [(8, 1), (9, 2)]
    late = jobs.late_rows_seen(spark, base).collect()
    assert [(r.event_ms % 86_400_000 // 60_000, r.lateness_min) for r in late] == [(510, 10.0)]
    steps = [(r.step, r.metric) for r in step_durations(spark, base).collect()]
    # Each batch of rows, and the one behind it that emits what the watermark has passed.
    assert steps.count(("q1", "operator_addBatch_ms")) == 4
    # The end of the input closes the last window for good.
    queries[1].finish()
    assert _counts(spark, base, "q1") == [(8, 1), (9, 2), (10, 1)]
    _feed(spark, base, lambda f: jobs.start_q1(f, base, NO_GRACE), flights(spark, dict(crs_dep_time=1010)))
    assert _counts(spark, base, "q1") == [(8, 1), (9, 2), (10, 1)]
    assert jobs.late_rows_seen(spark, base).count() == 2


def _counts(spark, path, name):
    out = jobs.read_stream_results(spark, path, name).orderBy("window_start").collect()
    return [(r.window_start % 86_400_000 // 3_600_000, r.num_flights) for r in out]


def test_a_rejected_or_filtered_row_moves_the_watermark(spark, tmp_path):
    """The watermark belongs to the source: a cancelled flight of 10:00 closes the hour 08 of a ranking."""
    base = str(tmp_path)
    parts = (
        flights(spark, dict(crs_dep_time=805), dict(crs_dep_time=1000, cancelled=1.0)),
        flights(spark, dict(crs_dep_time=830), dict(crs_dep_time=1010)),
    )
    _feed(spark, f"{base}/q2", lambda f: jobs.start_q2(f, f"{base}/q2", "1h", NO_GRACE), *parts)[-1].finish()
    _feed(spark, f"{base}/late", lambda f: jobs.start_late_split(f, f"{base}/late", "1h", NO_GRACE), *parts)
    assert _counts(spark, f"{base}/q2", "q2_1h") == [(8, 1), (10, 1)]
    lost = spark.read.parquet(f"{base}/late/late").select("event_ms").collect()
    assert lost == jobs.late_rows_seen(spark, f"{base}/q2").select("event_ms").collect() and len(lost) == 1


def test_results_are_corrected_while_their_windows_are_open(spark, tmp_path):
    """With corrections a window is emitted whenever it changes, and late rows that are allowed change it again."""
    params = replace(NO_GRACE, allowed_lateness=24 * 60)
    parts = (
        flights(spark, dict(crs_dep_time=805), dict(day_of_month=2, crs_dep_time=10)),
        flights(spark, dict(crs_dep_time=830, dep_delay=60.0), dict(crs_dep_time=2300)),
        # Too late: the watermark has passed the window and the allowed lateness.
        flights(spark, dict(day_of_month=4)),
        flights(spark, dict(crs_dep_time=840)),
    )
    for name, run in (
        ("q1", lambda f, path: jobs.start_q1(f, path, params, sinks=[sink], corrections=True)),
        ("q2_1h", lambda f, path: jobs.start_q2(f, path, "1h", params, sinks=[sink], corrections=True)),
        ("q3_1d", lambda f, path: jobs.start_q3(f, path, "1d", params, sinks=[sink], corrections=True)),
    ):
        versions = []
        n = "count" if name == "q3_1d" else "num_flights"
        sink = lambda rows, _: versions.extend(r[n] for r in rows.orderBy("window_start").limit(1).collect())
        path = f"{tmp_path}/{name}"
        _feed(spark, path, lambda f: run(f, path), *parts)
        first = jobs.read_stream_results(spark, path, name).orderBy("window_start", *(["hour"] if n == "count" else [])).first()
        assert versions[0] == 1 and 2 in versions, name
        assert first["num_flights" if name != "q3_1d" else "count"] == 2
        assert jobs.late_rows_seen(spark, path).count() == 1


def test_spark_drops_as_many_rows_as_leave_as_late(spark, tmp_path):
    """One row to a key and window, as the state counts what a task has summed up."""
    early = flights(spark, *[dict(crs_dep_time=100 * h + 5, airline=a) for h in (7, 8) for a in ("AA", "DL")],
                    dict(day_of_month=9))
    late = flights(spark, *[dict(crs_dep_time=100 * h + 5, airline=a, origin_airport_id=o, dep_delay=float(h))
                            for h in (7, 8) for o, a in ((1, "AA"), (2, "DL"))], dict(crs_dep_time=1275))
    for name, run in (
        ("q1", lambda f, path: jobs.start_q1(f, path, NO_GRACE)),
        ("q2_1h", lambda f, path: jobs.start_q2(f, path, "1h", NO_GRACE)),
        ("q3_1d", lambda f, path: jobs.start_q3(f, path, "1d", NO_GRACE)),
    ):
        path = f"{tmp_path}/{name}"
        _feed(spark, path, lambda f: run(f, path), early, late)
        assert jobs.late_rows_seen(spark, path).count() == jobs.dropped_rows(spark, path) == 4


def test_ranking_of_more_airports_than_it_keeps(spark, tmp_path):
    rows = flights(spark, *[
        dict(origin_airport_id=o, dep_delay=60.0 if i < o % 13 else 5.0) for o in range(1, 30) for i in range(13)])
    for corrections in (False, True):
        path = f"{tmp_path}/{corrections}"
        _feed(spark, path, lambda f: jobs.start_q2(f, path, "1h", NO_GRACE, corrections=corrections), rows)[0].finish()
        want = airports.airport_ranking(clean(rows), "1h", NO_GRACE)
        got = jobs.read_stream_results(spark, path, "q2_1h")
        assert got.count() == 10 and _rows(got.select(*want.columns)) == _rows(want)


@pytest.mark.parametrize("policy", ["min", "max"])
def test_several_inputs_have_a_watermark_each(spark, tmp_path, policy):
    """The slower input holds the watermark back, or the faster one drives it."""
    params = replace(NO_GRACE, watermark_policy=policy)
    for name, hours in (("slow", (800, 810)), ("fast", (805, 1200))):
        flights(spark, *[dict(crs_dep_time=h) for h in hours]).write.parquet(f"{tmp_path}/{name}")
    inputs = [parquet_stream(spark, f"{tmp_path}/{name}", FLIGHT_SCHEMA) for name in ("slow", "fast")]
    base = f"{tmp_path}/q1"
    stream = jobs.start_q1(inputs, base, params)
    stream.awaitTermination()
    if policy == "max":
        assert _counts(spark, base, "q1") == [(8, 3)]
    else:
        assert not (tmp_path / "q1" / "results").exists()
    stream.finish()
    assert _counts(spark, base, "q1") == [(8, 3), (12, 1)]


def test_a_batch_that_fails_is_run_again(spark, tmp_path, log_parts):
    """An error behind the result table, before the batch is committed; the restart finds state and table as they were."""
    params = replace(PARAMS, watermark_delay=0, allowed_lateness=0, min_flights=1, state_partitions=1)
    seen = []

    def sink(rows, number):
        seen.append(number)
        if len(seen) == 1:
            raise RuntimeError("the sink is down")

    cleaned = clean(log_parts[0].unionByName(log_parts[1]))
    for name, run, want in (
        ("q1", jobs.start_q1, carrier.carrier_performance(cleaned, params)),
        ("q2_global", jobs.start_q2_global, airports.airport_since_start(cleaned, params)),
    ):
        seen.clear()
        path = f"{tmp_path}/{name}"
        log_parts[0].write.parquet(f"{path}/in")
        start = lambda: run(parquet_stream(spark, f"{path}/in", FLIGHT_SCHEMA), path, params, sinks=[sink])
        with pytest.raises(Exception, match="sink is down"):
            start().awaitTermination()
        start().awaitTermination()
        assert seen[0] == seen[1]
        log_parts[1].write.mode("append").parquet(f"{path}/in")
        start().finish()
        assert _rows(jobs.read_stream_results(spark, path, name).select(*want.columns)) == _rows(want)


def test_rows_counted_and_rows_lost_are_all_rows(spark, tmp_path, log_parts):
    base = str(tmp_path)
    params = replace(PARAMS, watermark_delay=0, allowed_lateness=0, min_flights=1, top_airports=100)
    early, late = log_parts
    mixed = late.where("day_of_month % 5 <> 0"), early.unionByName(late.where("day_of_month % 5 = 0"))
    _feed(spark, base, lambda f: jobs.start_q2(f, base, "1h", params), *mixed)[-1].finish()
    counted = jobs.read_stream_results(spark, base, "q2_1h").agg(F.sum("num_flights")).first()[0]
    lost = jobs.late_rows_seen(spark, base).count()
    active = clean(early.unionByName(late)).where("NOT is_cancelled AND NOT is_diverted").count()
    assert lost > 0 and counted + lost == active


def test_a_late_row_counts_in_the_next_snapshot(spark, tmp_path):
    base = str(tmp_path)
    _feed(
        spark, base, lambda f: jobs.start_q2_global(f, base, NO_GRACE),
        flights(spark, dict(crs_dep_time=805), dict(crs_dep_time=1000)),
        flights(spark, dict(crs_dep_time=830), dict(crs_dep_time=1200)),
    )[-1].finish()
    out = jobs.read_stream_results(spark, base, "q2_global").orderBy("window_end").collect()
    assert [(r.window_end % 86_400_000 // 3_600_000, r.num_flights) for r in out] == [
        (9, 1), (10, 1), (11, 3), (12, 3), (13, 4)]


def test_folders_stay_few_and_counters_add_up(spark, tmp_path):
    base = str(tmp_path)
    parts = [flights(spark, dict(crs_dep_time=100 * h + 5), dict(crs_dep_time=1275)) for h in range(6)]
    _feed(spark, base, lambda f: jobs.start_q2_global(f, base, NO_GRACE), *parts)[-1].finish()
    assert [h for h, _ in _counts(spark, base, "q2_global")] == [0] * 6
    assert len(batch_ids(spark, f"{base}/totals")) <= 2
    assert len(batch_ids(spark, f"{base}/results/pending")) == 1
    counts = {r.counter: r["rows"] for r in jobs.counters(spark, base).collect()}
    assert counts == {"rows_in": 12, "rejected_event_time": 6}
    # Six runs of two batches, and two for the closing row.
    assert step_durations(spark, base).where("metric = 'operator_addBatch_ms'").count() == 14


def test_q1_updates_correct_an_early_row(spark, tmp_path):
    base = str(tmp_path)
    params = replace(NO_GRACE, allowed_lateness=60)
    seen = []
    _feed(
        spark, base,
        lambda f: jobs.start_q1(f, base, params, sinks=[lambda rows, batch: seen.append((batch, rows.count()))], corrections=True),
        flights(spark, dict(crs_dep_time=805), dict(crs_dep_time=910)),
        flights(spark, dict(crs_dep_time=830, dep_delay=60.0)),
    )
    out = jobs.read_stream_results(spark, base, "q1").orderBy("window_start").collect()
    assert [(r.num_flights, r.dep_delay_mean) for r in out] == [(2, 30.0), (1, 0.0)]
    assert [n for _, n in seen] == [2, 1]


def test_latency_samples(spark, tmp_path):
    base = str(tmp_path)
    _feed(
        spark, base, lambda f: jobs.start_latency(f, base, "1h", NO_GRACE),
        flights(spark, dict(ingest_ms=1_000_000), dict(ingest_ms=3_000_000), dict(crs_dep_time=1000)),
    )
    samples = spark.read.parquet(f"{base}/samples")
    got = {r.metric: r.latency_ms for r in samples.collect()}
    assert got["e2e_oldest_ms"] - got["e2e_newest_ms"] == 2_000_000
    assert got["e2e_oldest_ms"] - got["e2e_avg_ms"] == 1_000_000
    assert {r.step for r in latency_stats(samples).collect()} == {"q2_window"}


def test_lateness_overrides():
    params = JobParams(allowed_lateness=5, lateness_overrides={"q2_6h": 20})
    assert (params.lateness_for("q2_6h"), params.lateness_for("q1")) == (20, 5)


@pytest.fixture(scope="module")
def log_parts(spark):
    """The small log in two parts by event time."""
    cleaned = flights_from_events(read_events(spark, SF_SMALL))
    rows = cleaned.select(*FLIGHT_SCHEMA.names).cache()
    return rows.where("day_of_month <= 14"), rows.where("day_of_month > 14")


def test_q2_equals_batch(spark, tmp_path, log_parts):
    base = str(tmp_path)
    params = replace(PARAMS, watermark_delay=0, allowed_lateness=0, min_flights=1, state_partitions=1)
    _feed(spark, base, lambda f: jobs.start_q2(f, base, "6h", params), *log_parts)[-1].finish()
    cleaned = clean(log_parts[0].unionByName(log_parts[1]))
    want = airports.airport_ranking(cleaned, "6h", params)
    assert _rows(jobs.read_stream_results(spark, base, "q2_6h").select(*want.columns)) == _rows(want)


def test_equal_flights_are_listed_as_often_as_they_occur(spark, tmp_path):
    base = str(tmp_path)
    _feed(
        spark, base, lambda f: jobs.start_q2(f, base, "1h", NO_GRACE),
        flights(spark, *[dict(dep_delay=99.0)] * 25, dict(dep_delay=100.0), dict(crs_dep_time=1000)),
    )
    row = jobs.read_stream_results(spark, base, "q2_1h").first()
    assert (row.num_flights, row.severe_delays) == (26, 26)
    assert [f.dep_delay for f in row.delayed_flights] == [100.0] + [99.0] * 19


def test_global_streams_carry_totals_over_a_restart(spark, tmp_path, log_parts):
    params = replace(PARAMS, watermark_delay=0, allowed_lateness=0, min_flights=1, state_partitions=1)
    cleaned = clean(log_parts[0].unionByName(log_parts[1]))
    q2, q3 = f"{tmp_path}/q2", f"{tmp_path}/q3"
    _feed(spark, q2, lambda f: jobs.start_q2_global(f, q2, params), *log_parts)[-1].finish()
    want = airports.airport_since_start(cleaned, params)
    assert want.agg(F.max("window_end")).first()[0] > LOG_START_MS + 28 * 86_400_000
    assert _rows(jobs.read_stream_results(spark, q2, "q2_global").select(*want.columns)) == _rows(want)

    _feed(spark, q3, lambda f: jobs.start_q3_global(f, q3, params), *log_parts)[-1].finish()
    want = delays.delay_since_start(cleaned, params)
    assert _rows(jobs.read_stream_results(spark, q3, "q3_global").select(*want.columns)) == _rows(want)


def test_a_repeated_batch_changes_nothing(spark, tmp_path, log_parts):
    """A batch whose commit was lost runs again after the restart, into the same folders."""
    base = str(tmp_path)
    params = replace(PARAMS, watermark_delay=0, allowed_lateness=0, min_flights=1, state_partitions=1)
    _feed(spark, base, lambda f: jobs.start_q2_global(f, base, params), *log_parts)
    before = _rows(jobs.read_stream_results(spark, base, "q2_global"))
    commits = tmp_path / "checkpoint" / "commits"
    newest = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    newest.unlink()
    crc = commits / f".{newest.name}.crc"
    if crc.exists():
        crc.unlink()
    jobs.start_q2_global(parquet_stream(spark, f"{base}/in", FLIGHT_SCHEMA), base, params).awaitTermination()
    assert _rows(jobs.read_stream_results(spark, base, "q2_global")) == before


def test_all_streams_from_json_files(spark, tmp_path):
    source = flights(spark, dict(dep_delay=40.0), dict(day_of_month=20))
    upper = {"airline": "OP_UNIQUE_CARRIER"}
    named = source.drop("ingest_ms").select(*[
        F.col(c).alias(upper.get(c, c.upper())) for c in source.columns if c != "ingest_ms"
    ])
    encode_source(named).write.text(f"{tmp_path}/in")
    messages = {}

    def keep(name):
        return lambda rows, batch: messages.setdefault(name, []).extend(encode.ENCODERS[name](rows).collect())

    names = encode.ENCODERS
    started = jobs.start_all(
        json_file_flights(spark, f"{tmp_path}/in"), str(tmp_path), NO_GRACE, sinks={n: [keep(n)] for n in names})
    started.finish()
    assert set(messages) == set(names) == set(jobs.RESULT_NAMES)
    q1 = jobs.read_stream_results(spark, f"{tmp_path}/q1", "q1")
    assert _rows(q1) == _rows(carrier.carrier_performance(clean(source), NO_GRACE))
    assert {r.counter: r["rows"] for r in jobs.counters(spark, f"{tmp_path}/q1").collect()} == {"rows_in": 2}
    assert spark.read.parquet(f"{tmp_path}/latency/samples").count() == 6


def test_all_streams_read_their_source_once(spark, tmp_path):
    """Whatever number of results there are, each input is read by one query, over a restart too."""
    base = str(tmp_path)
    parts = (
        flights(spark, dict(crs_dep_time=805, dep_delay=40.0), dict(crs_dep_time=1275), dict(airline=" ")),
        flights(spark, dict(crs_dep_time=830), dict(day_of_month=2, cancelled=1.0, diverted=1.0), dict(day_of_month=2)),
        # Late by now.
        flights(spark, dict(crs_dep_time=840), dict(day_of_month=3)),
    )
    read = {}
    for i, part in enumerate(parts):
        for name in ("a", "b"):
            part.write.mode("append").parquet(f"{base}/in_{name}")
        inputs = [parquet_stream(spark, f"{base}/in_{name}", FLIGHT_SCHEMA) for name in ("a", "b")]
        started = jobs.start_all(inputs, base, NO_GRACE)
        started.awaitTermination() if i < 2 else started.finish()
        for stream in [*started.intakes, *started.streams]:
            for progress in stream.query.recentProgress if i < 2 else ():
                for source in progress.sources:
                    if "/in_" in source.description:
                        read[progress.name] = read.get(progress.name, 0) + source.numInputRows
    assert read == {"intake_0": 6, "intake_1": 6}
    assert [n for _, n in _counts(spark, f"{base}/q1", "q1")] == [4, 2, 2]
    assert {r.counter: r["rows"] for r in jobs.counters(spark, f"{base}/q1").collect()} == {
        "rows_in": 16, "rejected_completeness": 2, "rejected_event_time": 2, "rejected_contradiction": 2}
    assert jobs.late_rows_seen(spark, f"{base}/q1").count() == 2
    assert jobs.read_stream_results(spark, f"{base}/q3_global", "q3_global").agg(F.max("count")).first()[0] > 0


def test_checkpoint_locations():
    assert checkpoint_uri("HDFS", "/a/b", namenode="hdfs://n:1/") == "hdfs://n:1/a/b"
    assert checkpoint_uri("s3", "/a", bucket="b") == "s3a://b/a"
    assert checkpoint_uri("local", "/a") == "file:///a"
    for bad in (("hdfs", "/a"), ("s3", "/a"), ("local", ""), ("ftp", "/a")):
        with pytest.raises(ValueError):
            checkpoint_uri(*bad)
    assert trigger(None) == {"availableNow": True}
    assert trigger("5 seconds") == {"processingTime": "5 seconds"}
