from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from skyledger.operators import airports, carrier, delays, late, latency
from skyledger.operators.clean import clean, global_average_delay, observe_rejects
from skyledger.params import JobParams
from skyledger.plans.batch_job import RESULTS, run_batch
from skyledger.plans.registry import LOG_START_MS, PARAMS
from skyledger.sources.flights_view import flights_from_events, read_events
from tests.conftest import SF
from tests.helpers import flights, ms

P = JobParams(min_flights=1)


def test_carrier_rates_use_different_denominators(spark):
    rows = flights(
        spark, dict(cancelled=1.0, dep_delay=500.0), dict(dep_delay=20.0), dict(dep_delay=15.0, diverted=1.0),
        dict(dep_delay=None),
    )
    row = carrier.carrier_performance(clean(rows)).first()
    assert (row.num_flights, row.completed, row.cancelled, row.diverted) == (4, 2, 1, 1)
    assert row.dep_delay_mean == 11.67  # (20 + 15 + 0) / 3
    assert row.cancellation_rate == 25.0
    assert row.late_departure_rate == 33.33
    assert row.window_start == ms("2025-01-01T08:00:00")
    assert row.window_end - row.window_start == 3_600_000


def test_all_cancelled(spark):
    row = carrier.carrier_performance(clean(flights(spark, dict(cancelled=1.0)))).first()
    assert (row.dep_delay_mean, row.cancellation_rate, row.late_departure_rate) == (0.0, 100.0, 0.0)


def test_ranking_order(spark):
    rows = []
    # Equal severe counts and equal rounded means (unrounded they differ): the lower id goes first.
    rows += [dict(origin_airport_id=5, dep_delay=40.004), dict(origin_airport_id=3, dep_delay=40.001)]
    # More severe delays beat a higher mean.
    rows += [dict(origin_airport_id=9, dep_delay=31.0), dict(origin_airport_id=9, dep_delay=31.0)]
    rows += [dict(origin_airport_id=1, dep_delay=90.0)]
    out = airports.airport_ranking(clean(flights(spark, *rows)), "1h", P).orderBy("rank").collect()
    assert [(r.rank, r.origin_airport_id) for r in out] == [(1, 9), (2, 1), (3, 3), (4, 5)]
    assert out[0].window_type == "1h"


def test_min_flights_and_top_n(spark):
    rows = [dict(origin_airport_id=i, dep_delay=float(i)) for i in range(1, 15) for _ in range(2)]
    rows.append(dict(origin_airport_id=99, dep_delay=1000.0))
    out = airports.airport_ranking(clean(flights(spark, *rows)), "6h", replace(P, min_flights=2)).collect()
    assert len(out) == 10
    assert 99 not in {r.origin_airport_id for r in out}


def test_worst_flights(spark):
    rows = [dict(dep_delay=30.0)] + [dict(dep_delay=31.0 + i, dest_airport_id=20000 + i) for i in range(25)]
    rows += [dict(dep_delay=55.0, airline="UA"), dict(dep_delay=60.0, cancelled=1.0)]
    row = airports.airport_ranking(clean(flights(spark, *rows)), "1h", P).first()
    listed = row.delayed_flights
    assert len(listed) == 20
    # Equal delays: by carrier, then destination.
    assert [(f.carrier, f.dep_delay) for f in listed[:2]] == [("AA", 55.0), ("UA", 55.0)]
    assert [f.dep_delay for f in listed] == sorted((f.dep_delay for f in listed), reverse=True)
    assert row.severe_delays == 26


def test_no_severe_flights_gives_an_empty_list(spark):
    assert airports.airport_ranking(clean(flights(spark, {})), "1h", P).first().delayed_flights == []


def test_cumulative_worst_matches_brute_force(spark):
    import random

    rng = random.Random(11)
    lists = []
    for airport in (1, 2):
        for hour in sorted(rng.sample(range(200), 90)):
            entries = sorted((-float(rng.randrange(31, 300)), "AA", str(rng.randrange(5))) for _ in range(rng.randrange(1, 5)))
            lists.append((airport, hour, entries[:4]))
    schema = "origin_airport_id int, window_end long, worst array<struct<neg:double,carrier:string,dest:string>>"
    got = {
        (r.origin_airport_id, r.window_end): [tuple(f) for f in r.worst]
        for r in airports.cumulative_worst(spark.createDataFrame(lists, schema), 4, 128).collect()
    }
    for airport, hour, _ in lists:
        seen = sorted(f for a, h, fs in lists if a == airport and h <= hour for f in fs)
        assert got[airport, hour] == seen[:4]


def test_cumulative_worst_without_a_bound(spark):
    schema = "origin_airport_id int, window_end long, worst array<struct<neg:double,carrier:string,dest:string>>"
    lists = spark.createDataFrame([(1, h, [(-40.0 - h, "AA", "1")]) for h in range(90)], schema)
    got = {r.window_end: [f.neg for f in r.worst] for r in airports.cumulative_worst(lists, 4).collect()}
    assert all(got[h] == [-40.0 - x for x in range(h, max(-1, h - 4), -1)] for h in range(90))


@pytest.mark.parametrize("hours", [2, 5, 48])
def test_any_snapshot_interval(spark, hours):
    params = replace(P, airport_snapshot_ms=hours * 3_600_000, delay_snapshot_ms=hours * 3_600_000)
    cleaned = clean(flights(spark, dict(crs_dep_time=30), dict(crs_dep_time=2330, dep_delay=50.0), dict(day_of_month=9)))
    for rows in (airports.airport_since_start(cleaned, params), delays.delay_since_start(cleaned, params)):
        ends = sorted({r.window_end for r in rows.collect()})
        assert {b - a for a, b in zip(ends, ends[1:])} == {hours * 3_600_000}
        assert ends[-1] > ms("2025-01-09T08:00:00") >= ends[-1] - hours * 3_600_000


def test_a_silence_of_many_years(spark):
    params = replace(P, airport_snapshot_ms=24 * 3_600_000)
    cleaned = clean(flights(spark, {}, dict(year=2125)))
    rows = airports.airport_since_start(cleaned, params)
    assert rows.count() == 36525 and rows.agg(F.max("num_flights")).first()[0] == 2


def test_snapshots_repeat_silent_airports(spark):
    rows = [
        dict(origin_airport_id=1, crs_dep_time=30, dep_delay=50.0),
        dict(origin_airport_id=2, crs_dep_time=330, dep_delay=31.0),
        dict(origin_airport_id=2, crs_dep_time=340, dep_delay=32.0),
    ]
    out = airports.airport_since_start(clean(flights(spark, *rows)), P).collect()
    start = ms("2025-01-01T00:00:00")
    got = {((r.window_end - start) // 3_600_000, r.rank): (r.origin_airport_id, len(r.delayed_flights)) for r in out}
    assert got == {(1, 1): (1, 1), (2, 1): (1, 1), (3, 1): (1, 1), (4, 1): (2, 2), (4, 2): (1, 1)}
    assert {r.window_start for r in out} == {start}


def test_delay_snapshots(spark):
    rows = [dict(dep_delay=10.0), dict(dep_delay=20.0, day_of_month=3), dict(dep_delay=7.0, airline="DL", day_of_month=2)]
    out = delays.delay_since_start(clean(flights(spark, *rows))).orderBy("window_end", "airline").collect()
    assert [(r.airline, r["count"], r.min, r.max) for r in out] == [
        ("AA", 1, 10.0, 10.0), ("AA", 1, 10.0, 10.0), ("DL", 1, 7.0, 7.0), ("AA", 2, 10.0, 20.0), ("DL", 1, 7.0, 7.0),
    ]


def test_weeks_start_on_thursday(spark):
    row = delays.delay_distribution(clean(flights(spark, dict(day_of_month=5))), "7d").first()
    assert (row.window_start, row.window_end) == (ms("2025-01-02T00:00:00"), ms("2025-01-09T00:00:00"))


def test_delay_hour_slot_of_midnight(spark):
    row = delays.delay_distribution(clean(flights(spark, dict(crs_dep_time=2400))), "1d").first()
    assert (row.hour, row.window_start) == (0, ms("2025-01-01T00:00:00"))


def test_global_average(spark):
    assert global_average_delay(clean(flights(spark, dict(dep_delay=3.0), dict(dep_delay=None)))).first()[0] == 1.5


def test_observed_rejects(spark):
    from pyspark.sql import Observation

    seen = Observation("rejects_test")
    rows = flights(spark, {}, dict(airline=" "), dict(crs_dep_time=2500))
    observe_rejects(rows, seen).count()
    assert seen.get == {"corrupted_records_total": 2, "completeness": 1, "event_time": 1, "contradiction": 0}


def _arrivals(spark, *rows):
    """(event minute of day, arrival minute of day) pairs as cleaned flights."""
    out = flights(spark, *[dict(crs_dep_time=e // 60 * 100 + e % 60, ingest_ms=a) for e, a in rows])
    day = ms("2025-01-01T00:00:00")
    return clean(out).withColumn("publish_ms", F.lit(day) + F.col("ingest_ms") * 60_000)


def test_watermark_replay(spark, tmp_path):
    # 00:50 arrives when 01:10 has been seen in an earlier minute: its window ended 10 minutes before.
    rows = _arrivals(spark, (10, 10), (70, 70), (50, 80), (71, 80))
    marks = late.arrival_watermarks(rows)
    start = ms("2025-01-01T00:00:00")
    assert sorted((r.arrival_minute - start // 60_000, r.seen_ms) for r in marks.collect()) == [
        (10, None), (70, start + 10 * 60_000), (80, start + 70 * 60_000)
    ]
    report = late.late_report(rows, marks, ("AA",), [(10, 0), (11, 0), (5, 5), (5, 6)]).where("query = 'q1'")
    got = {(r.watermark_delay, r.allowed_lateness): (r.on_time, r["update"], r.lost) for r in report.collect()}
    assert got == {(10, 0): (3, 0, 1), (11, 0): (4, 0, 0), (5, 5): (3, 0, 1), (5, 6): (3, 1, 0)}
    lost = late.late_rows(rows, marks, "1h", 0, 0, str(tmp_path)).collect()
    assert [(r.event_ms, r.lateness_min) for r in lost] == [(start + 50 * 60_000, 10.0)]


def test_watermark_replay_across_days(spark, tmp_path):
    rows = _arrivals(spark, (10, 10), (1430, 1430), (20, 1441), (30, 2900))
    seen = [r.seen_ms for r in late.arrival_watermarks(rows).orderBy("arrival_minute").collect()]
    start = ms("2025-01-01T00:00:00")
    assert seen == [None, start + 10 * 60_000, start + 1430 * 60_000, start + 1430 * 60_000]


def test_lateness_counts_only_above_zero(spark):
    df = spark.createDataFrame([(1.5, 2), (0.0, 5)], "lateness_min double, cnt int")
    row = late.lateness_summary(df).first()
    assert (row.total_late_records, row.max_lateness_minutes) == (2, 1)
    assert row.lateness_p99 == pytest.approx(1.5, rel=0.0101)
    empty = late.lateness_summary(df.where("lateness_min > 9")).first()
    assert tuple(empty) == (0, 0, 0.0, 0.0, 0.0, 0.0)


def test_ingest_bounds_ignore_zero_times(spark):
    rows = clean(flights(spark, dict(ingest_ms=0), dict(ingest_ms=10), dict(ingest_ms=15)))
    row = latency.ingest_bounds(rows, "1h", "airline").first()
    assert (row.newest_ingest_ms, row.oldest_ingest_ms, row.avg_ingest_ms, row.ingest_count) == (15, 10, 12, 2)
    stats = latency.latency_stats(latency.latencies(latency.ingest_bounds(rows, "1h", "airline"), F.lit(12), "s"))
    assert {r.metric: r.max for r in stats.collect()} == {
        "e2e_newest_ms": 0.0, "e2e_oldest_ms": 2.0, "e2e_avg_ms": 0.0
    }


def test_a_hot_airport_keeps_every_result_whole(spark):
    """A third of all rows in one airport and window: nothing is dropped or capped."""
    n = 60_000
    rows = spark.range(n).selectExpr(
        "2025 AS year", "1 AS month", "1 AS day_of_month", "'AA' AS airline", "800 AS crs_dep_time",
        "double(id % 500) AS dep_delay", "0D AS cancelled", "0D AS diverted",
        "int(if(id % 3 = 0, 1, 2 + id % 50)) AS origin_airport_id", "int(id) AS dest_airport_id", "1L AS ingest_ms",
    )
    out = airports.airport_ranking(clean(rows), "1h").where("origin_airport_id = 1").first()
    assert out.rank == 1 and out.num_flights == n // 3
    assert out.severe_delays == sum(1 for i in range(0, n, 3) if i % 500 > 30)
    assert [f.dep_delay for f in out.delayed_flights] == [499.0] * 20


def test_batch_job_equals_the_single_queries(spark, tmp_path):
    source = flights_from_events(read_events(spark, SF))
    params = replace(PARAMS, min_flights=3)
    got = run_batch(spark, source, f"{tmp_path}/work", f"{tmp_path}/out", params, LOG_START_MS)
    cleaned = clean(source)
    single = {
        "q1": carrier.carrier_performance(cleaned, params),
        "q2_1h": airports.airport_ranking(cleaned, "1h", params),
        "q2_6h": airports.airport_ranking(cleaned, "6h", params),
        "q2_global": airports.airport_since_start(cleaned, params),
        "q3_1d": delays.delay_distribution(cleaned, "1d", params),
        "q3_7d": delays.delay_distribution(cleaned, "7d", params),
        "q3_global": delays.delay_since_start(cleaned, params),
    }
    assert tuple(got) == RESULTS
    for name, want in single.items():
        assert sorted(map(repr, got[name].select(*want.columns).collect())) == sorted(map(repr, want.collect())), name
