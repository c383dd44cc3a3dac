import json

import pytest
from pyspark.sql import functions as F

from skyledger.operators import airports, carrier, delays
from skyledger.operators.clean import clean
from skyledger.params import JobParams, StreamSettings
from skyledger.schema import Q1_RESULT, Q2_RESULT
from skyledger.sinks import decode, encode, export, result_table
from skyledger.streaming.jobs import RESULT_NAMES
from tests.helpers import flights, ms

P = JobParams(min_flights=1)


def _q2(spark):
    rows = flights(spark, dict(dep_delay=45.0), dict(dep_delay=31.5, dest_airport_id=20009), dict(origin_airport_id=2))
    return airports.airport_ranking(clean(rows), "1h", P)


def test_encode_and_decode_q2(spark):
    messages = encode.encode_q2(_q2(spark))
    by_key = {r.key: json.loads(r.value) for r in messages.collect()}
    assert list(by_key["10001"]) == Q2_RESULT.names
    assert by_key["10001"]["delayed_flights"] == [
        {"carrier": "AA", "dest": "20001", "dep_delay": 45.0}, {"carrier": "AA", "dest": "20009", "dep_delay": 31.5}
    ]
    row = decode.decode_q2(messages).where("rank = '1'").select("*", F.unix_millis("time").alias("t")).first()
    assert (row.t, row.rank, row.window_type, row.num_flights) == (ms("2025-01-01T08:00:00"), "1", "1h", 2)
    assert json.loads(row.delayed_flights) == by_key["10001"]["delayed_flights"]


def test_decode_defaults(spark):
    row = decode.decode_q2(spark.createDataFrame([("{}",)], "value string")).first()
    assert (row.rank, row.window_type, row.num_flights, row.dep_delay_mean) == ("", "", 0, 0.0)
    assert (row.time, row.delayed_flights) == (None, "[]")


def test_q1_and_q3_messages(spark):
    cleaned = clean(flights(spark, dict(dep_delay=7.0)))
    q1 = encode.encode_q1(carrier.carrier_performance(cleaned))
    assert q1.first().key == "AA"
    row = decode.decode_q1(q1).first()
    assert (row.airline, row.num_flights, row.window_end, row.dep_delay_mean) == ("AA", 1, float(ms("2025-01-01T09:00:00")), 7.0)
    q3 = encode.encode_q3(delays.delay_distribution(cleaned, "1d"))
    assert q3.first().key is None
    row = decode.decode_q3(q3).first()
    assert (row.hour, row["count"], row.window_end, row.p50) == ("8", 1, ms("2025-01-02T00:00:00"), pytest.approx(7.0396478))


def test_every_result_has_a_destination():
    assert set(RESULT_NAMES) == set(encode.ENCODERS) == set(result_table.RESULT_KEYS)


def _point(start, end, rank, value):
    return (start, end, "global", rank, 1, value, 0, 0.0, 0.0, [])


def test_last_write_wins(spark, tmp_path):
    batches = [
        [_point(0, 1, 1, 10), _point(0, 1, 2, 11)], [_point(0, 2, 1, 20)], [_point(0, 2, 1, 30), _point(0, 3, 1, 31)],
    ]

    def read(name, keys):
        path = str(tmp_path / name)
        for batch, rows in [*enumerate(batches), (1, batches[1]), (2, batches[2])]:  # two are delivered again
            result_table.upsert(spark.createDataFrame(rows, Q2_RESULT), path, batch, keys)
        rows = result_table.read_results(spark, path, Q2_RESULT).collect()
        return sorted((r.window_end, r["rank"], r.num_flights) for r in rows)

    assert read("a", result_table.RESULT_KEYS["q2_global"]) == [(1, 1, 10), (1, 2, 11), (2, 1, 30), (3, 1, 31)]
    # Without the window end one row per rank is left, and rank 2 is stale.
    assert read("b", result_table.POINT_KEYS["q2_global"]) == [(1, 2, 11), (3, 1, 31)]


def test_an_upsert_touches_its_days_alone(spark, tmp_path):
    path, keys = str(tmp_path / "t"), result_table.RESULT_KEYS["q2_1h"]
    day = 86_400_000
    result_table.upsert(spark.createDataFrame([_point(d * day, d * day + 1, 1, d) for d in range(4)], Q2_RESULT), path, 0, keys)
    files = lambda d: sorted(p.name for p in (tmp_path / "t" / "rows" / f"day={d}").glob("*.parquet"))
    before = [files(d) for d in range(4)]
    result_table.upsert(spark.createDataFrame([_point(2 * day, 2 * day + 1, 1, 99)], Q2_RESULT), path, 1, keys)
    assert [files(d) == before[d] for d in range(4)] == [True, True, False, True]
    rows = result_table.read_results(spark, path, Q2_RESULT, 1, 2)
    assert sorted(r.num_flights for r in rows.collect()) == [1, 99]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_an_upsert_that_died_is_finished(spark, tmp_path, monkeypatch):
    """The job dies when one of two partitions is in place; the batch comes again after the restart."""
    path, keys = str(tmp_path / "t"), result_table.RESULT_KEYS["q2_1h"]
    day = 86_400_000
    rows = lambda value: spark.createDataFrame([_point(d * day, d * day + 1, r, value + r) for d in (0, 1) for r in (1, 2)], Q2_RESULT)
    result_table.upsert(rows(10), path, 0, keys)
    moved, move = [], result_table.replace_folder

    def dies(*args):
        if moved:
            raise OSError("lost")
        moved.append(args)
        move(*args)

    monkeypatch.setattr(result_table, "replace_folder", dies)
    with pytest.raises(OSError):
        result_table.upsert(rows(20).where("rank = 1"), path, 1, keys)
    monkeypatch.setattr(result_table, "replace_folder", move)
    result_table.upsert(rows(20).where("rank = 1"), path, 1, keys)
    got = result_table.read_results(spark, path, Q2_RESULT).collect()
    assert sorted((r.window_start // day, r["rank"], r.num_flights) for r in got) == [(0, 1, 21), (0, 2, 12), (1, 1, 21), (1, 2, 12)]


def test_exports(spark, tmp_path):
    rows = export.export_q2(_q2(spark))
    assert rows.columns == list(export.Q2_COLUMNS)
    export.write_q2_csv(rows.coalesce(1), str(tmp_path / "q2"))
    lines = next((tmp_path / "q2").glob("*.csv")).read_text().splitlines()
    assert lines == [
        ",".join(export.Q2_COLUMNS),
        "2025-01-01 08:00:00,1,10001,2,2,38.25,45.0,[(AA,20001,45.00), (AA,20009,31.50)]",
        "2025-01-01 08:00:00,2,2,1,0,0.0,0.0,[]",
    ]
    partial = spark.createDataFrame([(0, "AA", 3)], "window_start long, airline string, num_flights long")
    out = export.export_q1(partial)
    assert out.columns == list(export.Q1_COLUMNS)
    row = out.first()
    assert (row.window_start, row.window_end, row.num_flights, row.diverted) == (
        "1970-01-01 00:00:00", "1970-01-01 01:00:00", 3, 0
    )
    export.write_csv(export.export_q3(delays.delay_distribution(clean(flights(spark, {})), "1d")), str(tmp_path / "q3"))
    text = spark.read.option("header", "true").csv(str(tmp_path / "q3"))
    assert text.columns == list(export.Q3_COLUMNS) and text.count() == 1


def test_rank_is_ordered_as_text(spark):
    rows = spark.createDataFrame([_point(0, 1, r, 1) for r in (2, 10, 1)], Q2_RESULT)
    assert [r["rank"] for r in export.export_q2(rows).collect()] == ["1", "10", "2"]


def test_pivot(spark):
    rows = [(1, "a", "x", 1.0), (1, "a", "y", 2.0), (2, "a", "x", 3.0)]
    points = spark.createDataFrame(rows, "t int, k string, field string, value double")
    rows = decode.pivot_fields(points, ["t", "k"], ["x", "y", "z"]).orderBy("t").collect()
    assert [tuple(r) for r in rows] == [(1, "a", 1.0, 2.0, None), (2, "a", 3.0, None, None)]


def test_run_stats(spark):
    # Steady input rates of two settings, and one setting with a single run.
    runs = [("M1", 2970.0), ("M1", 2940.0), (" M1 ", 2980.0), ("S3", 308.0), (None, 1.0)]
    stats = export.run_stats(spark.createDataFrame(runs, "code string, thr double"), ["thr"])
    got = {(r.scenario, r.parallelism): (r.thr_mean, r.thr_std) for r in stats.collect()}
    assert got[("S", "3")] == (308.0, 0.0)
    assert got[("M", "1")] == (pytest.approx(2963.3333333), pytest.approx(20.8166600))
    assert len(got) == 2


def test_plain_text(spark, tmp_path):
    encode.write_plain_text(spark.range(2), "id", str(tmp_path / "txt"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "txt")).collect()) == ["0", "1"]
    encode.show_rows(spark.range(1))


def test_message_sinks_follow_the_topics():
    settings = StreamSettings("broker:1", "in", {"q1": "a", "q3_7d": "b"}, "rest")
    assert set(encode.message_sinks(settings)) == {"q1", "q3_7d"}
