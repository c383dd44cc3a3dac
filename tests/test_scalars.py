"""One hand-made row per rule."""

import pytest
from pyspark.sql import functions as F

from skyledger.functions import scalars
from skyledger.operators.clean import clean, rejects, target_airlines, with_event_time
from tests.helpers import flights, ms


@pytest.mark.parametrize("day, hhmm, expected, hour", [
    ((2025, 1, 1), 2400, "2025-01-01T23:59:00", 0),
    ((2025, 1, 1), 0, "2025-01-01T00:00:00", 0),
    ((2025, 1, 1), 1830, "2025-01-01T18:30:00", 18),
    ((2025, 1, 1), 2430, None, 0),
    ((2025, 1, 1), 1275, None, -1),
    ((2025, 2, 30), 800, None, 8),
    ((2024, 2, 29), 800, "2024-02-29T08:00:00", 8),
    ((2025, 1, 1), -5, None, -1),
    ((2025, 1, 1), -100, None, -1),
    ((2025, 1, 1), None, None, -1),
    ((None, 1, 1), 800, None, 8),
])
def test_event_time_and_hour(spark, day, hhmm, expected, hour):
    year, month, dom = day
    row = with_event_time(flights(spark, dict(year=year, month=month, day_of_month=dom, crs_dep_time=hhmm))).select(
        F.unix_millis("event_ts").alias("ms"), "dep_hour"
    ).first()
    assert row.ms == (ms(expected) if expected else None)
    assert row.dep_hour == hour


def test_replay_time_overflows_into_the_next_day(spark):
    rows = flights(spark, dict(crs_dep_time=2400), dict(crs_dep_time=1275), dict(year=0))
    at = scalars.replay_time(F.col("year"), F.col("month"), F.col("day_of_month"), F.col("crs_dep_time"))
    assert [r[0] for r in rows.select(F.unix_millis(at)).collect()] == [
        ms("2025-01-02T00:00:00"), ms("2025-01-01T13:15:00"), None
    ]


def test_event_time_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        row = clean(flights(spark, dict(crs_dep_time=230))).select("event_ms").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.event_ms == ms("2025-01-01T02:30:00")


@pytest.mark.parametrize("change, rule", [
    (dict(airline=" "), "completeness"),
    (dict(airline=None), "completeness"),
    (dict(origin_airport_id=None), "completeness"),
    (dict(dest_airport_id=None), "completeness"),
    (dict(month=None), "completeness"),
    (dict(crs_dep_time=None), "completeness"),
    (dict(crs_dep_time=2430), "event_time"),
    (dict(crs_dep_time=1275), "event_time"),
    (dict(month=2, day_of_month=30), "event_time"),
    (dict(cancelled=1.0, diverted=1.0), "contradiction"),
    # The first broken rule names the row.
    (dict(airline="", crs_dep_time=1275, cancelled=1.0, diverted=1.0), "completeness"),
    (dict(crs_dep_time=-5, cancelled=1.0, diverted=1.0), "event_time"),
])
def test_rejects(spark, change, rule):
    rows = flights(spark, change)
    assert [r.reject_rule for r in rejects(rows).collect()] == [rule]
    assert clean(rows).count() == 0


def test_clean_and_rejects_split_the_input(spark):
    rows = flights(spark, {}, dict(airline=" "), dict(crs_dep_time=2460), dict(cancelled=None, diverted=1.0))
    assert clean(rows).count() == 2
    assert rejects(rows).count() == 2


def test_clean_values(spark):
    rows = clean(flights(spark, dict(dep_delay=None, cancelled=0.5, diverted=None, airline=" AA")))
    row = rows.first()
    assert (row.dep_delay, row.is_cancelled, row.is_diverted, row.airline) == (0.0, False, False, " AA")
    # The stored carrier keeps its blank, so it is not a target carrier.
    assert target_airlines(rows, ("AA",)).count() == 0
    with pytest.raises(ValueError):
        target_airlines(rows, None)


def test_rounding_and_division(spark):
    row = spark.range(1).select(
        scalars.round_half_up(F.lit(-0.125)), scalars.round_half_up(F.lit(0.125)),
        scalars.round_half_up(F.lit(-2.5), 0), scalars.round_half_up(F.lit(2.5), 0),
        scalars.safe_divide(F.lit(5), F.lit(0)), scalars.safe_divide(F.lit(5), F.lit(-1)),
        scalars.safe_percent(F.lit(1), F.lit(3)), scalars.safe_divide_rounded(F.lit(2), F.lit(3), 1),
    ).first()
    assert tuple(row) == (-0.12, 0.13, -2.0, 3.0, 0.0, 0.0, 33.33, 0.7)


def test_thresholds_are_strict_and_ignore_nan(spark):
    delays = spark.createDataFrame([(15.0,), (15.1,), (30.0,), (30.1,), (float("nan"),)], "d double")
    rows = delays.select(scalars.above(F.col("d"), 15), scalars.above(F.col("d"), 30)).collect()
    assert [tuple(r) for r in rows] == [(False, False), (True, False), (True, False), (True, True), (False, False)]


def test_time_text(spark):
    row = spark.range(1).select(
        scalars.format_ms(F.lit(ms("2025-03-04T05:06:07"))),
        scalars.parse_ms(F.lit("2025-03-04 05:06:07")),
        scalars.parse_ms(F.lit(None).cast("string")),
        scalars.delayed_flight_text(F.lit("AA"), F.lit("13303"), F.lit(1766.0)),
    ).first()
    assert tuple(row) == ("2025-03-04 05:06:07", ms("2025-03-04T05:06:07"), 0, "(AA,13303,1766.0)")
