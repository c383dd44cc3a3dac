"""Scalar rules: event time, rounding, safe division, text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def valid_time_of_day(hhmm: Column) -> Column:
    """0000 to 2359 with minutes up to 59, or 2400. Plain comparisons, so a filter on it stays small."""
    return (hhmm == 2400) | (hhmm.between(0, 2359) & (hhmm % 100 < 60))


def _day_number(year: Column, month: Column, day: Column) -> Column:
    """Days since the epoch, null for an impossible date.

    ``try_``: ANSI mode must not fail the job. Without a time zone: nothing depends on the session, and no
    zone is looked up per row.
    """
    zero = F.lit(0)
    return F.unix_date(F.try_make_timestamp_ntz(year, month, day, zero, zero, zero).cast("date"))


def valid_date(year: Column, month: Column, day: Column) -> Column:
    return _day_number(year, month, day).isNotNull()


def event_time(year: Column, month: Column, day: Column, hhmm: Column) -> Column:
    """UTC timestamp of a scheduled departure, null when it cannot be one.

    2400 means the last minute of the same day. 24xx otherwise, minutes above 59, negative values and
    impossible dates give null.
    """
    return F.when(valid_time_of_day(hhmm), event_time_unchecked(year, month, day, hhmm))


def event_time_unchecked(year: Column, month: Column, day: Column, hhmm: Column) -> Column:
    """The same for rows already known to hold a valid time of day."""
    # hhmm = 100 h + m, so the minute of the day is hhmm - 40 h.
    minute = F.when(hhmm == 2400, F.lit(23 * 60 + 59)).otherwise(hhmm - F.floor(hhmm / 100) * 40)
    return _at(_day_number(year, month, day), minute)


def _at(day_number: Column, minute_of_day: Column) -> Column:
    return F.timestamp_millis((day_number.cast("long") * 1440 + minute_of_day.cast("long")) * 60_000)


def scheduled_hour(hhmm: Column) -> Column:
    """Hour slot 0..23, or -1 when there is none. 2400 falls into slot 0, unlike its event time."""
    hour = F.floor(hhmm / 100) % 24
    valid = (hour >= 0) & (hhmm % 100).between(0, 59)
    return F.when(valid, hour).otherwise(F.lit(-1)).cast("int")


def replay_time(year: Column, month: Column, day: Column, hhmm: Column) -> Column:
    """Time the replayer sorts by. Months, days, hours and minutes that are too large run over into the next ones:
    30 February is 2 March, and 2400 is next midnight.

    Null without a full date.
    """
    zero, one = F.lit(0), F.lit(1)
    january = F.try_make_timestamp_ntz(year, one, one, zero, zero, zero).cast("date")
    date = F.date_add(F.add_months(january, (month - 1).cast("int")), (day - 1).cast("int"))
    whole = (year != 0) & (month != 0) & (day != 0)
    return F.when(whole, _at(F.unix_date(date), (hhmm - hhmm % 100) / 100 * 60 + hhmm % 100))


def flag_set(flag: Column) -> Column:
    """A numeric flag counts only when it is exactly 1.0; null is not set."""
    return F.coalesce(flag == 1.0, F.lit(False))


def above(value: Column, threshold: float) -> Column:
    """Strictly above, and false for NaN (Spark orders NaN above every number)."""
    return (value > F.lit(float(threshold))) & ~F.isnan(value)


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def round_half_up(value: Column, decimals: int = 2) -> Column:
    """Halves go toward plus infinity: -0.125 gives -0.12. ``F.round`` goes away from zero instead."""
    if decimals <= 0:
        return F.floor(value + 0.5).cast("double")
    scale = float(10 ** decimals)
    return F.floor(value * scale + 0.5).cast("double") / scale


def safe_divide(num: Column, den: Column) -> Column:
    """0.0 unless the denominator is positive."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def safe_divide_rounded(num: Column, den: Column, decimals: int = 2) -> Column:
    return round_half_up(safe_divide(num, den), decimals)


def safe_percent(num: Column, den: Column) -> Column:
    return round_half_up(safe_divide(num, den) * 100.0)


def format_ms(ms: Column) -> Column:
    """Epoch milliseconds as UTC text, whatever the session's time zone."""
    seconds = F.floor(ms / 1000)
    of_day = F.pmod(seconds, F.lit(86_400))
    date = F.date_from_unix_date(F.floor(seconds / 86_400).cast("int")).cast("string")
    return F.when(ms.isNotNull(), F.format_string(
        "%s %02d:%02d:%02d", date, F.floor(of_day / 3600), F.floor(of_day / 60) % 60, of_day % 60))


def parse_ms(text: Column) -> Column:
    """Epoch milliseconds of UTC text, 0 for null; no zone of the session plays a part."""
    at = F.to_timestamp_ntz(text, F.lit(TIMESTAMP_PATTERN))
    seconds = F.unix_date(at.cast("date")).cast("long") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return F.coalesce((seconds * 1000).cast("long"), F.lit(0).cast("long"))


def window_start_ms(ms: Column, size_ms: int) -> Column:
    return ms - F.pmod(ms, F.lit(size_ms))


def delayed_flight_text(carrier: Column, dest: Column, dep_delay: Column, decimals: int = 1) -> Column:
    return F.format_string(f"(%s,%s,%.{decimals}f)", carrier, dest, dep_delay)


_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def number_text(text: Column) -> Column:
    """True for plain decimal text; rejects forms a lenient cast would take, such as '1d' or 'NaN'."""
    return text.rlike(_NUMBER)


def to_double(text: Column) -> Column:
    return F.when(number_text(text), text.try_cast("double"))


def to_int(text: Column) -> Column:
    """Integers may be written as decimals: '1830.0' is 1830. The fraction is cut off."""
    return to_double(text).try_cast("int")


_NUMBER_PREFIX = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"


def number_prefix(text: Column) -> Column:
    """The longest beginning that is a number, null without one: '20x4' gives '20'."""
    found = F.regexp_extract(text, _NUMBER_PREFIX, 0)
    return F.when(found != "", found)
