"""Hand-made flights."""

from datetime import datetime, timezone

from skyledger.schema import FLIGHT_SCHEMA

_DEFAULTS = dict(
    year=2025, month=1, day_of_month=1, airline="AA", crs_dep_time=800, dep_delay=0.0, cancelled=0.0,
    diverted=0.0, origin_airport_id=10001, dest_airport_id=20001, ingest_ms=1,
)


def flights(spark, *rows):
    """A flights table; each row names only what differs from an ordinary flight."""
    full = [{**_DEFAULTS, **r} for r in rows]
    return spark.createDataFrame([tuple(f[n] for n in FLIGHT_SCHEMA.names) for f in full], FLIGHT_SCHEMA)


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)
