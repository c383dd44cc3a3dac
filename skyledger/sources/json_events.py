"""Decode of flight events that arrive as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.scalars import to_double, to_int
from skyledger.schema import FLIGHT_COLUMNS, SOURCE_FIELDS

_BROKEN = "_broken"
_TEXT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in FLIGHT_COLUMNS] + [T.StructField(_BROKEN, T.StringType())]
)


def decode_flights(
    messages: DataFrame, value: str = "value", ingest_ms: Column | None = None, *keep: str
) -> DataFrame:
    """Flights from a JSON column; works on batch and streaming input.

    Only the analysed keys are parsed, others are ignored. Null payloads, text that is not one JSON
    object, and objects with an unreadable number are dropped here and never reach the reject counts.
    A number may be quoted and an integer may be written as a decimal.
    """
    payload = F.col(value).cast("string")
    parsed = F.from_json(payload, _TEXT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    rows = (
        messages.where(F.ltrim(payload).startswith("{"))
        .select(parsed.alias("m"), *keep)
        .where(F.col(f"m.{_BROKEN}").isNull())
    )
    readable = F.lit(True)
    columns: list[Column] = []
    for source, target in FLIGHT_COLUMNS.items():
        text = F.col(f"m.{source}")
        if SOURCE_FIELDS[source] == "string":
            columns.append(text.alias(target))
            continue
        stripped = F.trim(text)
        number = to_int(stripped) if SOURCE_FIELDS[source] == "int" else to_double(stripped)
        readable = readable & (text.isNull() | (stripped == "") | number.isNotNull())
        columns.append(number.alias(target))
    stamp = F.unix_millis(F.current_timestamp()) if ingest_ms is None else ingest_ms
    return rows.where(readable).select(*columns, stamp.alias("ingest_ms"), *keep)


def encode_source(source: DataFrame, *keep: str) -> DataFrame:
    """One JSON object per source row, null keys left out: what the event topic carries."""
    names = [c for c in source.columns if c not in keep]
    return source.select(F.to_json(F.struct(*names)).alias("value"), *keep)
