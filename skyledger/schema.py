"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Source row: column name -> kind. "int" columns may arrive as "1830.0".
SOURCE_FIELDS: dict[str, str] = {
    "YEAR": "int",
    "MONTH": "int",
    "DAY_OF_MONTH": "int",
    "OP_UNIQUE_CARRIER": "string",
    "OP_CARRIER_FL_NUM": "string",
    "ORIGIN_AIRPORT_ID": "int",
    "ORIGIN_CITY_MARKET_ID": "int",
    "ORIGIN_STATE_ABR": "string",
    "DEST_AIRPORT_ID": "int",
    "DEST_CITY_MARKET_ID": "int",
    "DEST_STATE_ABR": "string",
    "CRS_DEP_TIME": "int",
    "DEP_TIME": "int",
    "DEP_DELAY": "double",
    "CRS_ARR_TIME": "int",
    "ARR_TIME": "int",
    "ARR_DELAY": "double",
    "CANCELLED": "double",
    "CANCELLATION_CODE": "string",
    "DIVERTED": "double",
    "ACTUAL_ELAPSED_TIME": "double",
    "DISTANCE": "double",
    "CARRIER_DELAY": "double",
    "WEATHER_DELAY": "double",
    "NAS_DELAY": "double",
    "SECURITY_DELAY": "double",
    "LATE_AIRCRAFT_DELAY": "double",
}

# Blank in these reads as 0 instead of null.
ZERO_WHEN_BLANK = ("YEAR", "MONTH", "DAY_OF_MONTH", "CRS_DEP_TIME")

# The ten analysed columns: source name -> name used by every operator.
FLIGHT_COLUMNS: dict[str, str] = {
    "YEAR": "year",
    "MONTH": "month",
    "DAY_OF_MONTH": "day_of_month",
    "OP_UNIQUE_CARRIER": "airline",
    "CRS_DEP_TIME": "crs_dep_time",
    "DEP_DELAY": "dep_delay",
    "CANCELLED": "cancelled",
    "DIVERTED": "diverted",
    "ORIGIN_AIRPORT_ID": "origin_airport_id",
    "DEST_AIRPORT_ID": "dest_airport_id",
}

_SPARK_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}

FLIGHT_SOURCE_SCHEMA = T.StructType([T.StructField(n, _SPARK_TYPES[k]) for n, k in SOURCE_FIELDS.items()])

FLIGHT_SCHEMA = T.StructType(
    [T.StructField(FLIGHT_COLUMNS[n], _SPARK_TYPES[SOURCE_FIELDS[n]]) for n in FLIGHT_COLUMNS]
    + [T.StructField("ingest_ms", T.LongType())]
)

DELAYED_FLIGHTS = T.ArrayType(T.StructType([
    T.StructField("carrier", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("dep_delay", T.DoubleType()),
]))

Q1_RESULT = T.StructType([
    T.StructField("window_start", T.LongType()),
    T.StructField("window_end", T.LongType()),
    T.StructField("airline", T.StringType()),
    T.StructField("num_flights", T.LongType()),
    T.StructField("completed", T.LongType()),
    T.StructField("cancelled", T.LongType()),
    T.StructField("diverted", T.LongType()),
    T.StructField("dep_delay_mean", T.DoubleType()),
    T.StructField("cancellation_rate", T.DoubleType()),
    T.StructField("late_departure_rate", T.DoubleType()),
])

Q2_RESULT = T.StructType([
    T.StructField("window_start", T.LongType()),
    T.StructField("window_end", T.LongType()),
    T.StructField("window_type", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("origin_airport_id", T.IntegerType()),
    T.StructField("num_flights", T.LongType()),
    T.StructField("severe_delays", T.LongType()),
    T.StructField("dep_delay_mean", T.DoubleType()),
    T.StructField("dep_delay_max", T.DoubleType()),
    T.StructField("delayed_flights", DELAYED_FLIGHTS),
])

Q3_RESULT = T.StructType([
    T.StructField("window_start", T.LongType()),
    T.StructField("window_end", T.LongType()),
    T.StructField("window_type", T.StringType()),
    T.StructField("airline", T.StringType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("count", T.LongType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("p25", T.DoubleType()),
    T.StructField("p50", T.DoubleType()),
    T.StructField("p75", T.DoubleType()),
    T.StructField("p90", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
])
