"""Scan of on-time reporting CSV files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.scalars import number_prefix, replay_time, to_double, to_int
from skyledger.schema import FLIGHT_COLUMNS, SOURCE_FIELDS, ZERO_WHEN_BLANK

FILE_GLOB = "*_T_ONTIME_REPORTING.csv"
_CORRUPT = "_corrupt_row"


def read_ontime_csv(
    spark: SparkSession, paths: str | Sequence[str], file_glob: str = FILE_GLOB
) -> DataFrame:
    """All 27 source columns, typed, malformed rows left out.

    Names starting with a dot or an underscore are never read. Columns are found by name; a file may leave
    some out, and each file may have a header of its own.
    """
    if isinstance(paths, str):
        paths = [paths]
    parts = [part for p in paths for part in _by_header(spark, p, file_glob)]
    return reduce(DataFrame.unionByName, [_read_one(spark, header, files, file_glob) for header, files in parts])


def _reader(spark: SparkSession, file_glob: str) -> DataFrameReader:
    return spark.read.option("pathGlobFilter", file_glob).option("recursiveFileLookup", "true")


def _by_header(spark: SparkSession, path: str, file_glob: str) -> list[tuple[str, list[str]]]:
    """(header line, files) under a path; where all files agree, the path stands for them.

    The header is the first line of the split that begins at a file's first byte, read as plain lines.
    """
    lines = _reader(spark, file_glob).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    headers = lines.where("at = 0").groupBy("file").agg(F.first("value").alias("header")).groupBy("header").agg(
        F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    if len(headers) == 1:
        return [(headers[0].header, [path])]
    return [(r.header, list(r.files)) for r in headers]


def _read_one(spark: SparkSession, header: str, files: list[str], file_glob: str) -> DataFrame:
    # The reader itself takes the names apart, so quoted names are read as in the files.
    names = spark.read.option("header", "true").csv(spark.sparkContext.parallelize([header], 1)).columns
    text = T.StructType([T.StructField(h, T.StringType()) for h in names])
    rows = (
        _reader(spark, file_glob).option("header", "true")
        # Rows with too few or too many fields are malformed even when only some columns are read.
        .option("columnPruning", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .schema(T.StructType([*text.fields, T.StructField(_CORRUPT, T.StringType())]))
        .csv(files)
        .where(F.col(_CORRUPT).isNull())
        .drop(_CORRUPT)
    )
    return type_source_rows(rows)


def type_source_rows(rows: DataFrame) -> DataFrame:
    """Typed source columns from text columns.

    A number is the longest beginning of its text that is one; a row with a text that has none is dropped.
    """
    by_name = {name.strip().upper(): name for name in rows.columns}
    typed: list[Column] = []
    readable = F.lit(True)
    for name, kind in SOURCE_FIELDS.items():
        source = by_name.get(name)
        raw = F.trim(F.col(f"`{source}`")) if source else F.lit("")
        text = F.coalesce(raw, F.lit(""))
        blank = text == ""
        if kind == "string":
            # The carrier stays an empty text, other texts become null.
            value = text if name == "OP_UNIQUE_CARRIER" else F.when(~blank, text)
        else:
            number = number_prefix(text)
            parsed = to_int(number) if kind == "int" else to_double(number)
            value = F.when(blank, F.lit(0)).otherwise(parsed) if name in ZERO_WHEN_BLANK else parsed
            if source:
                readable = readable & (blank | parsed.isNotNull())
        typed.append(value.alias(name))
    return rows.where(readable).select(*typed)


def to_flights(source: DataFrame, ingest_ms: Column | None = None) -> DataFrame:
    """The ten analysed columns under their working names, plus the ingestion time."""
    stamp = F.unix_millis(F.current_timestamp()) if ingest_ms is None else ingest_ms
    return source.select(*[F.col(s).alias(t) for s, t in FLIGHT_COLUMNS.items()], stamp.alias("ingest_ms"))


def first_by_event_time(flights: DataFrame, limit: int, *tie_break: str) -> DataFrame:
    """Rows in replay order, undated rows first; the first ``limit`` of them, 0 meaning all.

    A positive limit becomes a per-partition top-n followed by one merge of those; 0 is a range sort.
    """
    at = replay_time(F.col("year"), F.col("month"), F.col("day_of_month"), F.col("crs_dep_time"))
    ordered = flights.withColumn("replay_ms", F.unix_millis(at)).orderBy(
        F.col("replay_ms").asc_nulls_first(), *tie_break
    )
    return ordered.limit(limit) if limit > 0 else ordered
