"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import scratch_dir

# Raw text handled by one Python group or one written block; bounds the memory of a task.
BLOCK_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Cuts the lineage: writes to the shared scratch folder and reads back."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def give_back_memory(*tables: dict) -> None:
    """Empties a task's tables; a Python worker lives on, and the next task may be another stage's."""
    for table in tables:
        table.clear()
    pa.default_memory_pool().release_unused()


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks of about ``block_bytes`` of text the documents fill, 1 at least."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-int(total) // block_bytes))


def text_parts(texts: pa.Array, part_bytes: int, other: pa.Array | None = None) -> Iterator[tuple]:
    """(place, texts) of runs of about ``part_bytes``, or of one longer text. The place is a slice, or one of ``other``."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + part_bytes, side="right")) - 1)
        own = slice(at, stop)
        yield own if other is None else other[own], texts[own]
        at = stop
