"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; ``n_chars`` follows the text where it changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, decontaminate, lines, minhash, toxicity
from skyledger.llm.common import read_table, written
from skyledger.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# No stage with a trained model or a tokenizer has an SQL form.
ORACLE_SQL: str | None = None


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The model is fitted on the labelled rows of the raw documents."""
    model = toxicity.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and with them the documents that had lines and keep none."""
    # The columns of a row as a struct, so that none is taken for a count.
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    cut = lines.dedup_lines(rows, lines.MAX_WORDS, lines.SHARE).where("n_lines = 0 OR n_dropped < n_lines")
    return _with_length(cut.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return minhash.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return _with_length(decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document left."""
    coded = bpe.encode_documents(docs.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("minhash", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written to the shared scratch folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
