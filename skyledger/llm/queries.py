"""The corpus operators as named queries over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    bpe,
    decontaminate,
    infill,
    lattice,
    lines,
    minhash,
    phrases,
    pii,
    rules,
    sharding,
    toxicity,
    vectors,
    wavelet,
)
from skyledger.llm.common import documents, read_table, written
from skyledger.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

SHARDS = 16
END_ID = 2


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizers lie, on every machine alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_documents(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op2_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sizes = sharding.with_slot(docs.select("doc_id", sharding.record_size(F.col("text")).alias("size")))
    slot_map = written(sharding.first_map(sharding.slot_stats(sizes), SHARDS), "slot-map")
    return sharding.shard_documents(docs, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(documents(spark, sf_dir), lines.MAX_WORDS, lines.SHARE)
    return cut.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir)).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op6_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rules.apply_policy(rules.ledger(documents(spark, sf_dir)), rules.POLICIES[-1])
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(rules.BASE_MASK)) != 0).alias("base_failed"), "kept", "failed")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hit_words").cast("long")
    return marked.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op9_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = wavelet.write_shards(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), END_ID)
    return wavelet.read_documents(spark, folder).select(
        "doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op10_shape_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find(docs, pii.train(pii.labelled_table(docs)))
    kind = F.create_map(*(x for i, k in enumerate(pii.KINDS) for x in (F.lit(k), F.lit(i))))

    def joined(spans: Column) -> Column:
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
            kind[s["kind"]].alias("order"), s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(
            ordered, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    def count(name: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"))


def op11_fenwick_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.transform(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_int8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_subword_lattice": op1_subword_lattice,
    "op2_backtracking_bpe": op2_backtracking_bpe,
    "op3_virtual_slots": op3_virtual_slots,
    "op4_line_dedup": op4_line_dedup,
    "op5_minhash": op5_minhash,
    "op6_ordinal_toxicity": op6_ordinal_toxicity,
    "op7_rule_ledger": op7_rule_ledger,
    "op8_decontaminate": op8_decontaminate,
    "op9_wavelet_matrix": op9_wavelet_matrix,
    "op10_shape_crf": op10_shape_crf,
    "op11_fenwick_infill": op11_fenwick_infill,
    "op12_phrase_automata": op12_phrase_automata,
    "op13_int8_vectors": op13_int8_vectors,
}
