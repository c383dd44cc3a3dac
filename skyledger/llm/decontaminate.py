"""Benchmark decontamination by a hash set of normalised benchmark windows.

A window is ten consecutive words of an item, or all words of a shorter item. The documents' windows are hashed in
one scan and looked up in the windows' table, which is broadcast while it has at most ``BROADCAST_WINDOWS`` rows and
shuffled beyond that. Hits are verified word by word before they count. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import ascii_lower, text_or_empty, written

WINDOW = 10
# About 100 bytes each, so at most some 100 MB.
BROADCAST_WINDOWS = 1_000_000
# Everything that is no digit, letter or non-ASCII character.
SEPARATORS = "[\\x00-/:-@\\[-`{-\\x7f]"


def _lowered(text: Column) -> Column:
    """A-Z only. The built-in ``lower`` does the same for ASCII texts, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(_lowered(text), SEPARATORS + "+"), "")


def _window_hashes(words: Column, length: int) -> Column:
    """Hash of the window that begins at each word."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (length - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, length))))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(hash, length, words, items): each distinct window once, with the items that hold it.

    Items without words or without an id have no window; repeated items count once.
    """
    items = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("string").alias("item"), text_or_empty().alias("text"))
    tokens = items.select("item", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    spans = tokens.select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: F.slice("words", i, size))).alias("words"))
    unique = spans.groupBy("words").agg(F.collect_set("item").alias("items"))
    per_length = F.lit(None).cast("long")
    for n in range(window, 0, -1):
        per_length = F.when(
            F.size("words") == n, F.xxhash64(*(F.get("words", F.lit(k)) for k in range(n)))).otherwise(per_length)
    return unique.select(per_length.alias("hash"), F.size("words").alias("length"), "words", "items")


def _row_key(text: Column) -> list[Column]:
    """Rows are told apart by id and text, so repeated ids and null ids do no harm."""
    return [F.col("doc_id"), F.xxhash64(text).alias("text_hash")]


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, found): unverified hits by document, as structs of position, words and items."""
    lengths = [r[0] for r in windows.select("length").distinct().orderBy("length").collect()]  # 1 to WINDOW
    keyed = docs.select(*_row_key(F.col("text")), words_of(F.col("text")).alias("words"))
    if windows.count() <= BROADCAST_WINDOWS:
        windows = F.broadcast(windows)

    def placed(n: int) -> Column:
        return F.transform(_window_hashes(F.col("words"), n), lambda h, i: F.struct(
            i.alias("position"), F.lit(n).alias("length"), h.alias("hash")))

    if len(lengths) > 1:
        rows = keyed.select("doc_id", "text_hash", F.inline(F.concat(*map(placed, lengths))))
    else:  # the usual case needs no struct for each word
        n = lengths[0] if lengths else WINDOW
        rows = keyed.select("doc_id", "text_hash", F.posexplode(_window_hashes(F.col("words"), n))).select(
            "doc_id", "text_hash", F.col("pos").alias("position"), F.lit(n).alias("length"), F.col("col").alias("hash"))
    return rows.join(windows, ["hash", "length"]).groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("position", "words", "items")).alias("found"))


def _marked(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """(row, text, n_words, hit_words, items): each row as a struct, so its columns can have any names."""
    windows = written(benchmark_windows(benchmark, window), "windows")
    found = hits(docs.select("doc_id", text_or_empty().alias("text")), windows).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "found")
    whole = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(text_or_empty()).alias("text_hash"),
        F.size(words_of(text_or_empty())).cast("long").alias("n_words"))
    joined = whole.join(found, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
    text = F.coalesce("row.text", F.lit(""))
    # Only documents with hits are split into words again. The words are used twice below, so that the optimizer
    # computes them once for a row, and not once for each hit.
    split = joined.withColumn("words", F.when(F.col("found").isNotNull(), words_of(text)))
    checked = split.withColumn("verified", F.when(F.size("words") > 0, F.filter(
        "found", lambda x: F.slice("words", x["position"] + 1, F.size(x["words"])) == x["words"])))
    positions = F.array_sort(F.array_distinct(F.flatten(F.transform("verified", lambda x: F.sequence(
        x["position"], x["position"] + F.size(x["words"]) - 1)))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("verified", lambda x: x["items"]))))
    return checked.select(
        "row", F.col("row.text").alias("text"), "n_words",
        F.coalesce(positions, F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce(items, F.array().cast("array<string>")).alias("items"))


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_words`` (positions, ascending) and ``items`` (ids as strings, sorted).

    A document word inside any verified occurrence of a window is hit. Null and empty texts have no words. An empty
    benchmark hits nothing. Other columns pass through, those with the three names are replaced; repeated rows are
    marked alike.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "hit_words", "items")]
    return _marked(docs, benchmark, window).select(
        *(F.col("row")[c].alias(c) for c in kept), "n_words", "hit_words", "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, drop_share: float = 0.5) -> DataFrame:
    """Removes the hit words, and the separators behind them, from each text; other columns stay.

    A document of whose words at least ``drop_share`` are hit is removed as a whole.
    """
    marked = _marked(docs, benchmark, window)
    hit = F.size("hit_words")
    left = marked.where(~((hit > 0) & (hit >= drop_share * F.col("n_words")))).withColumn("pieces", F.when(
        hit > 0, F.regexp_extract_all(F.col("text"), F.lit(f"[^\\x00-/:-@\\[-`{{-\\x7f]+{SEPARATORS}*"), F.lit(0))))
    lead = F.regexp_extract(F.col("text"), f"^{SEPARATORS}*", 0)
    stay = F.transform(
        F.array_except(F.sequence(F.lit(0), F.col("n_words").cast("int") - 1), "hit_words"), lambda i: F.get("pieces", i))
    # The pieces are named twice, so that they are computed once for a row.
    cut = F.when(F.size("pieces") > 0, F.concat(lead, F.array_join(stay, ""))).otherwise(F.col("text"))
    return left.withColumn("cut", cut).select(
        *(F.col("cut").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
