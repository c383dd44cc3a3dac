"""Near-duplicate documents by MinHash, banding, verification and connected components.

Documents with the same words collapse to the one with the smallest id first, by an aggregation, so copies of a text
are combined before a shuffle. What is left is numbered: an id may stand on several texts, and each is a document of its
own. Components are named by their smallest id at the end. Of the numbered documents, those that share a
band of hash minima meet in a bucket. Links are looked for where they can still join two components: first from a
bucket's most central document to its other members, then among the documents of buckets that still hold different
components. A pair is compared by set sizes, by signatures, and then on the full shingle sets, so a link is exact. A
link between documents of one component would change nothing and is not looked for, which keeps groups of copies linear.

Documents that share a much-used passage and little else meet in buckets too. So the second step does not compare all of
a bucket: two sets at the threshold must share one of their rarest shingles, a seventh of the smaller and a quarter of
the larger set, and only documents that do are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import ascii_lower, on_workers, text_or_empty, written
from skyledger.llm.components import components

SHINGLE = 5
PERCENT = 75
# A pair at the threshold shares one of 32 bands of 3 with probability 1 - 2e-8.
BANDS, ROWS = 32, 3
# Signatures of linked documents agree on less than this with a probability under 1e-6.
LEAST_AGREEMENT = 0.5
# Shingles in this many of the documents left or more are compared last, the most frequent ones up to a bound.
FREQUENT, FREQUENT_SHINGLES = 8, 100_000
# Ids up to this number, 24 bytes each, are broadcast to fetch the texts of candidate documents.
BROADCAST_IDS = 1_000_000
# A text with more than this share of all rows gets its first copy by a broadcast of as many rows as such shares at most.
HOT_SHARE = 1e-4
# Hash values worked on together; they stay in the processor's cache.
PART = 1 << 15


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(trimmed)).otherwise(ascii_lower(trimmed))
    return F.when(F.octet_length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(lowered, "[ \\t-\\r]+"))


def shingle_set(words: Column, n: int = SHINGLE) -> Column:
    """Distinct hashes of all runs of ``n`` words; of all words together where there are fewer; else empty."""
    runs = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, n))))
    whole = F.array(F.xxhash64(F.lit("short"), F.array_join(words, " ")))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(
        F.size(words) < n, whole).otherwise(F.array_distinct(runs))


def _tie() -> Column:
    return F.xxhash64(text_or_empty())


def _with_sets(docs: DataFrame) -> DataFrame:
    return docs.withColumn("words", words_of(text_or_empty())).withColumn("shingles", shingle_set(F.col("words")))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, same, n_shingles, signature, bands) for every row.

    ``tie`` is a checksum of the text, ``same`` one of the word sequence, null where there is no word or no id: such rows
    link with nothing.
    """
    on_workers(docs.sparkSession)
    sets = _with_sets(docs.select("doc_id", "text")).select(
        "doc_id", _tie().alias("tie"),
        F.when((F.size("words") > 0) & F.col("doc_id").isNotNull(), F.md5(F.array_join("words", " "))).alias("same"),
        "shingles")
    rng = np.random.default_rng(20240229)
    n_hashes = BANDS * ROWS
    factor = rng.integers(1, 1 << 63, n_hashes, np.uint64) * np.uint64(2) + np.uint64(1)
    offset = rng.integers(0, 1 << 63, n_hashes, np.uint64)
    mix = rng.integers(1, 1 << 63, (BANDS, ROWS + 1), np.uint64) | np.uint64(1)

    def minima(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Least hash of each run of ``values``, for each hash function; no run is empty."""
        out = np.empty((len(begins), n_hashes), np.uint32)
        for k in range(n_hashes):
            hashed = (values * factor[k] + offset[k]) >> np.uint64(32)
            out[:, k] = np.minimum.reduceat(hashed, begins)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column(3)
            ends = sets.offsets.to_numpy().astype(np.int64)
            values = sets.values.to_numpy().view(np.uint64)
            sizes = np.diff(ends)
            full = np.flatnonzero(sizes)
            signature = np.zeros((len(sizes), n_hashes), np.uint32)
            # Runs of documents of about PART values; a longer document is a run of its own.
            at = 0
            while at < len(full):
                begin = ends[full[at]]
                stop = max(at + 1, int(np.searchsorted(ends[full + 1], begin + PART, side="right")))
                own = full[at:stop]
                signature[own] = minima(values[begin:ends[own[-1] + 1]], ends[own] - begin)
                at = stop
            rows = signature.reshape(len(sizes), BANDS, ROWS).astype(np.uint64)
            keys = np.broadcast_to(mix[:, ROWS], rows.shape[:2]).copy()
            for j in range(ROWS):
                keys = (keys ^ rows[:, :, j]) * mix[:, j]
                keys ^= keys >> np.uint64(29)
            lists = lambda flat, width, kind: pa.ListArray.from_arrays(
                pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * width), pa.array(flat.reshape(-1).view(kind)))
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array(sizes), lists(signature, n_hashes, np.int32), lists(keys, BANDS, np.int64)],
                names=["doc_id", "tie", "same", "n_shingles", "signature", "bands"])

    return sets.mapInArrow(
        run, "doc_id bigint, tie bigint, same string, n_shingles bigint, signature array<int>, bands array<bigint>")


def _crowded(heads: DataFrame) -> DataFrame:
    """(bucket, doc, n, rank) of the buckets that hold two documents or more.

    ``rank`` rises as a document's buckets get emptier. The text from which many copies were made shares more bands
    with them than they do with each other, so it comes first in its buckets.
    """
    members = heads.select(F.explode("bands").alias("bucket"), "doc", F.col("n_shingles").alias("n"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    crowded = written(members.join(shared, "bucket"), "crowded")
    central = crowded.groupBy("doc").agg((-F.sum("c")).alias("rank"))
    return crowded.drop("c").join(central, "doc")


def _similar_sizes() -> Column:
    return 100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m")


def _with_components(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc"))


def _leader_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each member with its bucket's most central document."""
    leaders = members.groupBy("bucket").agg(F.min(F.struct("rank", "doc", "n")).alias("l")).select(
        "bucket", F.col("l.doc").alias("leader"), F.col("l.n").alias("m"))
    return members.join(leaders, "bucket").where((F.col("doc") != F.col("leader")) & _similar_sizes()).select(
        F.least("doc", "leader").alias("a"), F.greatest("doc", "leader").alias("b")).distinct()


def _undecided(members: DataFrame) -> DataFrame:
    """(doc, component) of the documents in buckets that still hold two components or more."""
    open_buckets = members.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    return members.join(open_buckets, "bucket").groupBy("doc").agg(F.first("component").alias("component"))


def _rarest(sets: DataFrame) -> DataFrame:
    """(doc, component, n, rare): the rarest quarter of each set, its rarest first.

    Any order of the shingles that is the same for all documents loses no pair. Here frequent shingles come last, by
    their frequency, and the others first, by their value.
    """
    frequent = sets.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c")).where(
        F.col("c") >= FREQUENT).orderBy(F.desc("c"), "s").limit(FREQUENT_SHINGLES).select("s").collect()
    ranked = np.array([r.s for r in frequent][::-1], np.int64)
    by_value = np.argsort(ranked)
    values = ranked[by_value]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare, ends = [], [0]
            for own in batch.column(2):
                own = np.sort(own.values.to_numpy())
                at = np.searchsorted(values, own)
                common = np.zeros(len(own), bool)
                if len(values):
                    common = values[np.minimum(at, len(values) - 1)] == own
                order = np.concatenate([own[~common], ranked[np.sort(by_value[at[common]])]])
                rare.append(order[:len(own) - -(-PERCENT * len(own) // 100) + 1])
                ends.append(ends[-1] + len(rare[-1]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pc.list_value_length(batch.column(2)).cast(pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rare)))],
                names=["doc", "component", "n", "rare"])

    return sets.select("doc", "component", "shingles").mapInArrow(
        run, "doc bigint, component bigint, n bigint, rare array<bigint>")


def _rest_pairs(undecided: DataFrame, heads: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): undecided documents of different components that share a shingle rare enough."""
    sets = written(_sets_of(docs, heads, undecided), "undecided-sets")
    rows = written(_rarest(sets), "rare").select("doc", "component", "n", F.posexplode("rare").alias("place", "s"))
    # Of a pair the smaller set needs fewer: shared >= 2p / (100 + p) of its size, as the other is no smaller.
    small = rows.where(
        F.col("place") <= F.col("n") - F.ceil(F.lit(2 * PERCENT) * F.col("n") / (100 + PERCENT))).select(
        "s", F.col("doc").alias("other"), F.col("component").alias("with"), F.col("n").alias("m"),
        F.col("place").alias("at"))
    # From the first shingle that a pair shares, both sets must be long enough for all that they have to share.
    shared = F.ceil(F.lit(PERCENT) * (F.col("n") + F.col("m")) / (100 + PERCENT))
    return rows.join(small, "s").where(
        (F.col("n") - F.col("place") >= shared) & (F.col("m") - F.col("at") >= shared)
        & (F.struct("m", "other") < F.struct("n", "doc")) & (F.col("component") != F.col("with")) & _similar_sizes()).select(
        F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct()


def _sets_of(docs: DataFrame, heads: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingle sets of the documents in ``wanted`` (doc and more), one row for each."""
    placed = wanted.join(heads.select("doc", "doc_id", "tie"), "doc")
    few = F.broadcast(placed) if wanted.count() <= BROADCAST_IDS else placed
    found = docs.select("doc_id", "text", _tie().alias("tie")).join(few, ["doc_id", "tie"]).dropDuplicates(["doc"])
    return _with_sets(found).drop("text", "words", "doc_id", "tie")


def _verified(pairs: DataFrame, heads: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v): the pairs whose shingle sets are similar enough; signatures are compared first."""
    own = heads.select("doc", "signature")
    signed = pairs.join(own.toDF("a", "sa"), "a").join(own.toDF("b", "sb"), "b")
    agreed = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    likely = written(signed.where(agreed >= LEAST_AGREEMENT * BANDS * ROWS).select("a", "b"), "pairs")
    ids = written(likely.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "pair-ids")
    sets = _sets_of(docs, heads, ids)
    both = likely.join(sets.toDF("b", "y"), "b").join(sets.toDF("a", "x"), "a")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(100 * shared >= PERCENT * (F.size("x") + F.size("y") - shared)).select(
        F.col("a").alias("u"), F.col("b").alias("v"))


def _heads(signed: DataFrame) -> DataFrame:
    """(doc, doc_id, tie, same, copies, n_shingles, signature, bands): the first of each set of equal word sequences.

    ``doc`` numbers the rows as they are written, so it is fixed from then on.
    """
    firsts = signed.where("same is not null").groupBy("same").agg(
        F.min(F.struct("doc_id", "tie", "n_shingles", "signature", "bands")).alias("f"), F.count(F.lit(1)).alias("copies"))
    return written(firsts.select(F.monotonically_increasing_id().alias("doc"), "same", "copies", "f.*"), "heads")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signatures of all rows, heads with the first (doc_id, tie) of their component)."""
    signed = written(signatures(docs), "signatures")
    heads = _heads(signed)
    members = written(_crowded(heads), "members")
    stars = written(_verified(_leader_pairs(members), heads, docs), "edges")
    linked = written(components(stars), "components")
    undecided = written(_undecided(_with_components(members, linked)), "undecided")
    rest = written(_verified(_rest_pairs(undecided, heads, docs), heads, docs), "edges")
    found = components(stars.union(rest)).withColumnRenamed("node", "doc")
    linked_heads = written(heads.select("doc", "doc_id", "tie").join(found, "doc"), "components")
    named = linked_heads.groupBy("component").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    firsts = linked_heads.join(named, "component").select("doc", "first")
    return signed, heads.select("doc", "doc_id", "tie", "same", "copies").join(firsts, "doc", "left").withColumn(
        "first", F.coalesce("first", F.struct("doc_id", "tie")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id reachable over links of at least ``PERCENT`` per cent similarity. Null and empty
    texts have no shingles and are alone. Rows with a null id are alone and have a null component. Rows that share an
    id but not their words are documents of their own. An empty table gives no rows; other columns are not read.
    """
    signed, heads = _classes(docs)
    rows = signed.select("doc_id", "same", "n_shingles")
    named = written(heads.select("same", "copies", F.col("first.doc_id").alias("component_id")), "named")
    hot = F.col("copies") > HOT_SHARE * (rows.count() or 1)
    # Rows of a text with many copies do not meet in one task, and rows that link with nothing meet nowhere.
    marked = rows.where("same is not null").join(
        F.broadcast(named.where(hot & (F.col("copies") > 1)).select("same", F.col("component_id").alias("of_hot"))), "same", "left")
    cold = marked.where("of_hot is null").join(named.where(~hot | (F.col("copies") <= 1)), "same")
    alone = rows.where("same is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return cold.select("doc_id", "n_shingles", "component_id").unionByName(marked.where("of_hot is not null").select(
        "doc_id", "n_shingles", F.col("of_hot").alias("component_id"))).unionByName(alone)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The first row of each component, by id and a checksum of the text.

    Rows without an id or without a word link with nothing and stay, repeated ones too. Of rows with the same id and text
    one stays. Rows with one id and different words are different documents: none takes the place of another.
    """
    wordless = F.octet_length(F.btrim(text_or_empty(), F.lit(" \t\n\x0b\f\r"))) == 0
    alone = F.col("doc_id").isNull() | wordless
    firsts = _classes(docs)[1].select(
        F.col("first.doc_id").alias("first_id"), F.col("first.tie").alias("first_tie")).distinct()
    rows = docs.where(~alone).select(  # a row as a struct, so its columns can have any names
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("first_id"), _tie().alias("first_tie"))
    kept = rows.join(firsts, ["first_id", "first_tie"], "left_semi").dropDuplicates(["first_id", "first_tie"])
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns)).unionByName(docs.where(alone))
