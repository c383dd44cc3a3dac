"""Toxicity as expected severity from a cumulative-link ordinal regression.

Features are words and their first letters, as their rate per hundred words on a log scale. One weight per feature is shared by all thresholds:
P(grade <= k) = sigmoid(t_k - w x) with rising t_k. The labels say toxic or not; toxic training documents get grades 1
to 3 by the share of their words that mark toxic documents, in equal thirds, and all others grade 0. The expected
severity is the mean grade; a document is rejected where that is ``REJECT_AT`` or more.

The model is fitted on a bounded sample of labelled rows and holds a bounded number of features; scoring covers every
document and shuffles nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import give_back_memory, on_workers, text_or_empty

# Labelled rows the model is fitted on, of each kind at most; picked by a checksum of the id.
SAMPLE_TOXIC = 2000
SAMPLE_CLEAN = 4000
MAX_FEATURES = 4096
GRADES = 4
REJECT_AT = 0.5
PREFIXES = (4, 5, 6)
# A feature is taken if the log odds of it in toxic documents are this many standard errors and this factor higher.
LEAST_Z, LEAST_RATIO = 3.0, 4.0
SHORT_TEXT = 10
RIDGE, STEPS, RATE = 0.02, 400, 0.1
# Entries of a task's table of words before it is emptied; bounds memory, not results.
CACHE_WORDS = 300_000

_EDGES = ".,;:!?|\"'()[]{}<>*_-"


def features_of(word: str) -> tuple[str, ...]:
    """The word itself and its beginnings; a beginning is marked, so it is no word."""
    bare = word.strip(_EDGES)
    if not bare:
        return ()
    return (bare, *(bare[:n] + "*" for n in PREFIXES if len(bare) >= n))


@dataclass(frozen=True)
class Model:
    """Feature names, a weight for each, and the thresholds between grades."""

    features: tuple[str, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and k."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of at most ``SAMPLE_TOXIC + SAMPLE_CLEAN`` labelled documents."""
    known = labels.where("doc_id is not null and toxic is not null").select(
        "doc_id", (F.col("toxic") > 0).alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    picked = known.where("toxic").orderBy(order).limit(SAMPLE_TOXIC).union(
        known.where("not toxic").orderBy(order).limit(SAMPLE_CLEAN))
    return docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])


def _document_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): documents of either kind that hold the feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                words = set(text.as_py().lower().split())
                counts[toxic.as_py()].update({f for w in words for f in features_of(w)})
        names = list(counts[0] | counts[1])
        for begin in range(0, len(names), 50_000):
            part = names[begin:begin + 50_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(part, pa.string()), pa.array([counts[1][f] for f in part], pa.int64()),
                pa.array([counts[0][f] for f in part], pa.int64())], names=["feature", "toxic", "clean"])

    return sample.select("text", "toxic").mapInArrow(run, "feature string, toxic bigint, clean bigint").groupBy(
        "feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class _Counter:
    """Counts a model's features in texts; a table of words seen spares most of the work."""

    def __init__(self, names: tuple[str, ...]):
        self.place = {f: i for i, f in enumerate(names)}
        self.known: dict[str, tuple[int, ...] | None] = {}

    def count(self, texts: Iterable[str | None]) -> tuple[list[int], list[int], list[int], list[int], list[int]]:
        """Per text its words and those with a feature; then features, their counts, and where each text's end."""
        known, place = self.known, self.place
        n_words, marked, at, counts, ends = [], [], [], [], [0]
        for text in texts:
            words = (text or "").lower().split()
            new = set(words).difference(known)
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = set(words)
            for w in new:
                known[w] = tuple(place[f] for f in features_of(w) if f in place) or None
            hits = [h for h in map(known.__getitem__, words) if h]
            own = Counter(i for h in hits for i in h)
            n_words.append(len(words))
            marked.append(len(hits))
            at.extend(own.keys())
            counts.extend(own.values())
            ends.append(len(at))
        return n_words, marked, at, counts, ends


def _counted(sample: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """(doc_id, toxic, n_words, marked, at, counts) of the sampled documents, without their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(names)
        for batch in batches:
            n_words, marked, at, counts, ends = counter.count(x.as_py() for x in batch.column(2))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(marked, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))],
                names=["doc_id", "toxic", "n_words", "marked", "at", "counts"])

    return sample.select("doc_id", "toxic", "text").mapInArrow(
        run, "doc_id bigint, toxic boolean, n_words bigint, marked bigint, at array<int>, counts array<int>")


def _grades(toxic: np.ndarray, share: np.ndarray) -> np.ndarray:
    """0 for clean rows; toxic rows in equal parts by their share of marked words."""
    grade = np.zeros(len(toxic), np.int64)
    rows = np.flatnonzero(toxic)
    ranks = np.argsort(np.argsort(share[rows], kind="stable"), kind="stable")
    grade[rows] = 1 + ranks * (GRADES - 1) // max(1, len(rows))
    return grade


def _rates(count: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Feature values; short texts count as a little longer than they are, so one word decides less."""
    return np.log1p(100 * count / (n_words + SHORT_TEXT))


def fit_ordinal(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int) -> tuple:
    """(weights, thresholds) of a cumulative-link model on sparse rows, by gradient steps with a ridge penalty."""
    n = len(grade)
    weights = np.zeros(n_features)
    share = np.clip(np.cumsum(np.bincount(grade, minlength=GRADES))[:-1] / n, 1e-6, 1 - 1e-6)
    first = np.log(share / (1 - share))
    # A threshold is the one below it and a positive gap.
    free = np.concatenate([[first[0]], np.log(np.maximum(np.diff(first), 1e-3))])
    params, mean, square = np.concatenate([weights, free]), 0.0, 0.0
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
    for step in range(1, STEPS + 1):
        weights, free = params[:n_features], params[n_features:]
        gaps = np.exp(free[1:])
        edges = np.concatenate([[-np.inf], free[0] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(row, value * weights[column], minlength=n)
        high, low = sigmoid(edges[grade + 1] - score), sigmoid(edges[grade] - score)
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = -high * (1 - high) / p, low * (1 - low) / p
        d_score = -(d_high + d_low)
        d_weights = np.bincount(column, value * d_score[row], minlength=n_features) / n + RIDGE * weights / n_features
        d_edges = (np.bincount(grade + 1, d_high, minlength=GRADES + 1) + np.bincount(grade, d_low, minlength=GRADES + 1))
        d_edges = d_edges[1:-1] / n
        tail = np.cumsum(d_edges[::-1])[::-1]
        gradient = np.concatenate([d_weights, [tail[0]], tail[1:] * gaps])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient ** 2
        params = params - RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    weights, free = params[:n_features], params[n_features:]
    return weights, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model for labelled documents; without toxic or without clean ones it grades everything 0."""
    on_workers(docs.sparkSession)
    sample = _sample(docs, labels)
    totals = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    nothing = Model((), np.zeros(0), np.full(GRADES - 1, 500.0))
    if not n_toxic or not n_clean:
        return nothing
    a, c = F.col("toxic"), F.col("clean")
    odds = F.log((a + 0.5) / (F.lit(n_toxic) - a + 0.5)) - F.log((c + 0.5) / (F.lit(n_clean) - c + 0.5))
    error = F.sqrt(1 / (a + 0.5) + 1 / (n_toxic - a + 0.5) + 1 / (c + 0.5) + 1 / (n_clean - c + 0.5))
    chosen = _document_counts(sample).withColumn("z", odds / error).where(
        (F.col("z") >= LEAST_Z) & ((a + 0.5) / n_toxic >= LEAST_RATIO * (c + 0.5) / n_clean)).orderBy(
        F.desc("z"), "feature").limit(MAX_FEATURES)
    names = tuple(sorted(r[0] for r in chosen.select("feature").collect()))
    if not names:
        return nothing
    rows = sorted(_counted(sample, names).collect(), key=lambda r: r.doc_id)
    toxic = np.array([r.toxic for r in rows])
    share = np.array([r.marked / max(1, r.n_words) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r.at) for r in rows])
    column = np.array([i for r in rows for i in r.at], np.int64)
    value = _rates(np.array([x for r in rows for x in r.counts]), np.array([r.n_words for r in rows])[row])
    weights, thresholds = fit_ordinal(row, column, value, _grades(toxic, share), len(names))
    return Model(names, weights, thresholds)


def _scored(
    rows: DataFrame, model: Model, columns: Sequence[str], texts_of: Callable[[pa.RecordBatch], pa.Array]
) -> DataFrame:
    on_workers(rows.sparkSession)
    out = T.StructType([rows.schema[c] for c in columns])
    out = out.add("severity", T.DoubleType()).add("p_toxic", T.DoubleType())
    out = out.add("grade", T.IntegerType()).add("rejected", T.BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(model.features)
        for batch in batches:
            n_words, _, at, counts, ends = counter.count(x.as_py() for x in texts_of(batch))
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            rates = _rates(np.array(counts, np.float64), np.array(n_words, np.float64)[row])
            used = model.weights[np.array(at, np.int64)] * rates
            above = model.above(np.bincount(row, used, minlength=batch.num_rows))
            p = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], 1), axis=1)
            severity = above.sum(1)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i) for i in range(len(columns))), pa.array(severity), pa.array(above[:, 0]),
                pa.array(p.argmax(1).astype(np.int32)), pa.array(severity >= REJECT_AT)],
                names=[*columns, "severity", "p_toxic", "grade", "rejected"])
        give_back_memory(counter.known)

    return rows.mapInArrow(run, out)


def score(docs: DataFrame, model: Model, columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with severity (expected grade), p_toxic, grade (likeliest) and rejected.

    Null and empty texts have no feature and get the model's lowest score. Rows are scored one by one, so repeated
    rows get the same result and an empty table none.
    """
    rows = docs.select(*columns, F.col("text").alias("text_to_score"))
    return _scored(rows, model, columns, lambda batch: batch.column(batch.num_columns - 1))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, in one scan; a row travels as a struct, under any column names."""
    rows = docs.select(F.struct("*").alias("row"))
    return _scored(rows, model, ("row",), lambda batch: batch.column(0).field("text")).where(
        ~F.col("rejected")).select("row.*")
