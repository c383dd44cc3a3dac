"""Document probability by a subword lattice.

An existing subword vocabulary gives the pieces and their first weights. A word, with a blank before it, is a lattice
whose arcs are the pieces that occur in it; its probability is the sum over all ways to cut it, computed by a forward
recursion in log space. A text is its words and an end, so its probability is the product over these. The weights are
re-estimated on the training documents' word counts by expectation maximisation, with the vocabulary's own weights as
the prior.

Words are bytes and every single byte is a piece, so every text has a probability. Counting, re-estimation and scoring
run on distinct words; the number of words is not bounded, so scores return to the documents by a join: documents are
dealt into blocks of bounded size, each block asks for its distinct words once, and answers meet the block's texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import block_count, on_workers, written

# Raw text of a block. Its words and scores are in memory with it.
TEXT_BLOCK = 8 << 20
# Distinct words a counting task holds before it passes them on.
COUNT_WORDS = 400_000
# Bytes of words whose lattices are worked on together.
BATCH_BYTES = 128 << 10
ROUNDS = 2
# The prior weighs as much as this many seen pieces.
PRIOR = 10_000.0


@dataclass(frozen=True)
class Pieces:
    """Byte strings of the lattice's arcs and the natural logs of their first probabilities; the last is the end."""

    texts: tuple[bytes, ...]
    logp: np.ndarray


@lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    """Pieces of a sentencepiece file.

    A unigram file's scores are log probabilities. A merge file's scores are negative ranks, which are taken for ranks
    in Zipf's law. Pieces that hold white space after their first place can occur in no word and are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    scores = [model.get_score(i) for i in range(size)]
    ranked = min(scores) < -1000
    weights: dict[bytes, float] = {}
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        name = model.id_to_piece(i)
        if model.is_byte(i):
            text, weight = bytes([int(name[3:5], 16)]), 1.0 / size
        else:
            text = name.replace("▁", " ").encode()
            weight = 1.0 / (10.0 - scores[i]) if ranked else float(np.exp(scores[i]))
        if text and len(text[1:].split()) <= 1 and not any(c in b" \t\n\x0b\f\r" for c in text[1:]):
            weights[text] = weights.get(text, 0.0) + weight
    for b in range(256):
        weights.setdefault(bytes([b]), 1.0 / size)
    texts = sorted(weights)
    p = np.array([weights[t] for t in texts] + [max(weights.values())])
    return Pieces((*texts, b""), np.log(p / p.sum()))


@lru_cache(maxsize=2)
def _automaton(path: str) -> tuple[ahocorasick.Automaton, np.ndarray]:
    pieces = load_pieces(path)
    found = ahocorasick.Automaton()
    for i, text in enumerate(pieces.texts[:-1]):
        found.add_word(text.decode("latin-1"), i)
    found.make_automaton()
    return found, np.array([len(t) for t in pieces.texts], np.int64)


class Lattices:
    """The lattices of a list of words, side by side.

    A word's nodes are the places between its bytes, in a row of their own; arcs are sorted by the depth of their
    end, so a pass over the depths works on all words at once.
    """

    def __init__(self, words: list[bytes], path: str):
        found, length = _automaton(path)
        joined = (b" " + b" ".join(words)).decode("latin-1")
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        pairs = np.fromiter(chain.from_iterable(found.iter(joined)), np.int64).reshape(-1, 2)
        end, piece = pairs[:, 0] + 1, pairs[:, 1]
        word = np.repeat(np.arange(len(words)), sizes)[end - 1]
        depth = end - first[word]
        order = np.argsort(depth.astype(np.uint16) if sizes.max() < 1 << 16 else depth, kind="stable")
        self.piece, self.word, depth = piece[order], word[order], depth[order]
        self.end = (end + word)[order]
        self.begin = self.end - length[self.piece]
        self.cuts = np.concatenate([[0], np.flatnonzero(np.diff(depth)) + 1, [len(depth)]])
        self.first = first + np.arange(len(words))
        self.last = self.first + sizes
        self.nodes = int(sizes.sum()) + len(words)

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """Log of the summed weight of all ways from a word's first node to each node."""
        alpha = np.full(self.nodes, -np.inf)
        alpha[self.first] = 0.0
        weight = logp[self.piece]
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            value = alpha[self.begin[a:b]] + weight[a:b]
            end = self.end[a:b]
            groups = np.concatenate([[0], np.flatnonzero(np.diff(end)) + 1])
            alpha[end[groups]] = np.logaddexp.reduceat(value, groups)
        return alpha

    def scores(self, logp: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability."""
        return self.forward(logp)[self.last]

    def expected(self, logp: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected to be used in words that occur ``counts`` times."""
        alpha = self.forward(logp)
        beta = np.full(self.nodes, -np.inf)
        beta[self.last] = 0.0
        weight = logp[self.piece]
        for a, b in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            begin = self.begin[a:b]  # arcs to one depth begin at different nodes
            beta[begin] = np.logaddexp(beta[begin], weight[a:b] + beta[self.end[a:b]])
        share = np.exp(alpha[self.begin] + weight + beta[self.end] - alpha[self.last][self.word])
        return np.bincount(self.piece, share * counts[self.word], minlength=len(logp))


def _word_batches(words: list[bytes]) -> Iterator[slice]:
    """Slices of about ``BATCH_BYTES``; the end, an empty word, must not be among the words."""
    begin = size = 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if size >= BATCH_BYTES:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(words):
        yield slice(begin, len(words))


def held_out(column: str = "doc_id") -> Column:
    """One document in five, by the id's checksum; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
                       held_out().alias("held_out"))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n): every word of the prepared documents, with its occurrences in those that are not held out.

    The empty word stands for the end of a text. Counts are added up in the task before they are shuffled.
    """
    on_workers(docs.sparkSession)
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train: Counter[bytes] = Counter()
        seen: set[bytes] = set()

        def passed_on() -> Iterator[pa.RecordBatch]:
            seen.difference_update(train)
            words = [*train, *seen]
            for begin in range(0, len(words), 50_000):
                part = words[begin:begin + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(part, pa.binary()), pa.array([train.get(w, 0) for w in part], pa.int64())], schema=schema)
            train.clear()
            seen.clear()

        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1)):
                words = text.as_py().lower().split()
                words.append(b"")
                if held.as_py():
                    seen.update(words)
                else:
                    train.update(words)
                if len(train) + len(seen) >= COUNT_WORDS:
                    yield from passed_on()
        yield from passed_on()

    counted = docs.select("text", "held_out").mapInArrow(run, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def reestimate(counts: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Natural logs of the pieces' probabilities, fitted to word counts.

    Each round brings one number per piece to the driver, and the vocabulary is fixed, so that is bounded.
    """
    pieces = load_pieces(path)
    logp, prior = pieces.logp, PRIOR * np.exp(pieces.logp)
    ends = counts.where(F.octet_length("word") == 0).agg(F.sum("n")).first()[0] or 0
    words = counts.where((F.octet_length("word") > 0) & (F.col("n") > 0))
    for _ in range(rounds):
        weights = logp

        def run(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(weights))
            for batch in batches:
                texts, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                for part in _word_batches(texts):
                    total += Lattices(texts[part], path).expected(weights, n[part])
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array(total[used])], names=["piece", "used"])

        sums = words.mapInArrow(run, "piece bigint, used double").groupBy("piece").agg(F.sum("used")).collect()
        used = np.zeros(len(logp))
        for piece, n in sums:
            used[piece] = n
        used[-1] = ends
        logp = np.log((used + prior) / (used.sum() + prior.sum()))
    return logp


def score_words(counts: DataFrame, path: str, logp: np.ndarray) -> DataFrame:
    """(word, n, logp) with each word's natural log probability under the lattice."""
    on_workers(counts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))  # like lengths together
            scores = np.full(len(texts), logp[-1])
            filled = [i for i in order if texts[i]]
            words = [texts[i] for i in filled]
            at = np.array(filled, np.int64)
            for part in _word_batches(words):
                scores[at[part]] = Lattices(words[part], path).scores(logp)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores)], names=["word", "n", "logp"])

    return counts.select("word", "n").mapInArrow(run, "word binary, n bigint, logp double")


def score_documents(docs: DataFrame, path: str, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Null texts are empty and have one token, the end. Repeated rows are scored and counted one by one. Without
    training documents the counts are zero and the pieces keep the vocabulary's weights. Other columns are not read.
    """
    on_workers(docs.sparkSession)
    prepared = _prepared(docs)
    counts = written(count_words(prepared), "word-counts")
    total, distinct = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    total, distinct = int(total or 0), int(distinct or 0)
    scored = score_words(counts, path, reestimate(counts, path, rounds))

    blocks = block_count(docs, TEXT_BLOCK)
    dealt = prepared.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))
    words = dealt.groupBy("block").applyInPandas(_block_words, "block int, word binary")
    answers = words.join(scored, "word").select("block", "word", "n", "logp")
    norm = total + 0.5 * (distinct + 1)

    def score(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        place = dict(zip(found["word"], range(len(found))))
        n = found["n"].to_numpy(np.int64)
        base = np.log10((n + 0.5) / norm)
        own = found["logp"].to_numpy() / np.log(10)
        rows = []
        for text in texts["text"]:
            tokens = text.lower().split()
            tokens.append(b"")
            at = np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))
            rows.append((len(at), int((n[at] > 0).sum()), float(base[at].sum()), float(own[at].sum())))
        out = pd.DataFrame(rows, columns=["n_tokens", "n_known", "base_score", "score"])
        out.insert(0, "doc_id", texts["doc_id"].to_numpy())
        out.insert(1, "held_out", texts["held_out"].to_numpy())
        out["train_tokens"] = total
        return out

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
               "base_score double, score double")


def _block_words(texts: pd.DataFrame) -> pd.DataFrame:
    words = {b""}
    for text in texts["text"]:
        words.update(text.lower().split())
    return pd.DataFrame({"block": int(texts["block"].iloc[0]), "word": list(words)})
