"""Phrase mining with weighted acyclic automata.

A shard of text is counted into an automaton: its paths are the shard's runs of one to three words, and an arc carries
how often the run that ends with it occurs. It is built level by level from the sorted runs; equal last states are
stored once. An automaton is cut into ranges of prefixes (first two words), and the automata of a range from all shards
are united, which adds the weights of equal paths. What occurs often enough stays as the range's count automaton.

The counts of a phrase's parts come from composition: the parts that candidates ask for, sent to the ranges that hold
them, form an acceptor, and following it and the count automaton in step gives the weights. Scores, the rule on longer
phrases and the ranking are DataFrame code.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import on_workers, text_or_empty, text_parts, written

MIN_COUNT = 10
TOP = 2000
# A phrase goes if a longer candidate that holds it occurs in this many of a hundred of its occurrences.
COVERED = 50
SCALE = 1_000_000
NO_LANG = "und"
# Words of a shard; more than 2^21 different ones would not fit into the packed keys. Bytes of text taken apart at once.
SHARD_WORDS = 1 << 20
PART_BYTES = 4 << 20
# Text of a range. Ranges are placed by a sample of so many bytes, and are never more than so many, each named by two
# words of so many bytes: the list of them stays under 64 MB. It only says where a run is counted.
RANGE_BYTES = 8 << 20
SAMPLE_BYTES = 64 << 20
MAX_RANGES = 1 << 19
NAME_BYTES = 48
# Of the sampled words every so many gives a place.
SAMPLE_STEP = 64
# Parts looked up in one group; parts of a language that are ranked on their own first.
LOOKUPS, PARTS = 500_000, 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _CUT.copy()
_GAP[[0x20, 0x09]] = True

# Range bounds per language: prefixes of two words, in order.
Bounds = dict[str, list[tuple[bytes, bytes]]]


# --- automata -----------------------------------------------------------------------------------------


@dataclass
class CountAutomaton:
    """Runs of up to three words with weights, as arrays of arcs.

    ``words`` are the labels in byte order. Arcs of the first state: ``label1``, ``weight1`` and the number of arcs
    ``size1`` of the state that they lead to; those lie one behind the other in ``label2``, ``weight2``, and lead to
    states ``state3``; state s has the ``size3[s]`` arcs that begin at the sum of the sizes before it in ``label3``,
    ``weight3``. A weight of 0 marks a path that is only the beginning of others.
    """

    words: pa.Array
    label1: np.ndarray
    weight1: np.ndarray
    size1: np.ndarray
    label2: np.ndarray
    weight2: np.ndarray
    state3: np.ndarray
    size3: np.ndarray
    label3: np.ndarray
    weight3: np.ndarray

    @classmethod
    def build(cls, words: pa.Array, runs: np.ndarray, counts: np.ndarray) -> CountAutomaton:
        """From distinct runs in order: an array of n x 3 labels, -1 where a run is shorter, and their counts."""
        a, b, c = runs[:, 0], runs[:, 1], runs[:, 2]
        n = len(a)
        new1 = np.ones(n, bool)
        new1[1:] = a[1:] != a[:-1]
        new2 = new1.copy()
        new2[1:] |= b[1:] != b[:-1]
        has2 = b >= 0
        at1, at2 = np.flatnonzero(new1), np.flatnonzero(new2 & has2)
        label1, weight1 = a[at1], np.where(b[at1] < 0, counts[at1], 0)
        parent = np.cumsum(new1) - 1
        size1 = np.bincount(parent[at2], minlength=len(at1))
        label2, weight2 = b[at2], np.where(c[at2] < 0, counts[at2], 0)
        third = c >= 0
        sizes = np.bincount((np.cumsum(new2 & has2) - 1)[third], minlength=len(at2))
        return cls(words, label1, weight1, size1, label2, weight2, *_shared(sizes, c[third], counts[third]))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """The runs in any order, as given to ``build``, and their counts."""
        begin3 = np.concatenate([[0], np.cumsum(self.size3)])
        sizes = self.size3[self.state3]
        own = np.repeat(np.arange(len(sizes)), sizes)
        ahead = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at3 = begin3[self.state3][own] + ahead
        first = np.repeat(np.arange(len(self.label1)), self.size1)
        none = lambda n: np.full(n, -1, np.int64)
        a = np.concatenate([self.label1, self.label1[first], self.label1[first[own]]])
        b = np.concatenate([none(len(self.label1)), self.label2, self.label2[own]])
        c = np.concatenate([none(len(self.label1)), none(len(self.label2)), self.label3[at3]])
        counts = np.concatenate([self.weight1, self.weight2, self.weight3[at3]])
        kept = counts > 0
        return np.stack([a[kept], b[kept], c[kept]], 1), counts[kept]

    def to_bytes(self) -> bytes:
        def narrow(values: np.ndarray) -> pa.Array:
            least = np.min_scalar_type(int(values.max())) if len(values) else np.uint8
            return pa.array(values.astype(least))

        fields = [self.words, *map(narrow, (
            self.label1, self.weight1, self.size1, self.label2, self.weight2, self.state3, self.size3, self.label3,
            self.weight3))]
        batch = pa.record_batch(
            [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in fields],
            names=[f"f{i}" for i in range(len(fields))])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CountAutomaton:
        batch = pa.ipc.open_stream(data).read_next_batch()
        words, *rest = (batch.column(i).flatten() for i in range(10))
        return cls(words, *(x.to_numpy().astype(np.int64) for x in rest))

    def texts(self, runs: np.ndarray) -> pa.Array:
        """The runs as text, words joined by a space."""
        parts = [self.words.take(pa.array(runs[:, k], mask=runs[:, k] < 0)) for k in range(3)]
        return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()), null_handling="skip")

    def compose(self, words: pa.Array, runs: np.ndarray) -> np.ndarray:
        """Weights of the paths that an acceptor over other labels shares with this automaton, 0 where there is none."""
        known = pc.index_in(words, self.words)
        label = pc.fill_null(known, -1).to_numpy().astype(np.int64)
        a, b, c = (np.where(runs[:, k] >= 0, label[runs[:, k]], -1) for k in range(3))
        n = len(self.words) + 1
        at1 = _find(self.label1, a)
        key2 = np.repeat(np.arange(len(self.label1)), self.size1) * n + self.label2
        at2 = np.where((at1 >= 0) & (b >= 0), _find(key2, at1 * n + b), -1)
        key3 = np.repeat(np.arange(len(self.size3)), self.size3) * n + self.label3
        state = self.state3[at2] if len(self.state3) else np.zeros(len(a), np.int64)
        at3 = np.where((at2 >= 0) & (c >= 0), _find(key3, state * n + c), -1)
        take = lambda weights, at: np.where(at >= 0, weights[at] if len(weights) else 0, 0)
        return np.where(
            runs[:, 2] >= 0, take(self.weight3, at3), np.where(
                runs[:, 1] >= 0, take(self.weight2, at2), take(self.weight1, at1)))


def _find(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of values in an ordered array, -1 where they are not in it."""
    if not len(ordered):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return np.where(ordered[at] == wanted, at, -1)


def _shared(sizes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """States of the last level with equal states as one: (state of each parent, sizes, labels, weights).

    States without arcs are one, and so are those with the same single arc, which are most of all; longer ones stay.
    """
    begin = np.cumsum(sizes) - sizes
    state = np.zeros(len(sizes), np.int64)
    single = np.flatnonzero(sizes == 1)
    arcs = np.stack([label[begin[single]], weight[begin[single]]], 1) if len(single) else np.zeros((0, 2), np.int64)
    order = np.lexsort((arcs[:, 1], arcs[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (arcs[order][1:] != arcs[order][:-1]).any(1)
    state[single[order]] = np.cumsum(new)
    distinct = arcs[order][new]
    longer = np.flatnonzero(sizes > 1)
    state[longer] = 1 + len(distinct) + np.arange(len(longer))
    own = np.repeat(sizes > 1, sizes)
    return (
        state, np.concatenate([[0], np.ones(len(distinct), np.int64), sizes[longer]]),
        np.concatenate([distinct[:, 0], label[own]]), np.concatenate([distinct[:, 1], weight[own]]))


def _summed(key: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts or how often they occur."""
    order = None if counts is None else np.argsort(key, kind="stable")
    key = np.sort(key) if order is None else key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    if order is None:
        return key[at], np.diff(np.append(at, len(key)))
    return key[at], np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)


def _unpacked(key: np.ndarray, n: int) -> np.ndarray:
    return np.stack([key // (n * n), key // n % n - 1, key % n - 1], 1)


def merged(automata: list[CountAutomaton]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Labels, distinct runs in order, and the sums of their weights over some automata."""
    words, places = _vocabulary([a.words for a in automata])
    parts, counts, at = [], [], 0
    n = len(words) + 1
    for a in automata:
        place = places[at:at + len(a.words)]
        at += len(a.words)
        runs, own = a.runs()
        runs = np.where(runs >= 0, place[runs], -1)
        parts.append((runs[:, 0] * n + runs[:, 1] + 1, runs[:, 2] + 1))
        counts.append(own)
    front, last, count = (np.concatenate(x) for x in (*zip(*parts), counts))
    if n < 1 << 21:
        key, sums = _summed(front * n + last, count)
        return words, _unpacked(key, n), sums
    # Three labels no longer fit into one number, so the first two get a number of their own.
    pairs, front = np.unique(front, return_inverse=True)
    key, sums = _summed(front * n + last, count)
    front = pairs[key // n]
    return words, np.stack([front // n, front % n - 1, key % n - 1], 1), sums


def union(automata: list[CountAutomaton]) -> CountAutomaton:
    """One automaton with all paths; weights of equal paths are added."""
    return CountAutomaton.build(*merged(automata))


def _reduced(words: pa.Array, runs: np.ndarray, counts: np.ndarray) -> CountAutomaton:
    """An automaton with only the labels that its runs use."""
    used, places = np.unique(np.append(runs.reshape(-1), -1), return_inverse=True)
    return CountAutomaton.build(
        words.take(pa.array(used[1:])), places.reshape(-1)[:-1].reshape(-1, 3) - 1, counts)


def _vocabulary(lists: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and the place in it of every word of the lists."""
    coded = pa.concat_arrays([x.cast(pa.binary()) for x in lists]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()]


# --- counting -----------------------------------------------------------------------------------------


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of some texts: their bytes, the text of each, and whether a piece begins with it."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]]
    ends = offsets[1:] - offsets[0]
    inside = ~_GAP[data]
    edge = np.zeros(len(data), bool)  # a word begins
    edge[1:] = inside[1:] & ~inside[:-1]
    if len(data):
        edge[0] = inside[0]
    begins = ends[:-1][(ends[:-1] < len(data))]
    edge[begins] = inside[begins]
    first = np.flatnonzero(edge)
    of = np.searchsorted(ends, first, side="right")
    # The bytes of all words one behind the other; a word is as long as the inside bytes up to the next one's.
    packed = np.concatenate([[0], np.cumsum(inside, dtype=np.int32)])
    at = np.append(packed[first], packed[-1])
    cuts = np.concatenate([[0], np.cumsum(_CUT[data], dtype=np.int32)])[first]
    piece = np.ones(len(first), bool)
    piece[1:] = (cuts[1:] != cuts[:-1]) | (of[1:] != of[:-1])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[inside])])
    return words, of, piece


def _shard_runs(labels: np.ndarray, piece: np.ndarray, stop: int, n: int) -> np.ndarray:
    """Keys of all runs that begin before ``stop``; up to two words behind it belong to the last of them."""
    one = np.arange(min(stop, len(labels)))
    two = one[one + 1 < len(labels)]
    two = two[~piece[two + 1]]
    three = two[two + 2 < len(labels)]
    three = three[~piece[three + 2]]
    second = lambda at: (labels[at] * n + labels[at + 1] + 1) * n
    return np.concatenate([labels[one] * n * n, second(two), second(three) + labels[three + 2] + 1])


def _cuts(words: pa.Array, runs: np.ndarray, bounds: list[tuple[bytes, bytes]]) -> np.ndarray:
    """Where the ranges begin in ordered runs: the first run of each that is not before the range's bound."""
    if not bounds:
        return np.zeros(0, np.int64)
    n = len(words) + 1
    names = pa.array([x for pair in bounds for x in pair], pa.binary())
    # Places of the bounds' words among the words here: an unknown one stands before the next greater.
    both = pa.concat_arrays([words.cast(pa.binary()), names])
    order = pc.array_sort_indices(both).to_numpy()
    is_word = order < len(words)
    below = np.empty(len(both), np.int64)
    below[order] = np.cumsum(is_word) - is_word
    place = below[len(words):].reshape(-1, 2)
    known = pc.is_in(names, words.cast(pa.binary())).to_numpy(zero_copy_only=False).reshape(-1, 2)
    # Equal values may stand in any order in the sort, so a known word is looked up.
    found = pc.fill_null(pc.index_in(names, words.cast(pa.binary())), 0).to_numpy().reshape(-1, 2)
    place = np.where(known, found, place)
    second = np.where(known[:, 0] & np.array([b != b"" for _, b in bounds]), place[:, 1] + 1, 0)
    return np.searchsorted(runs[:, 0] * n + runs[:, 1] + 1, place[:, 0] * n + second, side="left")


def _count_shards(docs: DataFrame, bounds: Bounds) -> DataFrame:
    """(lang, range, automaton): the runs of each shard of text, cut into ranges."""

    def shards(words: pa.Array, langs: list[str], lang: np.ndarray, piece: np.ndarray) -> Iterator[tuple]:
        for number in np.unique(lang).tolist():
            own = np.flatnonzero(lang == number)
            for begin in range(0, len(own), SHARD_WORDS - 2):
                part = own[begin:begin + SHARD_WORDS]
                known, labels = _vocabulary([words.take(pa.array(part))])
                n = len(known) + 1
                key, counts = _summed(_shard_runs(labels, piece[part], min(SHARD_WORDS - 2, len(part)), n))
                runs = _unpacked(key, n)
                at = np.concatenate([[0], _cuts(known, runs, bounds.get(langs[number], [])), [len(runs)]])
                for i in np.flatnonzero(np.diff(at)):
                    own_range = slice(at[i], at[i + 1])
                    yield langs[number], int(i), _reduced(known, runs[own_range], counts[own_range]).to_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        known: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            words = pa.concat_arrays([w for w, _, _ in waiting])
            lang, piece = (np.concatenate([x[i] for x in waiting]) for i in (1, 2))
            waiting.clear()
            for name, number, data in shards(words, list(known), lang, piece):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([number], pa.int32()), pa.array([data], pa.binary())],
                    names=["lang", "range", "automaton"])

        for batch in batches:
            own = batch.column(0).dictionary_encode()
            numbers = np.array([known.setdefault(x, len(known)) for x in own.dictionary.to_pylist()], np.int64)
            numbers = numbers[own.indices.to_numpy()] if len(own) else numbers
            for part, texts in text_parts(batch.column(1), PART_BYTES):
                words, of, piece = _tokens(texts)
                waiting.append((words, numbers[part][of], piece))
                if sum(len(w) for w, _, _ in waiting) >= SHARD_WORDS:
                    yield from flush()
        if waiting:
            yield from flush()

    return docs.select("lang", "text").mapInArrow(run, "lang string, range int, automaton binary")


def range_bounds(
    docs: DataFrame, range_bytes: int = RANGE_BYTES, sample_bytes: int = SAMPLE_BYTES, step: int = SAMPLE_STEP
) -> Bounds:
    """Prefixes that part each language's runs into ranges of about ``range_bytes`` of text, from a bounded sample."""
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    share = min(1.0, sample_bytes / max(1, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (x for batch in batches for x in text_parts(batch.column(1), PART_BYTES, batch.column(0))):
            words, of, piece = _tokens(texts)
            at = np.arange(0, len(words), step)
            after = np.minimum(at + 1, max(0, len(words) - 1))
            pair = (after > at) & ~piece[after]
            name = lambda i: pc.binary_slice(words.take(pa.array(i)).cast(pa.binary()), 0, NAME_BYTES)
            yield pa.RecordBatch.from_arrays([
                part.take(pa.array(of[at])), name(at),
                pc.if_else(pa.array(pair, pa.bool_()), name(after), pa.scalar(b"", pa.binary()))],
                names=["lang", "a", "b"])

    taken = docs.select("lang", "text") if share == 1 else docs.select("lang", "text").sample(share, seed=7)
    places: dict[str, list[tuple[bytes, bytes]]] = {}
    for row in taken.mapInArrow(run, "lang string, a binary, b binary").collect():
        places.setdefault(row.lang, []).append((bytes(row.a), bytes(row.b)))
    total = sum(map(len, places.values()))
    bounds = {}
    for lang, found in places.items():
        parts = min(-(-size * len(found) // (total * range_bytes)), len(found), max(1, MAX_RANGES * len(found) // total))
        found.sort()
        bounds[lang] = sorted({found[i * len(found) // parts] for i in range(1, parts)})
    return bounds


def count_runs(docs: DataFrame, bounds: Bounds, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, range, n, automaton): words in a range, and its runs that occur ``min_count`` times or more."""

    def unite(rows: pa.Table) -> pa.Table:
        words, runs, sums = merged([CountAutomaton.from_bytes(x.as_py()) for x in rows["automaton"]])
        often = sums >= min_count
        frequent = _reduced(words, runs[often], sums[often])
        return pa.table({
            "lang": rows["lang"][:1], "range": rows["range"][:1],
            "n": pa.array([int(sums[runs[:, 1] < 0].sum())], pa.int64()),
            "automaton": pa.array([frequent.to_bytes()], pa.binary())})

    # A task for each range, so that a task does not grow with the input.
    ranges = max(1, sum(len(b) + 1 for b in bounds.values()))
    return _count_shards(docs, bounds).repartition(ranges, "lang", "range").groupBy("lang", "range").applyInArrow(
        unite, "lang string, range int, n bigint, automaton binary")


# --- lookups ------------------------------------------------------------------------------------------


def _acceptor(parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Labels and runs of phrases given as text."""
    split = pc.split_pattern(parts.cast(pa.string()), " ")
    words, places = _vocabulary([split.flatten().cast(pa.binary())])
    begin = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
    runs = np.full((len(parts), 3), -1, np.int64)
    for k in range(3):
        some = np.flatnonzero(begin[:-1] + k < begin[1:])
        runs[some, k] = places[begin[some] + k]
    return words, runs


def candidates(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a) of all frequent runs of two and three words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                automaton = CountAutomaton.from_bytes(data)
                runs, a = automaton.runs()
                long = runs[:, 1] >= 0
                runs, a = runs[long], a[long]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(a), pa.string()), automaton.texts(runs).cast(pa.string()),
                    pa.array((runs >= 0).sum(1).astype(np.int32)), pa.array(a)], names=["lang", "phrase", "words", "a"])

    return counts.select("lang", "automaton").mapInArrow(run, "lang string, phrase string, words int, a bigint")


def part_counts(wanted: DataFrame, counts: DataFrame, bounds: Bounds, lookups: int = LOOKUPS) -> DataFrame:
    """(lang, phrase, cut, side, weight) for ``wanted`` (lang, phrase, cut, side, part).

    A part goes to the range that holds it; a range that is asked much, as a frequent word is part of many phrases, is
    asked in several groups.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = []
            for lang, part in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
                words = part.encode().split(b" ", 2)
                numbers.append(bisect_right(bounds.get(lang, []), (words[0], words[1] if len(words) > 1 else b"")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int32())], names=[*batch.schema.names, "range"])

    asked = written(wanted.select("lang", "phrase", "cut", "side", "part").mapInArrow(
        locate, "lang string, phrase string, cut int, side string, part string, range int"), "lookups")
    groups = asked.groupBy("lang", "range").agg((F.count(F.lit(1)) / lookups).cast("int").alias("more"))
    groups = written(groups, "lookup-groups")
    dealt = asked.join(groups, ["lang", "range"]).withColumn(
        "group", F.pmod(F.xxhash64("phrase", "cut", "side"), F.col("more") + 1).cast("int"))
    copies = counts.select("lang", "range", "automaton").join(groups, ["lang", "range"]).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.col("more"))))

    def compose(asked: pa.Table, copies: pa.Table) -> pa.Table:
        if not len(asked):
            return pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()),
                             "cut": pa.array([], pa.int32()), "side": pa.array([], pa.string()),
                             "weight": pa.array([], pa.int64())})
        parts = asked["part"].combine_chunks().dictionary_encode()
        words, runs = _acceptor(parts.dictionary)
        weight = CountAutomaton.from_bytes(copies["automaton"][0].as_py()).compose(words, runs)
        return pa.table({
            "lang": asked["lang"], "phrase": asked["phrase"], "cut": asked["cut"], "side": asked["side"],
            "weight": pa.array(weight[parts.indices.to_numpy()], pa.int64())})

    keys = ("lang", "range", "group")
    return dealt.groupBy(*keys).cogroup(copies.select(*keys, "automaton").groupBy(*keys)).applyInArrow(
        compose, "lang string, phrase string, cut int, side string, weight bigint")


def _parts(found: DataFrame) -> DataFrame:
    """(lang, phrase, cut, side, part): both parts of every cut of the candidates."""
    word = F.split("phrase", " ")
    cuts = found.withColumn("w", word).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    left = F.struct(F.lit("l").alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("part"))
    right = F.struct(F.lit("r").alias("side"), F.array_join(
        F.slice("w", F.col("cut") + 1, F.col("words") - F.col("cut")), " ").alias("part"))
    return cuts.select("lang", "phrase", "cut", F.explode(F.array(left, right)).alias("p")).select(
        "lang", "phrase", "cut", "p.side", "p.part")


def _covered(found: DataFrame, covered: int) -> DataFrame:
    """(lang, phrase) of the candidates that mostly occur within one longer candidate."""
    w = F.split("phrase", " ")
    inner = found.where("words = 3").select("lang", F.col("a").alias("longer"), F.explode(F.array(
        F.array_join(F.slice(w, 1, 2), " "), F.array_join(F.slice(w, 2, 2), " "))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return found.join(most, ["lang", "phrase"]).where(100 * F.col("longer") >= covered * F.col("a")).select("lang", "phrase")


def _score() -> Column:
    """floor(SCALE * a * a / (l * r)) in whole numbers of 38 digits; parts occur at least as often as the phrase."""
    a, l, r = (f"CAST({name} AS decimal(19,0))" for name in "alr")
    return F.expr(f"(CAST({SCALE} AS decimal(7,0)) * CAST({a} * {a} AS decimal(31,0))) div ({l} * {r})")


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language of ``docs`` (text, lang).

    Null texts are empty; a null language counts as ``und``. Repeated rows count one by one, whatever their ids. Equal
    scores are ordered by count, then by the bytes of the phrase; equal cuts by the shorter first part. A table without
    frequent phrases gives no rows; other columns are not read.
    """
    on_workers(docs.sparkSession)
    texts = docs.select(text_or_empty().alias("text"), F.coalesce("lang", F.lit(NO_LANG)).alias("lang"))
    bounds = range_bounds(texts, range_bytes)
    counts = written(count_runs(texts, bounds, min_count), "counts")
    found = written(candidates(counts), "candidates")
    kept = written(found.join(_covered(found, covered), ["lang", "phrase"], "left_anti"), "phrases")
    weights = part_counts(_parts(kept), counts, bounds)
    cuts = weights.groupBy("lang", "phrase", "cut").agg(
        F.max(F.when(F.col("side") == "l", F.col("weight"))).alias("l"),
        F.max(F.when(F.col("side") == "r", F.col("weight"))).alias("r"))
    scored = cuts.join(kept.select("lang", "phrase", "a"), ["lang", "phrase"]).withColumn("score", _score())
    least = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a")).alias("s")).select(
        "lang", "phrase", "s.score", "s.l", "s.r", "s.a")
    # A language may hold most phrases, so the first of each of its parts are found first.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = least.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    n = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(n, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("bigint").alias("score"))
