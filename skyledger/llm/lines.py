"""Line deduplication: a line goes if an earlier one is equal, within one edit, or the same but for a few words.

Equal lines are found by a 128-bit checksum. For the others a line's deletion neighbourhood (the line without one of its
characters, for each place) is hashed; two lines are one edit apart if they are equal without the same place, or if one
without a place is the other. Writing out a key for each character would cost as many rows as the corpus has
characters, so the neighbourhood is emitted from coarse to fine: first a line without either half, then, where two
lines meet, without a sixteenth of that half, and only where they meet again without single characters. One edit lies
in one half and in one sixteenth of it, so no pair is lost on the way. Groups are joined by their earliest member, never
pairwise, and every pair is verified by its edit distance before a line goes.

Lines are near by words if they are equal without at most ``max_words`` words each, taken out at the same places, and
what is taken out is at most ``share`` of either line's characters: a bound of words dropped, added or changed, relative
to the line. What is left is cut into ``max_words + 1`` parts, and one of them holds none of the places, so lines that
are near share the key of a part. A passage that many lines share is enough for that, so each part is halved: the
places lie in ``max_words`` of the halves at most, and lines that are near share the key of all others, for the same
halves. Where few lines share a key of a part, each two are compared at once, so a line sends the keys of halves only where
many lines share each of its whole parts. Of those keys too, few lines are compared each with each; of many, each is compared
with the key's earliest, and lines that this settles look for nothing more. If many are left, the places are narrowed down
as above, and at single places all lines of a key are near, so the earliest stands for the others. A word goes up to the
next one's start, and a character of a script without blanks is a word. ``max_words = 0`` leaves this out.

Order is (doc_id, checksum of the text, line number), nulls first. Lines are compared without white space at their
ends. Lines of fewer than ``MIN_CHARS`` characters go only if equal, lines of fewer than ``2 * max_words + 1`` words are
not compared by words; lines without a character but white space stay.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import on_workers, text_or_empty, text_parts, written

MIN_CHARS = 20
# Words and share of a line's characters that may differ, in the registered query and the pipeline.
MAX_WORDS = 2
SHARE = 0.1
# Characters hashed together, but for a single longer text; few enough for a core's cache.
PART_CHARS = 1 << 17
# Parts of a half in the second step.
FINE = 16
# At most so many parts of a stretch of words in a step, of so many words at least.
WORD_FINE = 8
WORD_LAST = 4
# Lines of a key up to this number are compared each with each; keys of more lines are narrowed down.
PAIR_LINES = 16
# Bits for the keys that two lines share, 64 a key up to 32 MB; rows whose bit is not set are not shuffled again.
MAX_BITS = 28
CHUNK_BITS = 15
# Keys of a bucket that is searched for shared ones in one go, about, and buckets (as bits) at least.
BUCKET_KEYS = 1 << 22
BUCKET_BITS = 7
# Keys a task gathers before it passes them on.
ROWS_OUT = 100_000
# Lines and their codes are broadcast to fetch their texts up to this size; a line takes some bytes besides its codes.
BROADCAST_BYTES = 32 << 20
LINE_BYTES = 64

SPACES = " \t\x0b\f\r"
LINE = ["doc_id", "tie", "line_no"]
LINE_TYPES = "doc_id bigint, tie bigint, line_no int"
PLACED = ["id", "key", "code", "line", "seeks"]
PLACED_TYPES = "id bigint, key bigint, code bigint, line struct<doc_id: bigint, tie: bigint, line_no: int>, seeks boolean"
# From here on (radicals, CJK, kana, Hangul, ...) a character is a word.
NO_BLANKS = 0x2E80
WORD = re.compile(f"[{chr(NO_BLANKS)}-\U0010ffff][ \t-\r]*|[^ \t-\r{chr(NO_BLANKS)}-\U0010ffff]+[ \t-\r]*")
CHAR_KEYS = 4

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to ``n``."""
    both = []
    for base in (_BASE, _INVERSE):
        powers = np.full(n + 1, base, np.uint64)
        powers[0] = 1
        both.append(np.cumprod(powers, dtype=np.uint64))
    return both[0], both[1]


class Hashes:
    """Hashes of any stretch of a text in constant time, from running sums of its characters."""

    def __init__(self, text: str):
        self.chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(self.chars)
        # Tables of a few lengths serve all texts but very long ones.
        powers, self.back = _powers(2 * PART_CHARS) if n <= 2 * PART_CHARS else _powers.__wrapped__(n)
        mixed = self.chars.astype(np.uint64)
        mixed += np.uint64(1)
        mixed *= _MIX[0]
        mixed ^= mixed >> np.uint64(31)
        mixed *= _MIX[1]
        mixed *= powers[:n]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed, out=self.sums[1:])

    def without(self, begin, end, hole, upto) -> np.ndarray:
        """Hash of the stretches from ``begin`` to ``end`` without the holes from ``hole`` to ``upto``."""
        first = (self.sums[hole] - self.sums[begin]) * self.back[begin]
        second = (self.sums[end] - self.sums[upto]) * self.back[begin] * self.back[np.asarray(upto) - hole]
        return first + second

    def of(self, begin, end) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.back[begin]

    def words(self) -> np.ndarray:
        """Where words start, and the text's length; the text begins with a word and ends with a blank."""
        blank = (self.chars == 32) | (self.chars - np.uint32(9) <= 4)
        alone = self.chars >= NO_BLANKS
        start = ~blank & alone
        start[1:] |= ~blank[1:] & (blank | alone)[:-1]
        start[:1] = True
        return np.append(np.flatnonzero(start), len(self.chars))


def _key(hashed: np.ndarray, length, kind: int, at) -> np.ndarray:
    """Key of a line without a hole; lines meet only for one target length, step and place."""
    key = hashed ^ (np.atleast_1d(length).astype(np.uint64) * _MIX[2])
    key = (key ^ key >> np.uint64(30)) * _MIX[0]
    key += np.atleast_1d(at).astype(np.uint64) * _MIX[1] + np.array([kind], np.uint64) * _BASE
    return ((key ^ key >> np.uint64(27)) * _MIX[1]).view(np.int64)




def _half_keys(h: Hashes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Four keys per line: without either half, as a line of its own length and as the longer one of a pair."""
    keys = []
    for longer in (0, 1):
        length = end - begin - longer
        for half in (0, 1):
            hole = begin + half * (length // 2)
            upto = np.where(half, end, begin + length // 2 + longer)
            keys.append(_key(h.without(begin, end, hole, upto), length, 1, half))
    return np.stack(keys, 1)


def _parts(max_words: int) -> list[tuple[int, int, int]]:
    """(part, taken, before): a part of what is left, words taken out of the line, and how many of them before the part."""
    return [(part, taken, before) for part in range(max_words + 1) for taken in range(max_words + 1)
            for before in range(taken + 1)
            if (part > 0 or before == 0) and (part < max_words or before == taken)] if max_words else []


def _part_keys(h: Hashes, begin: np.ndarray, end: np.ndarray, max_words: int) -> np.ndarray:
    """A key for each of ``_parts`` per line (zero for lines of too few words)."""
    words = h.words()
    first = np.searchsorted(words, begin)
    n = np.searchsorted(words, end) - first
    enough = n > 2 * max_words
    first, n = first[enough], n[enough]
    keys = np.zeros((len(begin), len(_parts(max_words))), np.int64)
    for i, (part, taken, before) in enumerate(_parts(max_words)):
        left = n - taken
        a, b = (words[first + (p * left // (max_words + 1)) + before] for p in (part, part + 1))
        keys[enough, i] = _key(h.of(a, b), left, 5, part)
    return keys


def _scan(texts: list[str], max_words: int) -> tuple[list[int], list[int], list[bytes], np.ndarray, np.ndarray]:
    """Per line that is not blank: index of its text, line number, checksum, characters, keys (zero for short lines)."""
    owner, number, digest, begins, ends, owns = [], [], [], [], [], []
    at = 0
    for i, text in enumerate(texts):
        for j, line in enumerate(text.split("\n")):
            own = line.strip(SPACES)
            if own:
                owner.append(i)
                number.append(j)
                digest.append(xxhash.xxh3_128_digest(own.encode()))
                begins.append(at)
                ends.append(at + len(own))
                owns.append(own)
                at += len(own) + 1
    begin, end = np.array(begins, np.int64), np.array(ends, np.int64)
    keys = np.zeros((len(begins), CHAR_KEYS + len(_parts(max_words))), np.int64)
    long = np.flatnonzero(end - begin >= MIN_CHARS)
    if len(long):
        h = Hashes(" ".join(owns) + " ")
        keys[long, :CHAR_KEYS] = _half_keys(h, begin[long], end[long])
        if max_words:
            keys[long, CHAR_KEYS:] = _part_keys(h, begin[long], end[long], max_words)
    return owner, number, digest, end - begin, keys


def _rows(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("tie"), text.alias("text"))


def first_lines(docs: DataFrame, max_words: int = 0) -> DataFrame:
    """(doc_id, tie, line_no, size, keys): the earliest of each set of equal lines, with its characters."""
    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_parts(batch.column(2), PART_CHARS):
                owner, number, digest, size, keys = _scan(texts.to_pylist(), max_words)
                own = pa.array(owner, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[part].take(own), batch.column(1)[part].take(own), pa.array(number, pa.int32()),
                    pa.array(digest, pa.binary()), pa.array(size.astype(np.int32)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(owner) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.reshape(-1)))],
                    names=[*LINE, "digest", "size", "keys"])

    lines = _rows(docs).mapInArrow(run, f"{LINE_TYPES}, digest binary, size int, keys array<bigint>")
    # All copies of a line have the same keys, so the copy that the minimum picks does not matter for them.
    firsts = lines.groupBy("digest").agg(F.min(F.struct(*LINE, "size", "keys")).alias("f"))
    return firsts.select(*(F.col(f"f.{c}").alias(c) for c in [*LINE, "size", "keys"]))


def _meeting(rows: DataFrame) -> DataFrame:
    """The rows (line, code, key, longer) whose key two lines share that can be one edit apart."""
    met = rows.groupBy("key").agg(
        F.count_if(~F.col("longer")).alias("same"), F.count_if("longer").alias("more")).where(
        "same > 1 OR same = 1 AND more > 0").select("key")
    return rows.join(met, "key")


def _same_line(left: str, right: str) -> Column:
    return F.expr(" AND ".join(f"{left}.{c} <=> {right}.{c}" for c in LINE))


def _codes_of(rows: DataFrame) -> DataFrame:
    """(line, codes): a line has 4 codes or 4 * FINE at most."""
    return _meeting(rows).groupBy(*LINE).agg(F.collect_set("code").alias("codes"))


def _with_texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``lines`` (line, id, codes) with the line's ``text``, white space at its ends removed."""
    few = (lines.agg(F.sum(LINE_BYTES + 4 * F.size("codes"))).first()[0] or 0) <= BROADCAST_BYTES
    more = [c for c in lines.columns if c not in LINE]
    wanted = lines.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("line_no", *more)).alias("wanted"))
    rows = _rows(docs).dropDuplicates(["doc_id", "tie"]) if not few else _rows(docs)
    joined = rows.alias("d").join(
        (F.broadcast(wanted) if few else wanted).alias("w"), F.expr("d.doc_id <=> w.doc_id AND d.tie <=> w.tie"))
    each = joined.select("d.doc_id", "d.tie", F.split("text", "\n").alias("own"), F.explode("wanted").alias("w"))
    return each.select(
        "doc_id", "tie", F.col("w.line_no").alias("line_no"), *(F.col(f"w.{c}").alias(c) for c in more),
        F.btrim(F.get("own", F.col("w.line_no")), F.lit(SPACES)).alias("text")).dropDuplicates(LINE)


def _holes(code: int, n: int) -> tuple[int, int, int]:
    """(longer, begin, end) of the half that a code of the first step leaves out, as places of the shorter line."""
    longer, half = code >> 1, code & 1
    length = n - longer
    return longer, (length // 2 if half else 0), (length if half else length // 2)


def _fine_cut(begin: int, end: int) -> np.ndarray:
    return begin + np.arange(FINE + 1, dtype=np.int64) * (end - begin) // FINE


def _emit(lines: DataFrame, step: int) -> DataFrame:
    """Keys of the second step (without a part of a half) or the third (without a character)."""
    on_workers(lines.sparkSession)

    def fine(h: Hashes, n: int, codes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        for code in codes:
            longer, begin, end = _holes(code, n)
            cut = _fine_cut(begin, end)
            a, b = cut[:-1], cut[1:] + longer
            yield _key(h.without(0, n, a, b), n - longer, 2, a), code * FINE + np.arange(FINE), bool(longer)

    def single(h: Hashes, n: int, codes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        own, other = set(), set()
        for code in codes:
            longer, begin, end = _holes(code // FINE, n)
            cut = _fine_cut(begin, end)
            a, b = int(cut[code % FINE]), int(cut[code % FINE + 1])
            (other if longer else own).update(range(a, b + longer))
        if own:
            at = np.array(sorted(own), np.int64)
            yield _key(h.without(0, n, at, at + 1), n, 3, at), np.zeros(len(at), np.int64), False
            whole = np.zeros(1, np.int64)
            yield _key(h.without(0, n, whole, whole), n, 4, 0), whole + 1, False
        if other:
            at = np.array(sorted(other), np.int64)
            yield _key(h.without(0, n, at, at + 1), n - 1, 4, 0), np.ones(len(at), np.int64), True

    keys_of = fine if step == 2 else single

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, ...]] = []
            rows = 0
            for i, (text, codes) in enumerate(zip(batch.column(3), batch.column(4))):
                text = text.as_py()
                h = Hashes(text)
                for key, code, longer in keys_of(h, len(text), codes.as_py()):
                    n = len(key)
                    found.append((np.full(n, i, np.int32), key, code.astype(np.int32), np.full(n, longer)))
                    rows += n
                if rows >= ROWS_OUT or found and i == batch.num_rows - 1:
                    at, key, code, longer = (pa.array(np.concatenate(c)) for c in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(at) for c in range(3)), key, code, longer],
                        names=[*LINE, "key", "code", "longer"])
                    found, rows = [], 0

    return lines.select(*LINE, "text", "codes").mapInArrow(
        run, f"{LINE_TYPES}, key bigint, code int, longer boolean")


def _one_edit_lines(texts: DataFrame) -> DataFrame:
    """(doc_id, tie, line_no) of the lines among ``texts`` that are one edit from an earlier one."""
    finer = _codes_of(_emit(texts, 2))
    left = written(texts.drop("codes").alias("t").join(finer.alias("f"), _same_line("t", "f")).select(
        *(f"t.{c}" for c in LINE), "text", "codes"), "line-parts")
    keys = _emit(left, 3)
    # Code 0: equal without one place, so all lines of a key are one edit from the earliest. Code 1: a line and those
    # that are it with a character more, so each is compared with the earliest of the other kind.
    line = F.struct(*LINE)
    best = keys.groupBy("key").agg(
        F.min(F.when(~F.col("longer"), line)).alias("least"), F.min(F.when(F.col("longer"), line)).alias("least_longer"))
    pairs = keys.join(best, "key").select(
        line.alias("line"), F.when((F.col("code") == 0) | F.col("longer"), F.col("least")).otherwise(
            F.col("least_longer")).alias("earlier")).where("earlier < line").distinct()
    text = left.select(F.struct(*LINE).alias("id"), "text")
    checked = pairs.join(text.toDF("line", "x"), "line").join(text.toDF("earlier", "y"), "earlier").where(
        F.levenshtein("x", "y", 1) >= 0)
    return checked.select("line.*").distinct()


def _halves(max_words: int) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """(open halves of parts, words taken out of the line in each): what the keys of the second step leave out."""
    n = range(max_words + 1)
    taken = [t for t in itertools.product(n, repeat=max_words) if sum(t) <= max_words]
    return list(itertools.product(itertools.combinations(range(2 * max_words + 2), max_words), taken))


def _whole_parts(halves: tuple[int, ...], taken: tuple[int, ...], max_words: int) -> list[int]:
    """Indices of ``_parts`` of the parts without an open half."""
    return [_parts(max_words).index((part, sum(taken), sum(t for half, t in zip(halves, taken) if half < 2 * part)))
            for part in range(max_words + 1) if not {2 * part, 2 * part + 1} & set(halves)]


def _half_cut(left, max_words: int) -> np.ndarray:
    """Where the halves of parts begin, and the end, in words of what is left."""
    return np.arange(2 * max_words + 3) * np.asarray(left)[..., None] // (2 * max_words + 2)


@lru_cache(maxsize=1 << 14)
def _spots(code: int, step: int, n: int, max_words: int) -> list[tuple[int, tuple[int, ...], tuple[tuple[int, int], ...]]]:
    """(code, mask, ranges) that a code stands for in a line of ``n`` words; lines of a key have the same ones.

    The mask tells at which places this line has a word that is taken out; the ranges tell where the places can be, in
    words of what is left, in ascending order. A code of step 0 is an index of ``_halves``; each later step adds a digit.
    """
    digits, spots = [], []
    for _ in range(step):
        code, digit = divmod(code, WORD_FINE ** max_words)
        digits.append(digit)
    which = None
    ways = list(itertools.product(
        itertools.combinations_with_replacement(range(max_words), max_words), itertools.product((0, 1), repeat=max_words)))
    if step:
        code, which = divmod(code, len(ways))
    halves, taken = _halves(max_words)[code]
    cut = _half_cut(n - sum(taken), max_words).tolist()
    for i, (homes, mask) in enumerate(ways):
        used = {halves[j] for j in homes}
        spare = [half for half in range(2 * max_words + 2) if half not in used]
        # Places in fewer halves belong to one choice of open halves only, the one with the first of the others.
        if (which is None or which == i) and used.union(spare[:max_words - len(used)]) == set(halves) and all(
                sum(m for home, m in zip(homes, mask) if home == j) == taken[j] for j in range(max_words)):
            stem = code * len(ways) + i
            ranges = [(cut[halves[j]], cut[halves[j] + 1]) for j in homes]
            for digit in reversed(digits):
                stem = stem * WORD_FINE ** max_words + digit
                at = [digit // WORD_FINE ** (max_words - 1 - j) % WORD_FINE for j in range(max_words)]
                ranges = [(int(c[d]), int(c[d + 1])) for c, d in zip(map(_word_cut, ranges), at)]
            spots.append((stem, mask, tuple(ranges)))
    return spots


def _word_cut(place: tuple[int, int]) -> np.ndarray:
    low, high = place
    parts = min(WORD_FINE, max(1, -(-(high - low) // WORD_LAST)))
    return low + np.arange(parts + 1, dtype=np.int64) * (high - low) // parts


@lru_cache(maxsize=1 << 11)
def _grid(ranges: tuple[tuple[int, int], ...], last: bool) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """(low, high, digit) of the narrower places in ``ranges``, at the ``last`` step of single ones, in ascending order."""
    cuts = [np.arange(a, b + 1) for a, b in ranges] if last else [_word_cut(r) for r in ranges]
    grid = [g.reshape(-1) for g in np.meshgrid(*(np.arange(len(c) if last else len(c) - 1) for c in cuts), indexing="ij")]
    ordered = np.ones(len(grid[0]), bool)
    for j in range(len(ranges) - 1):
        if ranges[j] == ranges[j + 1]:
            ordered &= grid[j] <= grid[j + 1]
    grid = [g[ordered] for g in grid]
    digit = np.zeros(len(grid[0]), np.int64)
    for g in grid:
        digit = digit * WORD_FINE + g
    low = [c[g] for c, g in zip(cuts, grid)]
    return low, low if last else [c[g + 1] for c, g in zip(cuts, grid)], digit


def _word_keys(h: Hashes, words: np.ndarray, first, n, taken: tuple[int, ...], low: list, high: list) -> np.ndarray:
    """Keys of lines without what lies from ``low`` to ``high`` at each place and without the words taken out there.

    A line is ``n`` words from number ``first`` on; places are in words of what is left.
    """
    shift, left = 0, n - sum(taken)
    key = _key(h.of(words[first], words[first + low[0]]), left, 6, 0)
    for j, own in enumerate(taken):
        shift += own
        begin = high[j] + shift
        end = np.maximum(high[j], low[j + 1]) + shift if j + 1 < len(taken) else n
        key = _key(key.view(np.uint64) ^ h.of(words[first + begin], words[first + end]), low[j], 7, high[j])
    return key


def _emit_halves(lines: DataFrame, max_words: int) -> DataFrame:
    """(id, key, code, line, seeks) of ``lines`` (line, id, text, codes, seeks): keys without ``max_words`` halves of parts; the
    code tells which."""
    on_workers(lines.sparkSession)
    wanted = [(halves, taken, _whole_parts(halves, taken, max_words)) for halves, taken in _halves(max_words)]
    n_parts = len(_parts(max_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, texts in text_parts(batch.column(1), PART_CHARS):
                codes = batch.column(2)[own]
                ids, line, seeks = (batch.column(c)[own] for c in (0, 3, 4))
                texts = texts.to_pylist()
                shares = np.zeros((len(texts), n_parts), bool)
                flat = codes.flatten().to_numpy()
                sizes = codes.value_lengths().to_numpy()
                of_words = flat >= CHAR_KEYS
                shares[np.repeat(np.arange(len(texts)), sizes)[of_words], flat[of_words] - CHAR_KEYS] = True
                end = np.cumsum([len(t) + 1 for t in texts]) - 1
                begin = np.append(0, end[:-1] + 1)
                h = Hashes(" ".join(texts) + " ")
                words = h.words()
                first = np.searchsorted(words, begin)
                n = np.searchsorted(words, end) - first
                found = []
                for code, (halves, taken, whole) in enumerate(wanted):
                    at = np.flatnonzero(shares[:, whole].all(axis=1))
                    if len(at):
                        cut = _half_cut(n[at] - sum(taken), max_words)
                        low, high = ([cut[:, half + k] for half in halves] for k in (0, 1))
                        key = _word_keys(h, words, first[at], n[at], taken, low, high)
                        found.append((at, key, np.full(len(at), code, np.int64)))
                if found:
                    at, key, code = (pa.array(np.concatenate(c)) for c in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), key, code, line.take(at), seeks.take(at)], names=PLACED)

    return lines.select("id", "text", "codes", F.struct(*LINE).alias("line"), "seeks").mapInArrow(run, PLACED_TYPES)


def _emit_words(lines: DataFrame, step: int, last: bool, max_words: int, share: float) -> DataFrame:
    """(id, key, code, line, seeks) of ``lines`` as above: keys with narrower places, or at the ``last`` step single ones."""
    on_workers(lines.sparkSession)

    def keys_of(text: str, codes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        h = Hashes(text + " ")
        words = h.words()
        n = len(words) - 1
        for code in codes:
            for stem, mask, ranges in _spots(code, step, n, max_words):
                low, high, digit = _grid(ranges, last)
                if last:
                    size, shift = np.zeros(len(digit), np.int64), 0
                    for place, own in zip(low, mask):
                        if own:
                            size += words[place + shift + 1] - words[place + shift]
                        shift += own
                    low = [x[size <= share * len(text) + 1e-6] for x in low]
                    key = _word_keys(h, words, 0, n, mask, low, low)
                    yield key, np.zeros(len(key), np.int64)
                else:
                    yield _word_keys(h, words, 0, n, mask, low, high), stem * WORD_FINE ** max_words + digit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, ...]] = []
            rows = 0
            for i, (text, codes) in enumerate(zip(batch.column(3), batch.column(4))):
                for key, code in keys_of(text.as_py(), codes.as_py()):
                    found.append((np.full(len(key), i, np.int32), key, code))
                    rows += len(key)
                    if rows >= ROWS_OUT:
                        yield gathered(batch, found)
                        found, rows = [], 0
            if found:
                yield gathered(batch, found)

    def gathered(batch: pa.RecordBatch, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        at, key, code = (pa.array(np.concatenate(c)) for c in zip(*found))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), key, code, *(batch.column(c).take(at) for c in (1, 2))], names=PLACED)

    return lines.select("id", F.struct(*LINE).alias("line"), "seeks", "text", "codes").mapInArrow(run, PLACED_TYPES)


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (line id, key, ...) whose key two lines have, one of which ``seeks``, with the key's number of rows ``n``."""
    seeks = F.max("seeks") if "seeks" in rows.columns else F.lit(True)
    met = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.max("id").alias("most"), seeks.alias("sought")).where(
        "least <> most AND sought")
    return rows.join(met.select("key", "n"), "key")


def _sorted_ranges(firsts: DataFrame, bits: int) -> DataFrame:
    """(bucket, sorted): for each batch of lines a sorted array of its keys in each range, of a key two at most.

    So a key that very many lines share fills no range. Keys are hashes, so ranges of equal width hold about as many.
    """
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).flatten().to_numpy().view(np.uint64)
            key = np.sort(key[key != 0])
            if len(key) > 2:
                key = key[np.append([True, True], key[2:] != key[:-2])]
            at = np.append(np.searchsorted(key, edges), len(key))
            full = np.flatnonzero(np.diff(at))
            ends = np.append(at[full], len(key)).astype(np.int32) * 8
            yield pa.RecordBatch.from_arrays([
                pa.array(full.astype(np.int32)),
                pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(ends), pa.py_buffer(key)])],
                names=["bucket", "sorted"])

    return firsts.select("keys").mapInArrow(deal, "bucket int, sorted binary")


def _found_twice(firsts: DataFrame, keys_a_line: int) -> DataFrame:
    """(key): the keys of ``firsts`` that come more than once, each once; zero is none."""

    def twice(table: pa.Table) -> pa.Table:
        key = np.sort(np.frombuffer(b"".join(table["sorted"].to_pylist()), np.uint64))
        return pa.table({"key": np.unique(key[1:][key[1:] == key[:-1]]).view(np.int64)})

    bits = max(BUCKET_BITS, (firsts.count() * keys_a_line // BUCKET_KEYS).bit_length())
    return _sorted_ranges(firsts, bits).groupBy("bucket").applyInArrow(twice, "key bigint")


def _shared_keys(firsts: DataFrame, keys_a_line: int) -> DataFrame:
    """(id, line, size, key, code) of the keys of ``firsts`` that come more than once."""
    on_workers(firsts.sparkSession)
    met = written(_found_twice(firsts, keys_a_line), "shared-keys")
    bits = min(MAX_BITS, max(CHUNK_BITS, (64 * met.count()).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.sort(batch.column(0).to_numpy())
            chunk = at >> CHUNK_BITS
            for own in np.split(at, np.flatnonzero(np.diff(chunk)) + 1) if len(at) else []:
                chunks.setdefault(int(own[0]) >> CHUNK_BITS, np.zeros(1 << CHUNK_BITS, bool))[own & (1 << CHUNK_BITS) - 1] = True
        for chunk, marked in chunks.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk], pa.int64()), pa.array([np.packbits(marked, bitorder="little").tobytes()])], names=["chunk", "bits"])

    places = met.select(F.shiftrightunsigned("key", 64 - bits).alias("at"))
    table = np.zeros(1 << bits - 3, np.uint8)
    size = 1 << CHUNK_BITS - 3
    # At once: the whole table is ``2 ** MAX_BITS`` bits at most, and an iterator would run a job for each partition.
    for row in places.repartition(F.shiftright("at", CHUNK_BITS)).mapInArrow(mark, "chunk long, bits binary").collect():
        table[row.chunk * size:(row.chunk + 1) * size] = np.frombuffer(row.bits, np.uint8)
    shared = firsts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            size = len(keys.flatten()) // max(1, len(keys))
            key = keys.flatten().to_numpy()
            at = key.view(np.uint64) >> np.uint64(64 - bits)
            found = np.flatnonzero(
                (key != 0) & (shared.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1))
            line = pa.array(found // size if size else found)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(line) for c in own), pa.array(key[found]),
                pa.array((found % size if size else found).astype(np.int32))], names=[*own, "key", "code"])

    own = ["id", *LINE, "size"]
    rows = firsts.select(_id(), *LINE, "size", "keys").mapInArrow(
        run, f"id bigint, {LINE_TYPES}, size int, key bigint, code int")
    return rows.join(met, "key")


def _each_two(rows: DataFrame, which: str) -> DataFrame:
    """(a, b): ids of any two lines x and y that share a key of few lines, for ``which`` this holds; once for each key."""
    few = rows.where(F.col("n") <= PAIR_LINES)
    return few.alias("x").join(few.alias("y"), "key").where(f"x.id < y.id AND ({which})").select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _words(text: str) -> list[str]:
    """The words of ``Hashes.words``, each up to the next one's start."""
    return WORD.findall(text + " ")


def _left(x: list[str], y: list[str], max_words: int) -> int:
    """Most characters that two lines keep when they are made equal by at most ``max_words`` words each; -1 if they can't.

    Equal words at the begin or end always stay: any other choice keeps no more and takes no fewer steps.
    """
    n = min(len(x), len(y))
    i = next((i for i in range(n) if x[i] != y[i]), n)
    j = next((j for j in range(n - i) if x[-1 - j] != y[-1 - j]), n - i)
    kept = sum(map(len, x[:i])) + sum(map(len, x[len(x) - j:]))
    x, y = x[i:len(x) - j], y[i:len(y) - j]
    if not x and not y:
        return kept
    if abs(len(x) - len(y)) > max_words or not max_words:
        return -1
    best = max(_left(x[a:], y[b:], max_words - 1) for a, b in ((0, 1), (1, 0), (1, 1)) if len(x) >= a and len(y) >= b)
    return best + kept if best >= 0 else -1


def _near(pairs: DataFrame, texts: DataFrame, max_words: int, share: float) -> DataFrame:
    """(doc_id, tie, line_no) of the later line of each of ``pairs`` (a, b) that is near, once for each pair."""
    on_workers(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                least = (1 - share) * max(len(x), len(y)) + 1  # the blank after the last word stays
                near.append(min(len(x), len(y)) + 1 >= least - 1e-6 and _left(_words(x), _words(y), max_words) >= least - 1e-6)
            yield batch.select([0, 1, 2]).filter(pa.array(near, pa.bool_()))

    own = texts.select("id", F.struct(*LINE).alias("line"), "text")
    both = pairs.join(own.toDF("a", "x_line", "x"), "a").join(own.toDF("b", "y_line", "y"), "b")
    close = F.least(F.length("x"), F.length("y")) >= (1 - share) * F.greatest(F.length("x"), F.length("y")) - 1
    later = F.greatest("x_line", "y_line").alias("line")
    return both.where(close).select(later, "x", "y").select(
        *(F.col(f"line.{c}").alias(c) for c in LINE), "x", "y").mapInArrow(run, LINE_TYPES)


def _id() -> Column:
    return F.xxhash64(*LINE).alias("id")


def _compared(rows: DataFrame, pending: DataFrame, texts: DataFrame, max_words: int, share: float) -> tuple[DataFrame, ...]:
    """(lines that go, pairs (a, b) left, rows to narrow down) of ``rows`` (id, key, code, line, seeks, n).

    Lines of a key of few are compared each with each. Every line of a key of many that still seeks is compared with the
    earliest one first: copies of a line go at once, however many they are. Those that stay are the key's seekers. Few of
    them meet all earlier lines of the key, which costs no more than ``PAIR_LINES`` times its lines; a key without any is
    done, and only keys of many seekers are narrowed down. ``pending`` pairs are compared too, those left with the next step.
    """
    placed = written(rows.where(F.col("n") > PAIR_LINES), "word-lines")
    firsts = placed.groupBy("key").agg(F.min(F.struct("line", "id")).alias("f")).select("key", F.col("f.id").alias("first"))
    later = written(placed.where("seeks").select("key", "id", "line").distinct().join(firsts, "key").where("id <> first"), "word-later")
    pairs = _each_two(rows, "x.seeks OR y.seeks").union(later.select("first", "id")).union(pending)
    near = written(_near(pairs.distinct(), texts, max_words, share), "near")
    seekers = written(later.drop("first").join(near.select(_id()), "id", "left_anti"), "seekers")
    load = seekers.groupBy("key").agg(F.count(F.lit(1)).alias("k"))
    few = seekers.join(load.where(F.col("k") <= PAIR_LINES).select("key"), "key").select(
        "key", F.col("id").alias("b"), F.col("line").alias("seeker"))
    earlier = placed.select("key", F.col("id").alias("a"), "line").distinct()
    left = earlier.join(few, "key").where("line < seeker").select("a", "b")
    return near, left, placed.join(load.where(F.col("k") > PAIR_LINES).select("key"), "key").select("id", "code")


def _width(lines: DataFrame, step: int, max_words: int) -> int:
    """Words of the widest range of a place in ``lines`` (with text) before a step, or more."""
    marks = F.regexp_replace("text", f"[^{SPACES}\\x{{{NO_BLANKS:x}}}-\\x{{10ffff}}]", "")
    longest = lines.agg(F.max(2 * F.length(marks) + 1)).first()[0]
    width = -(-longest // (2 * max_words + 2))
    for _ in range(step):
        width = -(-width // min(WORD_FINE, -(-width // WORD_LAST)))
    return width


def _seeking(lines: DataFrame, near: DataFrame) -> DataFrame:
    """``lines`` with ``seeks``: false for those in ``near``, which are still compared with."""
    settled = near.select(_id(), F.lit(False).alias("seeks")).distinct()
    return lines.join(settled, "id", "left").withColumn("seeks", F.coalesce("seeks", F.lit(True)))


def _near_by_words(texts: DataFrame, parts: DataFrame, gone: DataFrame, max_words: int, share: float) -> DataFrame:
    """(doc_id, tie, line_no) of the lines that are near an earlier one, some often; ``parts`` (id, size, key, code) are shared.

    ``gone`` (doc_id, tie, line_no) are known to go: they are still compared with, but seek nothing themselves.
    """
    shared = written(_shared(parts), "part-keys")
    pairs = _each_two(shared, f"least(x.size, y.size) >= {1 - share}D * greatest(x.size, y.size) - 1.000001D")
    near = written(_near(pairs.distinct(), texts, max_words, share), "near")
    pending = pairs.limit(0)
    narrow = shared.where(F.col("n") > PAIR_LINES).select("id", "code")
    step = -1
    while True:
        codes = written(narrow.groupBy("id").agg(F.collect_set("code").alias("codes")), "word-codes")
        if codes.isEmpty():
            return near.union(_near(pending.distinct(), texts, max_words, share))
        lines = _seeking(texts.join(codes, "id"), gone.union(near))
        last = step >= 0 and _width(lines, step, max_words) <= WORD_LAST
        keys = written(_emit_words(lines, step, last, max_words, share) if step >= 0 else _emit_halves(lines, max_words), "place-keys")
        if last:
            best = keys.groupBy("key").agg(F.min("line").alias("f"))
            firsts = best.select("key", F.xxhash64(*(F.col(f"f.{c}") for c in LINE)).alias("a"))
            pairs = keys.where("seeks").select("key", F.col("id").alias("b")).join(firsts, "key").where("a <> b").select("a", "b")
            return near.union(_near(pairs.union(pending).distinct(), texts, max_words, share))
        shared = written(_shared(keys), "word-keys")
        found, pending, narrow = _compared(shared, pending, texts, max_words, share)
        near = near.union(found)
        step += 1


def near_lines(docs: DataFrame, firsts: DataFrame, max_words: int = 0, share: float = SHARE) -> DataFrame:
    """(doc_id, tie, line_no) of the lines among ``firsts`` that are one edit from an earlier one, or near it by words.

    A line comes once or more.
    """
    met = written(_shared_keys(firsts, CHAR_KEYS + len(_parts(max_words))), "line-keys")
    codes = met.groupBy("id", *LINE).agg(F.collect_set("code").alias("codes"))
    texts = written(_with_texts(docs, written(codes, "line-codes")), "line-texts")
    by_chars = texts.withColumn("codes", F.filter("codes", lambda c: c < CHAR_KEYS)).where(F.size("codes") > 0)
    near = _one_edit_lines(by_chars.drop("id"))
    if not max_words:
        return near
    near = written(near, "near")
    by_words = texts.where(F.exists("codes", lambda c: c >= CHAR_KEYS)).drop("codes")
    parts = met.where(F.col("code") >= CHAR_KEYS).select("id", "size", "key", "code")
    return near.union(_near_by_words(by_words, parts, near, max_words, share))


def dedup_lines(docs: DataFrame, max_words: int = 0, share: float = SHARE) -> DataFrame:
    """``docs`` with repeated lines cut from ``text``, and ``n_lines`` and ``n_dropped`` (blank lines not counted).

    Lines also go that differ from an earlier one by at most ``max_words`` words and ``share`` of the characters.
    Null texts stay null. Empty texts stay empty. Rows with the same id and text count as one document, so they
    come out alike; extra columns pass through, and columns named like the two counts are replaced. An empty table
    gives no rows.
    """
    firsts = written(first_lines(docs, max_words), "first-lines")
    near = near_lines(docs, firsts, max_words, share)
    # Keys without nulls, so that the lists are dealt out once and meet the documents where they are.
    key = [F.coalesce("doc_id", F.lit(0)).alias("own_id"), F.isnull("doc_id").alias("no_id"), "tie"]
    marked = firsts.select(*key, "line_no", F.lit(False).alias("goes")).union(near.select(*key, "line_no", F.lit(True)))
    kept = marked.groupBy("own_id", "no_id", "tie").agg(F.array_except(
        F.collect_list(F.when(~F.col("goes"), F.col("line_no"))),
        F.collect_set(F.when(F.col("goes"), F.col("line_no")))).alias("kept"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    whole = docs.select(  # a row as a struct, so its columns can have any names
        F.struct(*names).alias("row"), *key[:2], F.xxhash64(text_or_empty()).alias("tie"))
    joined = whole.join(kept.hint("shuffle_hash"), ["own_id", "no_id", "tie"], "left")
    split = joined.withColumn("own", F.split(F.coalesce("row.text", F.lit("")), "\n")).withColumn(
        "blank", F.filter(F.transform("own", lambda x, i: F.when(
            F.octet_length(F.btrim(x, F.lit(SPACES))) == 0, i).otherwise(-1)), lambda i: i >= 0))
    stay = F.array_sort(F.concat("blank", F.coalesce("kept", F.array().cast("array<int>"))))
    n_lines = F.size("own") - F.size("blank")
    cut = n_lines - F.coalesce(F.size("kept"), F.lit(0))
    text = F.when(cut == 0, F.col("row.text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("own", i)), "\n"))
    return split.select(
        *(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names),
        n_lines.cast("long").alias("n_lines"), cut.cast("long").alias("n_dropped"))
