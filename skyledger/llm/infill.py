"""Fill-in-the-middle transformation: a text is cut at two unit boundaries and its parts are put into another order.

A unit is a word with the blanks before it, or the blanks at the end of a text. A text lies in blocks of a fixed number
of bytes. A Fenwick tree over the blocks holds how many units end and how many code points begin in each; a descent by
halving steps finds the block in which a cut lies and all that is before it, and only that block is searched for the
boundary. All of it works on the text's bytes, so a text is never split into strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import on_workers, text_or_empty, text_parts

SEED = 42
# Of a hundred texts so many are cut; of a hundred that are cut so many begin with their suffix.
RATE, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Bytes of a block of text.
BLOCK = 1024
# Bytes of text that a task marks and puts out at once, or one text if that is longer.
PART_BYTES = 8 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

FORMS = ("plain", "psm", "spm")


class Blocks:
    """Units and code points of some texts that lie one behind the other in ``data``, in blocks."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, block: int = BLOCK):
        blank = _BLANK[data]
        last = np.ones(len(data), bool)
        last[:-1] = blank[1:]
        last[ends[ends > begins] - 1] = True
        # A word ends before a blank or at the end of its text; blanks at the end of a text are a unit too.
        self.unit_ends = last & ~blank
        full = ends[ends > begins]
        self.unit_ends[full - 1] = True
        self.points = (data & 0xC0) != 0x80
        self.block = block
        self.begins = begins
        self.n_blocks = -(-(ends - begins) // block)
        self.first = np.concatenate([[0], np.cumsum(self.n_blocks)])
        starts = np.repeat(begins - self.first[:-1] * block, self.n_blocks) + np.arange(self.first[-1]) * block
        self.stops = np.minimum(starts + block, np.repeat(ends, self.n_blocks))
        self.starts = starts
        self.unit_counts = self._sums(self.unit_ends)
        self.point_counts = self._sums(self.points)
        total = np.concatenate([[0], np.cumsum(self.unit_counts)])
        self.n_units = total[self.first[1:]] - total[self.first[:-1]]

    def _sums(self, marks: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.int64)
        return np.add.reduceat(marks.astype(np.int64), self.starts)

    def tree(self, text: int) -> Fenwick:
        own = slice(self.first[text], self.first[text + 1])
        return Fenwick(self.unit_counts[own], self.point_counts[own])

    def cut(self, text: int, tree: Fenwick, units: int) -> tuple[int, int]:
        """Byte at which the first ``units`` units of a text end, and the code points before it."""
        if units <= 0:
            return int(self.begins[text]), 0
        block, left, points = tree.descend(units)
        start, stop = self.starts[self.first[text] + block], self.stops[self.first[text] + block]
        at = int(start + np.flatnonzero(self.unit_ends[start:stop])[left - 1] + 1)
        return at, points + int(np.count_nonzero(self.points[start:at]))


class Fenwick:
    """Two counts per block, in one tree each; node i holds the sum of the last i & -i blocks up to block i."""

    def __init__(self, units: np.ndarray, points: np.ndarray):
        node = np.arange(len(units) + 1)
        before = node - (node & -node)
        self.size = len(units)
        self.units, self.points = (
            (total := np.concatenate([[0], np.cumsum(counts)])) - total[before] for counts in (units, points))

    def descend(self, units: int) -> tuple[int, int, int]:
        """The block in which unit number ``units`` ends, its number within the block, and the points before the block."""
        at, points = 0, 0
        step = 1 << self.size.bit_length()
        while step:
            if at + step <= self.size and self.units[at + step] < units:
                at += step
                units -= int(self.units[at])
                points += int(self.points[at])
            step >>= 1
        return at, units, points


def _arrange(texts: pa.Array, draws: np.ndarray, forms: np.ndarray) -> list[pa.Array]:
    """Units, code points of prefix and middle (null where plain) and the output of each text of a large-string array."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    ends = offsets - offsets[0]
    blocks = Blocks(data, ends[:-1], ends[1:])
    raw = data.tobytes()
    prefix, middle = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out = []
    for i, form in enumerate(forms):
        begin, end = int(ends[i]), int(ends[i + 1])
        if not form:
            out.append(raw[begin:end])
            continue
        low, high = sorted(int(h) % (int(blocks.n_units[i]) + 1) for h in draws[i])
        tree = blocks.tree(i)
        (first, prefix[i]), (second, points) = blocks.cut(i, tree, low), blocks.cut(i, tree, high)
        middle[i] = points - prefix[i]
        a, b, c = raw[begin:first], raw[first:second], raw[second:end]
        out.append(b"".join((p, a, s, c, m, b) if FORMS[form] == "psm" else (s, c, p, a, m, b)))
    plain = forms == 0
    return [
        pa.array(blocks.n_units, pa.int64()), pa.array(prefix, mask=plain), pa.array(middle, mask=plain),
        pa.array(out, pa.binary()).cast(pa.string())]


def _draw(seed: int) -> list[Column]:
    """Four numbers of 32 bits from a checksum of the seed and the id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs`` (doc_id, text).

    Null and empty texts, and those that hold one of the three marks, stay plain. Rows with the same id draw the same
    numbers; rows with a null id draw as for an empty id. Repeated rows come out as often as they go in, an empty table
    gives no rows, and other columns are not read.
    """
    on_workers(docs.sparkSession)
    text = text_or_empty()
    h1, h2, h3, h4 = _draw(seed)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (h3 % 100 >= rate), F.lit(0)).when(
        h4 % 100 < suffix_first, F.lit(2)).otherwise(F.lit(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = np.stack([batch.column(i).to_numpy() for i in (2, 3)], 1)
            forms = batch.column(4).to_numpy()
            for own, texts in text_parts(batch.column(1), PART_BYTES):
                n, prefix, middle, output = _arrange(texts, draws[own], forms[own])
                names = pa.array([FORMS[f] for f in forms[own]], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[own], n, names, prefix, middle, output],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select("doc_id", text.alias("text"), h1.alias("h1"), h2.alias("h2"), form.alias("form")).mapInArrow(
        run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(form: Column, output: Column) -> Column:
    """The text from which ``transform`` made an output. A text that was cut holds no mark, so marks are the seams."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return F.when(form == "psm", F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2))).when(
        form == "spm", F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1))).otherwise(output)
