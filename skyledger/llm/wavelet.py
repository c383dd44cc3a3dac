"""Token ids as wavelet matrices, one per shard.

A shard holds the ids of consecutive documents. Its ids are stored bit by bit, highest bit first: a level is a plane of
one bit per id, and the ids are then stably parted into zeros and ones before the next level. With a count of ones
before every block of bits, a plane answers rank and select, and so the shard answers access, counting and occurrence
queries without being unpacked. A shard is one row of a Parquet folder: plane bytes, block counts and the documents'
lengths, compressed by the file format.
"""

from __future__ import annotations

import codecs
import os
from array import array
from collections.abc import Collection, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.bpe import byte_letters
from skyledger.llm.common import on_workers, text_or_empty, text_parts
from skyledger.session import scratch_dir

# Ids of one shard at most, but for a single longer document.
SHARD_IDS = 1 << 20
# Starts of shards, some 16 bytes each, are broadcast up to this number.
BROADCAST_SHARDS = 1_000_000
MIN_RANGES = 8
# Bits of a rank block.
BLOCK = 512
# Texts coded together, but for a single longer one; a chunk is looked up once for all of them.
PART_BYTES = 16 << 20
# Entries of a worker's table of text pieces before it is emptied; bounds memory, not results.
CACHE_ENTRIES = 800_000


class WaveletMatrix:
    """Rank, select and access over a sequence of unsigned integers."""

    def __init__(self, length: int, bits: int, zeros: np.ndarray, planes: np.ndarray, blocks: np.ndarray):
        self.length, self.bits, self.zeros, self.planes, self.blocks = length, bits, zeros, planes, blocks

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        n = len(values)
        width = -(-n // BLOCK) * (BLOCK // 8)
        planes = np.zeros((bits, width), np.uint8)
        zeros = np.zeros(bits, np.int64)
        for level in range(bits):
            ones = (values & (1 << (bits - 1 - level))) != 0
            packed = np.packbits(ones, bitorder="little")
            planes[level, :len(packed)] = packed
            set_at, clear_at = np.flatnonzero(ones), np.flatnonzero(~ones)
            zeros[level] = len(clear_at)
            parted = np.empty_like(values)
            values.take(clear_at, out=parted[:len(clear_at)], mode="clip")
            values.take(set_at, out=parted[len(clear_at):], mode="clip")
            values = parted
        return cls(n, bits, zeros, planes, cls._count(planes))

    @staticmethod
    def _count(planes: np.ndarray) -> np.ndarray:
        """Ones before each block of each plane, and in all of it at the end."""
        per = np.bitwise_count(planes.view(np.uint64)).reshape(planes.shape[0], -1, BLOCK // 64).sum(2, dtype=np.uint32)
        return np.concatenate([np.zeros((planes.shape[0], 1), np.uint32), np.cumsum(per, 1, dtype=np.uint32)], 1)

    def to_bytes(self) -> bytes:
        head = np.array([self.length, self.bits], np.int64).tobytes()
        return head + self.zeros.tobytes() + self.blocks.tobytes() + self.planes.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        n, bits = (int(x) for x in np.frombuffer(data, np.int64, 2))
        n_blocks = -(-n // BLOCK)
        at = 16
        zeros = np.frombuffer(data, np.int64, bits, at)
        at += 8 * bits
        blocks = np.frombuffer(data, np.uint32, bits * (n_blocks + 1), at).reshape(bits, -1)
        at += 4 * bits * (n_blocks + 1)
        planes = np.frombuffer(data, np.uint8, bits * n_blocks * (BLOCK // 8), at).reshape(bits, -1)
        return cls(n, bits, zeros, planes, blocks)

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i``."""
        block, rest = divmod(i, BLOCK)
        begin = block * (BLOCK // 8)
        bytes_ = self.planes[level, begin:begin + rest // 8]
        n = int(self.blocks[level, block]) + int(np.bitwise_count(bytes_).sum())
        if rest % 8:
            n += (int(self.planes[level, begin + rest // 8]) & ((1 << rest % 8) - 1)).bit_count()
        return n

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3]) >> (i & 7) & 1

    def access(self, i: int) -> int:
        """The value at position ``i``."""
        if not 0 <= i < self.length:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = int(self.zeros[level]) + ones if bit else i - ones
        return value

    def _range(self, value: int, begin: int, end: int) -> tuple[int, int]:
        for level in range(self.bits):
            a, b = self._ones(level, begin), self._ones(level, end)
            if value >> (self.bits - 1 - level) & 1:
                begin, end = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def count(self, value: int, begin: int = 0, end: int | None = None) -> int:
        """How often ``value`` occurs in positions ``begin`` to ``end``, exclusive."""
        if value < 0 or value >> self.bits:
            return 0
        a, b = self._range(value, begin, self.length if end is None else end)
        return b - a

    def select(self, value: int, k: int) -> int:
        """Position of the ``k``-th occurrence of ``value``, counted from 0."""
        if value < 0 or value >> self.bits or k < 0:
            raise IndexError(k)
        a, b = self._range(value, 0, self.length)
        if k >= b - a:
            raise IndexError(k)
        at = a + k
        for level in reversed(range(self.bits)):
            zeros = int(self.zeros[level])
            at = self._nth(level, at - zeros, 1) if value >> (self.bits - 1 - level) & 1 else self._nth(level, at, 0)
        return at

    def _nth(self, level: int, k: int, bit: int) -> int:
        """Position of the ``k``-th set (or unset) bit of a plane: a search over the blocks, then within one."""
        before = self.blocks[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        begin = block * (BLOCK // 8)
        bits = np.unpackbits(self.planes[level, begin:begin + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def values(self) -> np.ndarray:
        """The whole sequence, undoing the partings from the last level up."""
        out = np.zeros(self.length, np.uint16 if self.bits <= 16 else np.uint32)
        for level in reversed(range(self.bits)):
            ones = np.unpackbits(self.planes[level], count=self.length, bitorder="little").view(bool)
            zeros = int(self.zeros[level])
            above = np.empty_like(out)
            above[np.flatnonzero(~ones)] = out[:zeros]
            above[np.flatnonzero(ones)] = out[zeros:] | (1 << (self.bits - 1 - level))
            out = above
        return out


class TokenMatrix:
    """A wavelet matrix over token ids, with the ids numbered by falling frequency first.

    Frequent ids get small numbers, so there are fewer planes and the upper ones are nearly empty and compress well.
    """

    def __init__(self, tokens: np.ndarray, matrix: WaveletMatrix):
        self.tokens, self.matrix = tokens, matrix

    @classmethod
    def build(cls, ids: np.ndarray) -> TokenMatrix:
        counts = np.bincount(ids, minlength=1)
        used = np.flatnonzero(counts)
        tokens = used[np.argsort(-counts[used], kind="stable")].astype(np.uint32)
        number = np.zeros(len(counts), ids.dtype)
        number[tokens] = np.arange(len(tokens), dtype=ids.dtype)
        return cls(tokens, WaveletMatrix.build(number.take(ids), max(1, (len(tokens) - 1).bit_length())))

    def to_bytes(self) -> bytes:
        return np.array([len(self.tokens)], np.int64).tobytes() + self.tokens.tobytes() + self.matrix.to_bytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> TokenMatrix:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        return cls(np.frombuffer(data, np.uint32, n, 8), WaveletMatrix.from_bytes(data[8 + 4 * n:]))

    def _number(self, token: int) -> int:
        found = np.flatnonzero(self.tokens == token)
        return int(found[0]) if len(found) else -1

    def access(self, i: int) -> int:
        return int(self.tokens[self.matrix.access(i)])

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        return self.matrix.count(self._number(token), begin, end)

    def select(self, token: int, k: int) -> int:
        return self.matrix.select(self._number(token), k)

    def values(self) -> np.ndarray:
        return self.tokens.take(self.matrix.values())


# Fixed value: the word pattern of the byte-level pre-tokenizer.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Control characters and blanks on which pattern engines disagree.
_ODD = regex.compile("[\x1c-\x1f\x85\xa0]")


# Stands for a chunk that begins or ends with white space.
BLANKS_MEET = ""
# Stands between the chunks of a part; before a blank it is a word of its own.
BETWEEN = "\x0b"
# Words that the model codes in one call.
GROUP = 64
# Letters below this code point are classed alike by Python and by the library.
LATIN_END = "\u0250"
# A chunk of these alone is one word, and needs no cutting.
LETTERS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+$"


class _Coder:
    """The library's tokenizer behind tables of text already coded.

    Its pre-tokenizer cuts before every blank that a word follows, so a blank and the characters up to the next blank
    (a chunk) are coded by themselves, whatever stands around them, unless white space meets white space there. Texts
    with such a place are coded as a whole. Chunks of Latin letters are cut into words by the same pattern, all of
    a part together, and the library's model codes each distinct word once; other chunks go through the whole library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.uint16 if size < 1 << 16 else np.uint32
        self.code = "H" if self.kind is np.uint16 else "I"
        self.model = self.library.model
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        blank = byte_letters()[32]
        byte_of = {c: b for b, c in enumerate(byte_letters())}

        def after_letter(token: str) -> bool:
            text = bytes(byte_of[c] for c in token).decode(errors="replace")
            return any(b == " " and (a.isalpha() or a == "\ufffd") for a, b in zip(text, text[1:]))

        self.joinable = not any(after_letter(t) for t in vocabulary if blank in t[1:])
        self.starts = np.zeros(size, bool)
        for t, i in vocabulary.items():
            self.starts[i] = t.startswith(blank)
        self.alphabet = "".join(byte_letters())
        self.chunks: dict[str, bytes | str] = {}
        self.words: dict[str, bytes] = {}
        self.no_id = np.iinfo(self.kind).max
        # Empty, white space at an end, characters that engines class differently, added tokens: not cut by the pattern here.
        self.odd = "|".join([r"^$|^[\t-\r]|[\t-\r]$|[\x0b\x1c-\x1f\x{85}\x{a0}]", rf"[^\x00-\x{{{ord(LATIN_END) - 1:x}}}]",
                             *map(regex.escape, self.specials)])

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _letters(self, text: str) -> str:
        return codecs.charmap_decode(text.encode(), "strict", self.alphabet)[0]

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            got = self.words[word] = array(self.code, [t.id for t in self.model.tokenize(self._letters(word))]).tobytes()
        return got

    def _cut(self, text: str) -> bytes:
        """Ids of a chunk, or of a text's beginning up to its first blank."""
        if not text:
            return b""
        if max(text) >= LATIN_END or _ODD.search(text) or any(s in text for s in self.specials):
            return self._whole(text)
        return b"".join([self._word(w) for w in _PIECES.findall(text)])

    def _learn(self, distinct: Collection[str]) -> None:
        """Has all of these words in the table, emptied first where they would not fit beside the others."""
        new = [w for w in distinct if w not in self.words]
        if len(self.words) + len(new) > CACHE_ENTRIES:
            self.words.clear()
            new = list(distinct)
        self._add(new)

    def _add(self, new: list[str]) -> None:
        """Adds words to the table. Most are a blank and letters; these are coded in groups.

        Where no token holds a blank behind a letter, such words do not merge with the one before, and each begins with a
        token that begins with a blank.
        """
        words = [w for w in new if w[0] == " " and w[1:].isalpha()] if self.joinable else []
        for word in set(new).difference(words) if len(words) < len(new) else ():
            self._word(word)
        ids = array(self.code)
        for i in range(0, len(words), GROUP):
            ids.extend([t.id for t in self.model.tokenize(self._letters("".join(words[i:i + GROUP])))])
        at = (ids.itemsize * np.flatnonzero(self.starts[np.frombuffer(ids, self.kind)])).tolist() if words else []
        raw = ids.tobytes()
        self.words.update(zip(words, [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)])]))

    def _plain(self, chunks: list[str]) -> pa.ListArray:
        """Ids of chunks that the pattern cuts, each with the blank before it."""
        words = _PIECES.findall(" " + f"{BETWEEN} ".join(chunks)) if chunks else []
        self._learn(set(words) - {BETWEEN})
        self.words[BETWEEN] = np.array([self.no_id], self.kind).tobytes()
        ids = np.frombuffer(b"".join(map(self.words.__getitem__, words)), self.kind)
        ends = np.append(np.flatnonzero(ids == self.no_id), len(ids))[:len(chunks)]
        ends -= np.arange(len(ends))
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids[ids != self.no_id]))

    def _single(self, chunks: list[str]) -> pa.ListArray:
        """Ids of distinct chunks of letters, each one word with the blank before it."""
        words = [" " + c for c in chunks]
        self._learn(words)
        ids = [self.words[w] for w in words]
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // self.kind().itemsize
        return pa.ListArray.from_arrays(
            pa.array(np.append(0, ends).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), self.kind)))

    def _other(self, chunk: str) -> bytes | str:
        """Ids of a chunk with the blank before it, or ``BLANKS_MEET``."""
        got = self.chunks.get(chunk)
        if got is None:
            if len(self.chunks) >= CACHE_ENTRIES:
                self.chunks.clear()
            bad = not chunk or chunk[0].isspace() or chunk[-1].isspace()
            got = self.chunks[chunk] = BLANKS_MEET if bad else self._cut(" " + chunk)
        return got

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, as bytes of ``kind``."""
        split = pc.split_pattern(texts, " ")
        begin = split.offsets.to_numpy() - split.offsets[0].as_py()
        behind = np.ones(begin[-1], bool)
        behind[begin[:-1]] = False
        flat = split.flatten()
        firsts = flat.filter(pa.array(~behind)).to_pylist()
        chunks = flat.filter(pa.array(behind)).dictionary_encode()
        begin -= np.arange(len(begin), dtype=np.int32)

        odd = pc.match_substring_regex(chunks.dictionary, self.odd)
        single = pc.and_not(pc.match_substring_regex(chunks.dictionary, LETTERS), odd)
        plain = pc.invert(pc.or_(odd, single))
        others = [self._other(c) for c in chunks.dictionary.filter(odd).to_pylist()]
        size = self.kind().itemsize
        other_ends = np.cumsum([0, *(len(c) // size for c in others)], dtype=np.int32)
        other_ids = np.frombuffer(b"".join([c for c in others if c is not BLANKS_MEET]), self.kind)
        lists = pa.concat_arrays([
            self._single(chunks.dictionary.filter(single).to_pylist()),
            self._plain(chunks.dictionary.filter(plain).to_pylist()),
            pa.ListArray.from_arrays(pa.array(other_ends), pa.array(other_ids))])
        single, plain, odd = (np.flatnonzero(x.to_numpy(zero_copy_only=False)) for x in (single, plain, odd))
        # The few distinct lists are put in the dictionary's order, so that the many places need no numbers of their own.
        place = np.empty(len(lists), np.int32)
        place[np.concatenate([single, plain, odd])] = np.arange(len(lists), dtype=np.int32)
        meet = odd[[c is BLANKS_MEET for c in others]] if others else []
        whole = set()
        if len(meet):
            found = np.flatnonzero(np.isin(chunks.indices.to_numpy(), meet))
            whole = set((np.searchsorted(begin, found, side="right") - 1).tolist())
        coded = lists.take(pa.array(place)).take(chunks.indices)
        raw = memoryview(coded.values.to_numpy()).cast("B") if len(coded) else b""
        upto = (size * coded.offsets.to_numpy().astype(np.int64)[begin]).tolist()
        result = []
        for i, (first, n, a, b) in enumerate(zip(firsts, np.diff(begin).tolist(), upto, upto[1:])):
            if i in whole or n and first[-1:].isspace():
                result.append(self._whole(texts[i].as_py()))
            else:
                result.append(b"".join((self._cut(first), raw[a:b])))
        return result

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text]))[0]


@lru_cache(maxsize=2)
def _coder(path: str) -> _Coder:
    return _Coder(path)


def write_shards(docs: DataFrame, path: str, end_id: int, folder: str | None = None) -> str:
    """Writes the ids of ``docs`` (doc_id, text) in ascending doc_id order, each document ended by ``end_id``.

    Returns the folder. Rows: part, seq (the order of the shards), doc_ids, lengths, n_ids, matrix. Null ids come
    first; rows of one id follow in the order of their texts' hashes; null texts hold the end id alone. An empty
    table writes an empty folder. A task holds one shard, and a text that is longer than a shard makes its own.
    """
    spark = docs.sparkSession
    on_workers(spark)
    folder = folder or scratch_dir(spark, "tokens")
    text = docs.select("doc_id", text_or_empty().alias("text"))
    # As many ranges as the input has splits; a task cuts its range into shards, so their size does not depend on it.
    ranges = text.withColumn("tie", F.xxhash64("text")).repartitionByRange(
        max(MIN_RANGES, text.rdd.getNumPartitions()), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        end = np.array([end_id], coder.kind).tobytes()
        ids: list[int | None] = []
        coded: list[bytes] = []
        size = seq = 0

        def shard() -> pa.RecordBatch:
            values = np.frombuffer(b"".join(coded), coder.kind)
            matrix = TokenMatrix.build(values).to_bytes()
            lengths = [len(c) // values.itemsize for c in coded]
            return pa.RecordBatch.from_arrays([
                pa.array([seq], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())), pa.array([len(values)], pa.int64()),
                pa.array([matrix], pa.binary())], names=["seq", "doc_ids", "lengths", "n_ids", "matrix"])

        for batch in batches:
            for doc_ids, texts in text_parts(batch.column(1), PART_BYTES, batch.column(0)):
                for doc_id, own in zip(doc_ids.to_pylist(), coder.encode_all(texts)):
                    own += end
                    if coded and (size + len(own)) // len(end) > SHARD_IDS:
                        yield shard()
                        ids, coded, size, seq = [], [], 0, seq + 1
                    ids.append(doc_id)
                    coded.append(own)
                    size += len(own)
        if coded:
            yield shard()

    shards = ranges.mapInArrow(
        run, "seq int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, matrix binary")
    shards.select(F.spark_partition_id().alias("part"), "*").write.option("compression", "zstd").parquet(folder)
    return folder


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(
        "part int, seq int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, matrix binary").parquet(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_ids, ids): ids as little-endian unsigned 32-bit integers; start counts all ids before.

    The shards' own starts come from one row per shard.
    """
    on_workers(spark)
    shards = read_shards(spark, folder)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq, doc_ids, lengths, matrix = (c[i] for c in batch.columns)
                values = TokenMatrix.from_bytes(matrix.as_py()).values().astype("<u4")
                ends = np.concatenate([[0], np.cumsum(lengths.values.to_numpy())])
                n = len(ends) - 1
                flat = pa.Array.from_buffers(
                    pa.binary(), n, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(values)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()),
                    doc_ids.values, pa.array(ends[:-1], pa.int64()), pa.array(np.diff(ends), pa.int64()), flat],
                    names=["part", "seq", "doc_id", "offset", "n_ids", "ids"])

    rows = shards.select("part", "seq", "doc_ids", "lengths", "matrix").mapInArrow(
        run, "part int, seq int, doc_id bigint, offset bigint, n_ids bigint, ids binary")
    few = shards.count() <= BROADCAST_SHARDS
    return rows.join(F.broadcast(starts) if few else starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_ids", "ids")


def find(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(part, seq, n, first): how often a token occurs in each shard, and where first, from the planes alone."""
    on_workers(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, matrix in zip(*(c.to_pylist() for c in batch.columns)):
                m = TokenMatrix.from_bytes(matrix)
                n = m.count(token)
                yield pa.RecordBatch.from_pylist([
                    {"part": part, "seq": seq, "n": n, "first": m.select(token, 0) if n else None}],
                    pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int64()), ("first", pa.int64())]))

    return read_shards(spark, folder).select("part", "seq", "matrix").mapInArrow(
        run, "part int, seq int, n bigint, first bigint")
