"""Exact byte-pair encoding by backtracking, and decoding by an offset table.

The encoder does not replay merges. An Aho-Corasick automaton finds the longest token that begins at each place; a
token is accepted if it may stand behind the one before it, which a table of compatible pairs says; else a shorter
token is tried, and where none fits the encoder steps back and marks the place as dead. Every place dies once at
most, so the time is linear in the text. Two tokens are compatible if merging their joined text gives just these
two; adjacent compatible tokens everywhere mean that the whole sequence is what the merge rules produce.

Documents are coded in parts of an Arrow batch. The words of a part that the table does not hold yet are coded side by
side: each round of array operations takes one step, forward or back, in all of them.
"""

from __future__ import annotations

import codecs
import itertools
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import give_back_memory, on_workers

# Entries of a task's tables before they are emptied; bounds memory, not results.
PAIR_ENTRIES = 300_000
WORD_ENTRIES = 250_000
# Places of the table of pairs, as bits; a pair takes the place of another one that has the same.
PAIR_BITS = 20
# Longer words are coded one by one.
LONG_WORD = 64
# Texts are taken from an Arrow batch in parts of about this many characters.
PART_CHARS = 1 << 20

_WORD_END = "\n"  # no byte is written as this character
# White space as the tokenizer sees it: without the four control characters that Python counts in.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CONTROL_SPACE = regex.compile("[\x1c-\x1f]")  # white space for str.split, but not for the tokenizer
_CHUNKS = regex.compile(f"[^{_SPACE}]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next one from U+0100."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = [""] * 256
    for b in kept:
        letters[b] = chr(b)
    for i, b in enumerate(b for b in range(256) if b not in set(kept)):
        letters[b] = chr(256 + i)
    return letters


class WordBpe:
    """A tokenizer file with word ends: normaliser, word pattern, vocabulary, merges, added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern["pattern"]["Regex"].replace("\\s", _SPACE))
        self.ended_words = regex.compile(f"{self.words.pattern}|{_WORD_END}")
        self.letters = byte_letters()
        self.alphabet = "".join(self.letters)
        self.ended_alphabet = self.alphabet.replace(self.letters[ord(_WORD_END)], _WORD_END)

        # Text of each token, a word end as one character. Merged tokens are put together from their parts, so
        # a literal that looks like the suffix is not taken for one.
        text: dict[int, str] = {vocab[c]: c for c in self.letters}
        text |= {vocab[c + suffix]: c + _WORD_END for c in self.letters}
        size = max(*vocab.values(), *self.specials.values()) + 1
        self.rank = [-1] * size
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            token, a, b = vocab[a + b], vocab[a], vocab[b]
            text[token] = text[a] + text[b]
            self.rank[token], self.left[token], self.right[token] = rank, a, b
            self.merged[a * size + b] = token
        self.size = size
        self.length = [0] * size
        ids = {t: i for i, t in text.items()}
        self.shorter = [-1] * size
        self.automaton = ahocorasick.Automaton()
        for t, i in ids.items():
            self.automaton.add_word(t, i)
            self.length[i] = len(t)
            self.shorter[i] = next((ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ids), -1)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << PAIR_BITS, bool)
        self.lengths, self.shorters = np.array(self.length, np.int64), np.array(self.shorter, np.int64)
        self.closing = np.zeros(size, bool)
        self.closing[[i for i, t in text.items() if t.endswith(_WORD_END)]] = True

        names = {i: t.encode() for t, i in vocab.items()} | {i: t.encode() for t, i in self.specials.items()}
        ordered = [names.get(i, b"") for i in range(size)]
        self.blob = b"".join(ordered)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ordered])])
        self.offsets = offsets.tolist()
        self.names = pa.Array.from_buffers(
            pa.string(), size, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.blob)])

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merge rules leave the border between two tokens standing.

        Undo the later of the two tokens' last merges, again and again, and look at the parts that meet at the border:
        had they a merge of their own that comes before the undone one, it would have been made. On equal ranks the
        pair further left goes first.
        """
        merged, rank, size = self.merged, self.rank, self.size
        # The border's own merge must come before ``limit``; ``late`` allows the same rank too.
        limit, late = len(rank) + 1, False
        while True:
            token = merged.get(a * size + b)
            if token is not None and (rank[token] < limit or late and rank[token] == limit):
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:  # the last merge was within a, so the border saw a's right part until then
                limit, late = rank[a], False
                a = self.right[a]
            else:
                limit, late = rank[b], True
                b = self.left[b]

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word, given in byte letters without its end."""
        s = word + _WORD_END
        n = len(s)
        length, shorter, pairs, size = self.length, self.shorter, self.pairs, self.size
        longest = [-1] * (n + 1)
        for end, token in self.automaton.iter(s):
            longest[end + 1 - length[token]] = token
        alive = [True] * (n + 1)
        alive[n - 1] = False  # a word end belongs to the byte before it
        tokens: list[int] = []
        at, token = 0, longest[0]
        while token >= 0:
            last = tokens[-1] if tokens else -1
            while True:
                end = at + length[token]
                if alive[end]:
                    if last < 0:
                        break
                    key = last * size + token
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= PAIR_ENTRIES:
                            pairs.clear()
                        fits = pairs[key] = self.compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
                if token < 0:
                    break
            if token >= 0:
                tokens.append(token)
                at = end
                token = longest[at]
            else:
                alive[at] = False
                token = tokens.pop()
                at -= length[token]
        return tokens

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` for arrays of tokens."""
        key = a * self.size + b
        at = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        fits = self.pair_fits[at]
        new = np.flatnonzero(self.pair_keys[at] != key)
        if len(new):
            fresh, first, which = np.unique(key[new], return_index=True, return_inverse=True)
            found = np.array([self.compatible(*divmod(k, self.size)) for k in fresh.tolist()], bool)
            fits[new] = found[which]
            place, own = np.unique(at[new[first]], return_index=True)
            self.pair_keys[place], self.pair_fits[place] = fresh[own], found[own]
        return fits

    def encode_words(self, words: list[str]) -> Iterator[bytes]:
        """Tokens of each word, as bytes of 32-bit integers: ``encode_word`` for all of them at once."""
        s = codecs.charmap_decode((_WORD_END.join(words) + _WORD_END).encode(), "strict", self.ended_alphabet)[0]
        n = len(s)
        found = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(s)), np.int32).reshape(-1, 2)
        longest = np.full(n + 1, -1, np.int64)
        longest[found[:, 0] + 1 - self.lengths[found[:, 1]]] = found[:, 1]  # of one place, the last is the longest
        ends = np.flatnonzero(np.frombuffer(s.encode("utf-32-le"), np.uint32) == ord(_WORD_END))
        alive = np.ones(n + 1, bool)
        alive[ends] = False  # a word end belongs to the byte before it
        chosen = np.full(n + 1, -1, np.int64)
        stands = np.zeros(n, bool)  # whether the token chosen at a place is one of the result so far
        before = np.full(n + 1, -1, np.int64)  # where the token begins that ends at a place
        at = np.append(0, ends[:-1] + 1)
        token, last = longest[at], np.full(len(at), -1, np.int64)
        while len(at):
            end = at + self.lengths[token]
            fits = alive[end]
            pair = np.flatnonzero(fits & (last >= 0))
            fits[pair] = self._fit(last[pair], token[pair])
            go, no = np.flatnonzero(fits), np.flatnonzero(~fits)

            here, end, own = at[go], end[go], token[go]
            chosen[here], stands[here] = own, True
            more = ~self.closing[own]
            here, end, own = here[more], end[more], own[more]
            before[end] = here

            back, tried, prior = at[no], self.shorters[token[no]], last[no]
            none = np.flatnonzero(tried < 0)
            if len(none):
                alive[back[none]] = False
                place = before[back[none]]
                stands[place] = False
                back[none], tried[none] = place, chosen[place]
                prior[none] = np.where(before[place] >= 0, chosen[before[place]], -1)
            at, token, last = np.append(end, back), np.append(longest[end], tried), np.append(own, prior)
        places = np.flatnonzero(stands)
        raw = chosen[places].astype(np.int32).tobytes()
        upto = (4 * np.searchsorted(places, ends)).tolist()
        return (raw[a:b] for a, b in zip([0, *upto], upto))

    def encode_chunk(self, chunk: str) -> list[int]:
        """Tokens of a text without white space."""
        if self.special_split and "<|" in chunk:
            parts = self.special_split.split(chunk)
            if len(parts) > 1:
                return [t for i, p in enumerate(parts) for t in ([self.specials[p]] if i % 2 else self.encode_chunk(p))]
        return [t for word in self.words.findall(lowered(chunk)) for t in self.encode_word(
            codecs.charmap_decode(word.encode(), "strict", self.alphabet)[0])]

    def encode(self, text: str) -> list[int]:
        return [t for c in chunks_of(text) for t in self.encode_chunk(c)]

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by blanks, each one a slice of the offset table."""
        blob, at = self.blob, self.offsets
        return b" ".join([blob[at[i]:at[i + 1]] for i in ids]).decode()


def lowered(chunk: str) -> str:
    """What the tokenizer's normaliser makes of a text without blanks, or of such texts between line ends."""
    if chunk.isascii():
        return chunk.lower()
    chunk = unicodedata.normalize("NFC", chunk)
    # The capital sigma alone is lowered by its place in a word; here each character is by itself.
    return "".join([c.lower() for c in chunk]) if "\u03a3" in chunk else chunk.lower()


def chunks_of(text: str) -> list[str]:
    if _CONTROL_SPACE.search(text):
        return _CHUNKS.findall(text)
    return text.split()


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """The tokenizer, once for each worker."""
    return WordBpe(path)


class _Known(dict):
    """Ids, as bytes of 32-bit integers, of the words met so far; a line end stands for a chunk's end."""

    def __init__(self, coder: WordBpe):
        super().__init__()
        self.coder = coder

    def of_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks. They are lowered and cut into words together, with a line end between each two."""
        plain = [c for c in chunks if "<|" not in c]
        if len(plain) < len(chunks):
            coded = dict(zip(plain, self.of_chunks(plain)))
            return [coded[c] if c in coded else _raw(self.coder.encode_chunk(c)) for c in chunks]
        words = self.coder.ended_words.findall(lowered(_WORD_END.join(chunks)))
        self._learn(set(words))
        raw = b"".join(map(self.__getitem__, words))
        ends = (4 * np.flatnonzero(np.frombuffer(raw, np.int32) < 0)).tolist()
        return [raw[a:b] for a, b in zip([0, *(x + 4 for x in ends)], [*ends, len(raw)])] if chunks else []

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self)
        if len(self) + len(new) > WORD_ENTRIES:
            self.clear()
            new = set(words)
        self[_WORD_END] = _raw([-1])
        new.discard(_WORD_END)
        short = [w for w in new if len(w) <= LONG_WORD]
        for w in new.difference(short):
            self[w] = _raw(self.coder.encode_chunk(w))
        if short:
            self.update(zip(short, self.coder.encode_words(short)))


def _raw(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


def _code(texts: list[str], known: _Known) -> tuple[list[bytes], list[str]]:
    split = [chunks_of(text) for text in texts]
    begin = np.cumsum([0, *map(len, split)])
    chunks = pa.array(itertools.chain.from_iterable(split), pa.string()).dictionary_encode()
    del split  # the parts of a text are the most that a worker holds
    coded = known.of_chunks(chunks.dictionary.to_pylist())
    lists = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *(len(x) // 4 for x in coded)], dtype=np.int32)),
        pa.array(np.frombuffer(b"".join(coded), np.int32))).take(chunks.indices)
    ends = lists.offsets.take(pa.array(begin))
    decoded = pc.binary_join(pa.ListArray.from_arrays(ends, known.coder.names.take(lists.values)), " ")
    raw, upto = lists.values.to_numpy().tobytes(), (4 * ends.to_numpy().astype(np.int64)).tolist()
    return [raw[a:b] for a, b in itertools.pairwise(upto)], decoded.to_pylist()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (array<int>) and ``decoded`` (string) for each row.

    A null or empty text has no ids and decodes to the empty text. Every row is coded by itself, so repeated rows and
    extra columns pass through; columns named ``ids`` or ``decoded`` are replaced. Memory is bounded by a part of an
    Arrow batch and the chunk table.
    """
    on_workers(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]
    text_at = [f.name for f in kept].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        known = _Known(coder)
        for batch in batches:
            for part in _parts(batch, text_at):
                ids, decoded = _code([t or "" for t in part.column(text_at).to_pylist()], known)
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(ends), values), pa.array(decoded, pa.string())],
                    names=[*part.schema.names, "ids", "decoded"])
        give_back_memory(known, coder.pairs)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(run, f"{fields}, ids array<int>, decoded string")


def _parts(batch: pa.RecordBatch, text_at: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``PART_CHARS`` bytes of text each; a longer text is a part of its own."""
    column = batch.column(text_at)
    sizes = np.array([x or 0 for x in pc.binary_length(column).to_pylist()], np.int64)
    begin = 0
    while begin < batch.num_rows:
        fits = int(np.searchsorted(np.cumsum(sizes[begin:]), PART_CHARS, side="right"))
        n = max(1, fits)
        yield batch.slice(begin, n)
        begin += n
