"""Personal data: fixed detectors, and a linear-chain conditional random field over word shapes.

The detectors find e-mail addresses, IP addresses, card and phone numbers by pattern and checksum. The field is trained
on a small table: forms that the detectors miss, with look-alikes, labelled by hand (``pii_labels``), and stretches of
text that the detectors labelled, drawn from a bounded sample of documents. A sampled stretch that holds a word of the
shape of a labelled form, outside the detectors' spans, is left out, as its label is not known. Words are seen by their
shape alone, but for a few that announce a number and for at signs and dots written out. Decoding is by Viterbi in numpy
batches. Spans lie within ``CONTEXT`` words of a word with a digit, an at sign, a plus sign or a sign written out, so
only these are decoded. Words are cut where scripts meet and after marks that part fields of records and addresses.
Detectors' spans stay as they are; the field adds spans that touch none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import pii_labels
from skyledger.llm.common import on_workers, text_or_empty

KINDS = ("email", "ip", "card", "phone")
# Documents whose stretches make the labelled table, picked by a checksum of the id; stretches of each document.
SAMPLE_DOCUMENTS = 3000
STRETCHES = 8
# Words of a sampled stretch that go into the table; its later words teach nothing. Decoding reads all words.
STRETCH_WORDS = 40
# Words on either side of a word that may belong to a span.
CONTEXT = 2
RIDGE, STEPS, RATE = 1e-4, 150, 0.2
# Stretches decoded together.
BATCH = 4096
CACHE_SHAPES = 200_000
# From here on (radicals, CJK, kana, Hangul, ...) scripts write without blanks.
NO_BLANKS = 0x2E80
# Longer words are not kept in the cache; longer shapes are held as checksums.
CACHE_CHARS = 64

# State 0 is outside; then the beginning and the inside of each kind.
N_STATES = 1 + 2 * len(KINDS)

_AT_RIGHT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HIDDEN = re.compile(r"[(\[](at|dot|\.)[)\]]", re.I)
_HINT = re.compile(r"[0-9@+]|[(\[](?:at|dot)[)\]]", re.I)
_DIGITS = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        right = _AT_RIGHT.match(text, at) if begin < at else None
        if right:
            free = right.end()
            yield begin, free
        at = text.find("@", max(at + 1, free))


def _octet(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or 0) <= 255


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            for m in _IP.finditer(run[0]):
                if all(map(_octet, m[0].split("."))):
                    yield run.start() + m.start(), run.start() + m.end()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield m.span()


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind, begin, end) of the detectors' spans, by kind and place."""
    found = [(0, *s) for s in _emails(text)]
    if _DIGITS.search(text):
        for kind, finder in ((1, _ips), (2, _cards), (3, _phones)):
            found += [(kind, *s) for s in finder(text)]
    return found


_SHAPE = str.maketrans({**{c: "d" for c in "0123456789"}, **{chr(c): "x" for c in range(97, 123)},
                        **{chr(c): "X" for c in range(65, 91)}})
_RUN = re.compile(r"d+|x+|X+|.", re.S)
_EDGES = ".,;:!?\"'|<>{}=&"
# Words that announce a phone number.
_CUES = frozenset(("tel", "phone", "telephone", "telefon", "téléphone", "teléfono", "fax", "mobile", "cell"))


def _signs(m: re.Match) -> str:
    return "@" if m[1].lower() == "at" else "."


def _long(shape: str) -> str:
    return shape if len(shape) <= CACHE_CHARS else "#" + xxhash.xxh3_128_hexdigest(shape)


def _shapes(word: str) -> tuple[str, str]:
    bare = word.strip(_EDGES)
    if bare.lower() in _CUES:
        return "tel", "tel"
    plain = _HIDDEN.sub(_signs, bare)
    mark = "hidden" if plain != bare else ""
    digits = _NOT_DIGIT.sub("", plain)
    if 16 <= len(digits) <= 19:
        mark += "ok" if luhn(digits) else "no"
    elif _IP.fullmatch(plain):
        mark += "ok" if all(map(_octet, plain.split("."))) else "no"
    runs = _RUN.findall(plain.translate(_SHAPE))
    fine = "".join(f"d{len(r)}" if r[0] == "d" else r[0] if r[0] in "xX" else r for r in runs)
    return _long(fine + mark), _long("".join(r[0] for r in runs) + mark)


_kept_shapes = lru_cache(maxsize=CACHE_SHAPES)(_shapes)


def shapes(word: str) -> tuple[str, str]:
    """The whole word's shape with the lengths of its digit runs, and without them; marks at its ends are left out.

    Digit runs as long as a card number tell whether their checksum is right, and four dotted numbers whether each fits
    a byte, as these are properties of the form and not of the value. Signs that are written out count as signs.
    """
    return _kept_shapes(word) if len(word) <= CACHE_CHARS else _shapes(word)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


_BLANK = np.zeros(128, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PARTING = np.zeros(128, bool)
_PARTING[[ord(c) for c in ";|<>{}=&?\"\\"]] = True
_HINTED = np.zeros(128, bool)
_HINTED[[*range(48, 58), ord("@"), ord("+")]] = True


def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words, as places, around the words that may belong to a span."""
    if not _HINT.search(text):
        return []
    alone = _codes(text) >= NO_BLANKS
    codes = np.minimum(_codes(text), 127)
    # 0 for blanks, 2 for scripts without blanks, 1 for the rest; a word ends where this changes, and behind a mark that parts.
    kind = np.where(_BLANK[codes], 0, 1 + alone)
    turn = np.ones(len(codes) + 1, bool)
    turn[1:-1] = (kind[1:] != kind[:-1]) | _PARTING[codes[:-1]]
    edge = np.flatnonzero(turn)
    begin, end = edge[:-1], edge[1:]
    begin, end = begin[kind[begin] > 0], end[kind[begin] > 0]
    hinted = _HINTED[codes]
    for m in _HIDDEN.finditer(text):
        hinted[m.start()] = True
    hints = np.concatenate([[0], np.cumsum(hinted)])
    centre = np.flatnonzero(hints[end] > hints[begin])
    near = np.unique(np.clip(centre[:, None] + np.arange(-CONTEXT, CONTEXT + 1), 0, len(begin) - 1))
    cuts = np.flatnonzero(np.diff(near) > 1) + 1
    return [list(zip(begin[p].tolist(), end[p].tolist())) for p in np.split(near, cuts)]


def _features(words: list[str]) -> list[list[str]]:
    own = [shapes(w) for w in words]
    pad = [("", "<"), *own, ("", ">")]
    return [["0" + f, "1" + c, "2" + pad[i][1], "3" + pad[i + 2][1], "4" + pad[i][1] + " " + c, "5" + c + " " + pad[i + 2][1]]
            for i, (f, c) in enumerate(own)]


@dataclass(frozen=True)
class Field:
    """Feature numbers, their weights for each state, and the weights of steps between states."""

    features: dict[str, int]
    emit: np.ndarray
    step: np.ndarray


def _padded(rows: list[list[int]], fill: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows])
    out = np.full((len(rows), sizes.max()), fill, np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out, sizes


def _log_loss(
    used: np.ndarray, truth: np.ndarray, sizes: np.ndarray, emit: np.ndarray, step: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Minus the log likelihood of all stretches, and its gradients, by forward and backward sums."""
    width = used.shape[2]
    real = np.arange(truth.shape[1])[None, :] < sizes[:, None]
    rows, places = np.arange(len(truth))[:, None], np.arange(truth.shape[1])[None, :]
    score = emit[used].sum(2)
    # Sums are kept as shares of their total at each word, so they neither grow nor vanish.
    top, most = score.max(2), step.max()
    own, ways = np.exp(score - top[:, :, None]), np.exp(step - most)
    alpha, beta, sums = np.zeros_like(score), np.ones_like(score), np.ones(truth.shape)
    alpha[:, 0] = own[:, 0]
    for t in range(truth.shape[1]):
        on = real[:, t]
        if t:
            alpha[:, t] = np.where(on[:, None], (alpha[:, t - 1] @ ways) * own[:, t], alpha[:, t - 1])
        sums[on, t] = alpha[on, t].sum(1)
        alpha[:, t] /= sums[:, t, None]
    total = ((np.log(sums) + top) * real).sum() + most * real[:, 1:].sum()
    loss = total - (score[rows, places, truth] * real).sum() - (step[truth[:, :-1], truth[:, 1:]] * real[:, 1:]).sum()
    d_step = np.zeros_like(step)
    for t in range(truth.shape[1] - 2, -1, -1):
        ahead = own[:, t + 1] * beta[:, t + 1] / sums[:, t + 1, None] * real[:, t + 1, None]
        beta[:, t] = np.where(real[:, t + 1, None], ahead @ ways.T, 1.0)
        d_step += ways * (alpha[:, t].T @ ahead)
    taken = truth[:, :-1] * N_STATES + truth[:, 1:]
    d_step -= np.bincount(taken[real[:, 1:]], minlength=N_STATES ** 2).reshape(N_STATES, N_STATES)
    share = alpha * beta * real[:, :, None]
    share[rows, places, truth] -= real
    flat = used.reshape(-1)
    spread = np.repeat(share.reshape(-1, N_STATES), width, 0)
    d_emit = np.stack([np.bincount(flat, spread[:, k], minlength=len(emit)) for k in range(N_STATES)], 1)
    d_emit[-1] = 0  # the empty word's row
    return float(loss), d_emit, d_step


def _numbered(table: list[tuple[list[list[str]], list[int]]]) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the features, features of each word, states, sizes); the row behind the last is the empty word's."""
    number = {f: i for i, f in enumerate(sorted({f for rows, _ in table for r in rows for f in r}))}
    truth, sizes = _padded([s for _, s in table], 0)
    used = np.full((len(table), truth.shape[1], len(table[0][0][0])), len(number), np.int64)
    for i, (rows, _) in enumerate(table):
        used[i, :len(rows)] = [[number[f] for f in r] for r in rows]
    return number, used, truth, sizes


def train(table: list[tuple[list[list[str]], list[int]]]) -> Field:
    """Maximum likelihood with a ridge penalty, all stretches at once."""
    table = [t for t in table if t[0]]
    if not table or not any(any(states) for _, states in table):
        return Field({}, np.zeros((1, N_STATES)), np.zeros((N_STATES, N_STATES)))
    number, used, truth, sizes = _numbered(table)
    emit, step = np.zeros((len(number) + 1, N_STATES)), np.zeros((N_STATES, N_STATES))
    mean = [np.zeros_like(emit), np.zeros_like(step)]
    square = [np.zeros_like(emit), np.zeros_like(step)]
    for turn in range(1, STEPS + 1):
        _, d_emit, d_step = _log_loss(used, truth, sizes, emit, step)
        for i, (value, gradient) in enumerate(((emit, d_emit / len(table)), (step, d_step / len(table)))):
            gradient = gradient + RIDGE * value
            mean[i] = 0.9 * mean[i] + 0.1 * gradient
            square[i] = 0.99 * square[i] + 0.01 * gradient ** 2
            value -= RATE * (mean[i] / (1 - 0.9 ** turn)) / (np.sqrt(square[i] / (1 - 0.99 ** turn)) + 1e-8)
    return Field(number, emit, step)


def viterbi(field: Field, rows: list[list[list[str]]]) -> list[list[int]]:
    """The likeliest states of each stretch; stretches of like length are decoded side by side."""
    out: list[list[int]] = [[] for _ in rows]
    order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
    unknown = len(field.emit) - 1
    get = field.features.get
    for start in range(0, len(order), BATCH):
        part = order[start:start + BATCH]
        part = [i for i in part if rows[i]]
        if not part:
            continue
        sizes = np.array([len(rows[i]) for i in part])
        longest = sizes.max()
        score = np.zeros((len(part), longest, N_STATES))
        at = np.array([get(f, unknown) for i in part for r in rows[i] for f in r], np.int64)
        words = field.emit[at].reshape(int(sizes.sum()), -1, N_STATES).sum(1)
        score[np.repeat(np.arange(len(part)), sizes), np.concatenate([np.arange(s) for s in sizes])] = words
        best = score[:, 0]
        back = np.zeros((len(part), longest, N_STATES), np.int8)
        last = best.copy()
        for t in range(1, longest):
            ways = best[:, :, None] + field.step[None]
            back[:, t] = ways.argmax(1)
            best = score[:, t] + ways.max(1)
            last = np.where((t < sizes)[:, None], best, last)
        state = last.argmax(1)
        path = np.zeros((len(part), longest), np.int64)
        for t in range(longest - 1, -1, -1):
            path[:, t] = state
            moved = back[np.arange(len(part)), t, state]
            state = np.where((t < sizes) & (t > 0), moved, state)
        for i, p, s in zip(part, path, sizes):
            out[i] = p[:s].tolist()
    return out


def _states(words: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    states = [0] * len(words)
    for kind, begin, end in spans:
        inside = False
        for i, (a, b) in enumerate(words):
            if a < end and b > begin:
                states[i] = 1 + 2 * kind + inside
                inside = True
    return states


def _spans(text: str, words: list[tuple[int, int]], states: list[int]) -> Iterator[tuple[int, int, int]]:
    """Spans of the runs of states, without marks at their ends."""
    i = 0
    while i < len(words):
        if not states[i]:
            i += 1
            continue
        kind = (states[i] - 1) // 2
        j = i + 1
        while j < len(words) and states[j] == 2 + 2 * kind:
            j += 1
        begin, end = words[i][0], words[j - 1][1]
        while begin < end and not (text[begin].isalnum() or text[begin] in "+("):
            begin += 1
        while begin < end and not text[end - 1].isalnum():
            end -= 1
        if begin < end:
            yield kind, begin, end
        i = j


def written_table() -> tuple[list[tuple[list[list[str]], list[int]]], frozenset[str]]:
    """The stretches labelled by hand, and the shapes that tell one of their spans' words, more than bare digits or letters."""
    table, telling = [], set()
    for text, spans in pii_labels.texts():
        own = [(KINDS.index(kind), a, b) for kind, a, b in spans]
        for run in stretches(text):
            words = [text[a:b] for a, b in run]
            states = _states(run, own)
            table.append((_features(words), states))
            telling.update(shapes(w)[0] for w, s in zip(words, states) if s)
    return table, frozenset(t for t in telling if not re.fullmatch("d[0-9]+|[xX]+", t))


def labelled_table(docs: DataFrame) -> list[tuple[list[list[str]], list[int]]]:
    """The stretches labelled by hand, then those of ``SAMPLE_DOCUMENTS`` documents, ``STRETCHES`` of each at most."""
    on_workers(docs.sparkSession)
    by_hand, telling = written_table()
    ids = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(SAMPLE_DOCUMENTS)
    sample = docs.join(F.broadcast(ids), "doc_id").select("doc_id", text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, states = [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                spans = detect(text)
                for run_ in stretches(text)[:STRETCHES]:
                    run_ = run_[:STRETCH_WORDS]
                    own, labels = [text[a:b] for a, b in run_], _states(run_, spans)
                    if any(not s and shapes(w)[0] in telling for w, s in zip(own, labels)):
                        continue
                    ids.append(doc_id.as_py())
                    words.append(own)
                    states.append(labels)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(words, pa.list_(pa.string())),
                pa.array(states, pa.list_(pa.int32()))], names=["doc_id", "words", "states"])

    rows = sample.mapInArrow(run, "doc_id bigint, words array<string>, states array<int>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.words))
    return by_hand + [(_features([str(w) for w in r.words]), list(r.states)) for r in rows]


def find(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with ``base`` and ``added``: spans (kind, begin, end) in code points, end exclusive.

    ``base`` is ordered by kind and place, ``added`` likewise, and no added span touches a base one. Null and empty texts
    have no spans. Rows are independent; extra columns pass through, and columns of the two names are replaced.
    """
    on_workers(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in ("base", "added")]
    text_at = [f.name for f in kept].index("text")
    span = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, rows, owners, places, texts = [], [], [], [], {}
            for i, text in enumerate(batch.column(text_at)):
                text = text.as_py() or ""
                base.append(detect(text))
                for run_ in stretches(text):
                    texts[i] = text
                    owners.append(i)
                    places.append(run_)
                    rows.append(_features([text[a:b] for a, b in run_]))
            added: list[list[tuple[int, int, int]]] = [[] for _ in base]
            for i, run_, states in zip(owners, places, viterbi(field, rows)):
                if any(states):
                    for kind, begin, end in _spans(texts[i], run_, states):
                        if not any(a < end and b > begin for _, a, b in base[i]):
                            added[i].append((kind, begin, end))
            as_spans = lambda found: pa.array(
                [[{"kind": KINDS[k], "begin": a, "end": b} for k, a, b in sorted(own)] for own in found], pa.list_(span))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, as_spans(base), as_spans(added)], names=[*batch.schema.names, "base", "added"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    spans = "array<struct<kind: string, begin: int, end: int>>"
    return docs.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(run, f"{fields}, base {spans}, added {spans}")


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; other columns stay, whatever their names.

    Null texts stay null. Every row comes out once, repeated ones too; an empty table gives no rows.
    """
    found = find(docs.select("text", F.struct(*docs.columns).alias("row")), field)
    every = F.array_sort(F.transform(
        F.concat("base", "added"), lambda s: F.struct(s["begin"].alias("a"), s["end"].alias("b"), s["kind"].alias("k"))))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    # Of overlapping spans the earlier one is masked.
    done = F.aggregate(every, start, lambda acc, s: F.when(s["a"] < acc["at"], acc).otherwise(F.struct(
        F.concat(acc["text"], F.substring(F.col("text"), acc["at"] + 1, s["a"] - acc["at"]),
                 F.lit("["), s["k"], F.lit("]")).alias("text"), s["b"].alias("at"))))
    rest = F.expr("substring(text, done.at + 1)")
    masked = found.withColumn("done", done).withColumn(
        "text", F.when(F.size(every) > 0, F.concat("done.text", rest)).otherwise(F.col("text")))
    return masked.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
