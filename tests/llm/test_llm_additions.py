"""Infill cuts, phrase automata and vector links against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_texts import prose
from skyledger.llm import infill, phrases, queries, vectors

SMALL = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _infilled(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < 80:
        return len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def test_infill_against_brute_force(spark, monkeypatch):
    r = random.Random(3)
    alphabet = ["a", "é", "日本", "<", "S", ">", " ", "\t", "\n ", "\x1c", "\xa0", "𝄞", "word "]
    rows = [(i, "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 5, 60, 4000])))) for i in range(400)]
    rows += [(1000, "  "), (1001, "<P>"), (1002, "a" * 5000), (1003, " " * 3000 + "x" + " " * 3000)]
    for part in (infill.PART_BYTES, 1000):
        monkeypatch.setattr(infill, "PART_BYTES", part)
        out = infill.transform(spark.createDataFrame(rows, "doc_id long, text string"))
        got = out.withColumn("again", infill.restored(F.col("form"), F.col("output"))).collect()
        texts = dict(rows)
        assert len(got) == len(rows) and {x.form for x in got} == {"plain", "psm", "spm"}
        for x in got:
            assert (x.n, x.form, x.prefix_chars, x.middle_chars, x.output) == _infilled(x.doc_id, texts[x.doc_id])
            assert x.again == texts[x.doc_id]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 100])
def test_descent_finds_every_unit(n):
    r = np.random.default_rng(n)
    units, points = r.integers(0, 4, n), r.integers(0, 9, n)
    tree = infill.Fenwick(units, points)
    ends = np.repeat(np.arange(n), units)
    for k in range(1, units.sum() + 1):
        block = ends[k - 1]
        assert tree.descend(k) == (block, k - units[:block].sum(), points[:block].sum())


def test_infill_of_messy_rows(messy, empty):
    got = infill.transform(messy).collect()
    want = [(x.doc_id, *_infilled(x.doc_id, x.text)) for x in messy.collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert infill.transform(empty).count() == 0


def _collocations(rows, min_count=10, top=2000):
    f = defaultdict(Counter)
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        found = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        gone = {q for p, c in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if q in found and 100 * c >= 50 * found[q]}
        scored = []
        for p, a in found.items():
            if p not in gone:
                cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def _sentences(seed, n):
    """Texts with set phrases among random words."""
    r = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "la", "Été", "x\x1cy", "co-op", "日本", "a"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(r.randrange(40)):
            parts.append(r.choice([r.choice(words), "New York City", "of the", "in the end", "\t", "rare" + str(r.randrange(99))]))
            parts.append(r.choice([" ", " ", " ", " ", ", ", ".\n", "  ", "!"]))
        out.append(("".join(parts) or None, r.choice(["en", "en", "fr", None])))
    return out


@pytest.mark.parametrize("range_bytes,shard", [(8 << 20, 1 << 20), (300, 100), (20, 7)])
def test_phrases_against_brute_force(spark, monkeypatch, range_bytes, shard):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    monkeypatch.setattr(phrases, "LOOKUPS", 5)
    rows = _sentences(11, 300)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    got = sorted(map(tuple, phrases.collocations(docs, range_bytes=range_bytes).collect()))
    assert got == _collocations(rows)
    assert {lang for lang, *_ in got} == {"en", "fr", "und"}


def test_only_the_first_phrases_of_a_language(spark):
    rows = _sentences(12, 200)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, phrases.collocations(docs, min_count=3, top=4).collect())) == _collocations(rows, 3, 4)


def test_phrase_query_on_the_small_table(spark):
    rows = [(x.text, x.lang) for x in spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang").collect()]
    assert sorted(map(tuple, queries.QUERIES["op12_phrase_automata"](spark, SMALL).collect())) == _collocations(rows)


def test_phrases_of_messy_rows(spark, messy, empty):
    assert phrases.collocations(empty.withColumn("lang", F.lit("en"))).count() == 0
    own = messy.withColumn("lang", F.when(F.col("doc_id") < 5, "en")).withColumn("range", F.lit(1)).withColumn("a", F.lit(2))
    many = own.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(12))))
    rows = [(x.text, x.lang) for x in many.collect()]
    assert sorted(map(tuple, phrases.collocations(many, min_count=24, top=50).collect())) == _collocations(rows, 24, 50)


def _automaton(counts):
    words, places = phrases._vocabulary([pa.array([w for p in counts for w in p], pa.binary())])
    at, runs = 0, []
    for p in counts:
        runs.append([*places[at:at + len(p)], *[-1] * (3 - len(p))])
        at += len(p)
    order = sorted(range(len(runs)), key=lambda i: runs[i])
    return phrases.CountAutomaton.build(
        words, np.array(runs, np.int64).reshape(-1, 3)[order], np.array(list(counts.values()), np.int64)[order])


def _paths(automaton):
    runs, counts = automaton.runs()
    words = automaton.words.to_pylist()
    return {tuple(words[i] for i in run if i >= 0): int(c) for run, c in zip(runs, counts)}


@pytest.mark.parametrize("seed", range(6))
def test_automata_hold_add_and_look_up(seed):
    r = random.Random(seed)
    shards = []
    for _ in range(r.choice([1, 2, 5])):
        shard = Counter()
        for _ in range(r.choice([1, 20, 300])):
            shard[tuple(r.choice([b"a", b"b", b"\xc3\xa9", b"zz", b"q"]) for _ in range(r.choice([1, 2, 3])))] += r.choice([1, 1, 300])
        shards.append(shard)
    built = [phrases.CountAutomaton.from_bytes(_automaton(s).to_bytes()) for s in shards]
    assert [_paths(a) for a in built] == [dict(s) for s in shards]
    total = sum(shards, Counter())
    united = phrases.union(built)
    assert _paths(united) == dict(total)
    asked = [(b"a",), (b"no",), (b"a", b"no"), (b"a", b"b"), (b"zz", b"q", b"a"), (b"no", b"a", b"b"), *total]
    words, runs = phrases._acceptor(pa.array([b" ".join(p) for p in asked], pa.binary()))
    assert united.compose(words, runs).tolist() == [total[p] for p in asked]


def test_equal_last_states_are_stored_once():
    automaton = _automaton({(a, b, b"end"): 1 for a in (b"a", b"b", b"c") for b in (b"x", b"y")})
    assert len(automaton.label3) == 1 and len(automaton.label2) == 6
    assert len(_paths(automaton)) == 6


def _linked(rows, cosine=0.9):
    """n_links and component of every row, from all pairs."""
    ok = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v) and rows[i][0] is not None:
            v = np.array(v, np.float32).astype(float)
            ok[i] = v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())
    parent = {i: i for i in range(len(rows))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for i in ok:
        for j in ok:
            if i < j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= cosine - 1e-12:
                links[i] += 1
                links[j] += 1
                parent[root(j)] = root(i)
    least = {}
    for i in ok:
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], links[i], least[root(i)] if i in ok else rows[i][0]) for i in range(len(rows))), key=repr)


def _cloud(seed, n, dim, groups):
    r = np.random.default_rng(seed)
    out = [r.standard_normal(dim) for _ in range(n)]
    for size, spread in groups:
        centre = r.standard_normal(dim)
        out += [centre + spread * r.standard_normal(dim) for _ in range(size)]
    out += [out[3], out[3] * 2, out[4]]
    return [(int(i), np.float32(v).tolist()) for i, v in zip(r.permutation(len(out)), out)]


# One cell; many cells of one block; one cell of many blocks; both. Groups lie about the threshold.
@pytest.mark.parametrize("cell,block,tile", [(16_384, 16_384, 1_024), (40, 10_000, 16), (10_000, 30, 8), (60, 20, 7)])
def test_links_against_brute_force(spark, monkeypatch, cell, block, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    rows = _cloud(5, 200, 24, [(60, 0.1), (40, 0.25), (25, 0.33), (25, 0.4)])
    rows += [(9000, None), (9001, []), (9002, [0.0] * 24), (9003, [float("nan")] * 24), (9004, [None] * 24),
             (9005, [1e-30] * 24), (9006, [2e-30] * 24), (9007, [1.0] * 5), (9008, [1.0] * 5), (None, [1.0] * 5),
             (None, [1.0] * 5), (9009, [-1e30] * 24)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1))
    got = vectors.near_duplicates(table, cell=cell, block=block, recall=1 - 1e-9)
    assert got.columns == ["vec_id", "n_links", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == _linked(rows)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, with the production recall and many cells."""
    r = np.random.default_rng(8)
    rows = []
    for i in range(600):
        a, b = r.standard_normal(64), r.standard_normal(64)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.901 * a + np.sqrt(1 - 0.901 ** 2) * b).tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert vectors.cuttings(1200, cell=20)[0] == 6
    found = vectors.near_duplicates(table, cell=20).where("n_links = 1 AND component_id div 2 = vec_id div 2").count()
    assert found >= 0.99 * len(rows)


def test_bounds_hold_for_any_vectors():
    r = np.random.default_rng(2)
    x = np.concatenate([r.standard_normal((300, 40)), r.standard_normal((100, 40)) ** 9, np.eye(40)])
    units = np.stack([vectors._unit(v) for v in x])
    codes, scale, off = vectors.quantise(units)
    about = (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale
    assert (np.abs(about - units @ units.T) <= off[:, None] + off * (1 + off[:, None])).all()


def test_ids_that_repeat_and_empty_tables(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    table = spark.createDataFrame(
        [(1, a, "x"), (1, b, "y"), (2, b, "z"), (3, a, "u"), (4, [0.0, 0.0, 1.0], "v")],
        "vec_id long, embedding array<double>, label string").withColumn("print", F.lit("p"))
    got = sorted(map(tuple, vectors.near_duplicates(table).collect()))
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4)]
    assert {r.label for r in vectors.drop_near_duplicates(table).collect()} == {"x", "y", "v"}
    assert vectors.near_duplicates(table.where("vec_id > 9")).count() == 0
    assert vectors.near_duplicates(table.where("vec_id = 4")).collect() == [(4, 0, 4)]


def test_no_link_is_lost_in_a_large_table(spark):
    """Beyond 16,384 vectors too, a link depends on its two vectors alone."""
    r = np.random.default_rng(11)
    a, b = r.standard_normal((2, 12_000, 32))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    x = np.stack([a, 0.9001 * a + np.sqrt(1 - 0.9001 ** 2) * b], 1).reshape(-1, 32)
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    assert vectors.near_duplicates(table).where("n_links >= 1 AND component_id div 2 <= vec_id div 2").count() == len(x)
