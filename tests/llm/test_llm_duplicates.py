"""Line and document duplicates, the lattice and the pipeline against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_texts import prose
from skyledger.llm import components, lattice, lines, minhash, queries
from skyledger.llm.common import written

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i:] == b[i + 1:] or len(a) == len(b) and a[i + 1:] == b[i + 1:]


def _mutated(r, text):
    out = list(text)
    for _ in range(r.choice([0, 1, 1, 1, 2])):
        i = r.randrange(len(out) + 1)
        kind = r.randrange(3)
        if kind == 0:
            out.insert(i, r.choice("abzx"))
        elif i < len(out):
            out[i:i + 1] = [r.choice("abzx")] if kind == 1 else []
    return "".join(out) or "q"


def _expected_lines(docs):
    seen, out = [], {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        if (doc_id, text) in out:
            continue
        kept, n, dropped = [], 0, 0
        for line in (text or "").split("\n"):
            own = line.strip(lines.SPACES)
            if not own:
                kept.append(line)
                continue
            n += 1
            long = len(own) >= lines.MIN_CHARS
            if any(own == x or long and len(x) >= lines.MIN_CHARS and _one_edit(own, x) for x in seen):
                dropped += 1
            else:
                kept.append(line)
            seen.append(own)
        out[(doc_id, text)] = ("\n".join(kept), n, dropped)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_against_brute_force(spark, seed):
    r = random.Random(seed)
    base = ["".join(r.choice("abcd é") for _ in range(r.choice([5, 19, 20, 21, 22, 25, 40, 41, 300]))) for _ in range(12)]
    pick = lambda: r.choice(["", "  ", _mutated(r, r.choice(base)), _mutated(r, r.choice(base)), " " + r.choice(base)])
    docs = [(d, "\n".join(pick() for _ in range(r.randint(0, 12)))) for d in range(60)]
    docs[5:7] = [(5, None), (6, "")]
    docs += [(None, "x\n" + base[0]), docs[3]]
    want = _expected_lines(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("blank", F.lit(2))
    rows = lines.dedup_lines(frame).collect()
    assert len(rows) == len(docs)
    got = Counter((r.doc_id, r.text or "", r.n_lines, r.n_dropped, r.kept, r.blank) for r in rows)
    assert got == Counter((d, *want[(d, t)], 1, 2) for d, t in docs)


def _kept_chars(x, y, max_words):
    """Most characters of words that stay when at most ``max_words`` of them are dropped, added or changed."""
    best = {(0, 0, 0): 0}
    for i in range(len(x) + 1):
        for j in range(max(0, i - max_words), min(len(y), i + max_words) + 1):
            for k in range(max_words + 1):
                options = [best.get((i - a, j - b, k - 1)) for a, b in ((0, 1), (1, 0), (1, 1))]
                if i and j and x[i - 1] == y[j - 1] and (i - 1, j - 1, k) in best:
                    options.append(best[i - 1, j - 1, k] + len(x[i - 1]))
                options = [o for o in options if o is not None] + ([0] if i == j == 0 else [])
                if options:
                    best[i, j, k] = max(options)
    return max((best.get((len(x), len(y), k), -1) for k in range(max_words + 1)), default=-1)


def _near_by_words(a, b, max_words, share):
    x, y = (re.findall(r"[\u3000-\uffff]\s*|[^\s\u3000-\uffff]+\s*", t + " ") for t in (a, b))
    if min(len(x), len(y)) < 2 * max_words + 1 or min(len(a), len(b)) < lines.MIN_CHARS:
        return False
    kept = _kept_chars(x, y, max_words)
    return kept >= 0 and all(len(t) + 1 - kept <= share * len(t) + 1e-6 for t in (a, b))


@pytest.mark.parametrize("pair_lines, max_words, share", [(16, 2, 0.1), (1, 2, 0.2), (2, 1, 0.1), (1, 3, 0.3), (16, 0, 0.1)])
def test_line_dedup_by_words_against_brute_force(spark, monkeypatch, pair_lines, max_words, share):
    monkeypatch.setattr(lines, "PAIR_LINES", pair_lines)  # 1: every shared key is narrowed down to single places
    r = random.Random(pair_lines + max_words)
    base = [prose(i, n).split() for i, n in enumerate([5, 6, 9, 12, 30, 31, 70, 200])] + [list("ab ab ab cd cd e f".split() * 3)]
    base.append(list("\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03\u516b\u4e5d\u5341" * 3))

    def changed():
        k = r.randrange(len(base))
        words = list(base[k])
        for _ in range(r.choice([0, 1, 1, 2, 2, 3, 4])):
            i = r.randrange(len(words) + 1)
            kind = r.randrange(3)
            words[i:i + (kind > 0)] = [r.choice(["ab", "q", "longer", "\u4e00"])] if kind < 2 else []
        return ("" if k == len(base) - 1 else " ").join(words)

    docs = [(d, "\n".join(changed() for _ in range(r.randint(0, 5)))) for d in range(50)]
    seen, want, by_words = [], {}, 0
    for d, text in docs:
        kept = []
        for line in filter(None, text.split("\n")):
            near = any(line == x or min(len(line), len(x)) >= lines.MIN_CHARS and _one_edit(line, x) for x in seen)
            words = max_words > 0 and any(_near_by_words(line, x, max_words, share) for x in seen)
            by_words += words and not near
            kept += [] if near or words else [line]
            seen.append(line)
        want[d] = "\n".join(kept)
    assert (by_words > 20) == (max_words > 0)
    rows = lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), max_words, share).collect()
    assert {x.doc_id: "\n".join(filter(None, x.text.split("\n"))) for x in rows} == want


def test_line_dedup_on_messy_rows(messy, empty):
    rows = {r.doc_id: r for r in lines.dedup_lines(messy).collect() if r.doc_id is not None}
    assert rows[2].text is None and rows[3].text == "" and rows[6].n_lines == 0
    assert rows[4].n_dropped == 0 and rows[7].n_dropped == rows[7].n_lines == 1
    assert rows[9].n_lines == 3 and rows[9].n_dropped == 1
    assert lines.dedup_lines(empty).count() == 0


def _components(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(5000, x) for x in range(4900, 4990)]
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    want = _components([e for e in edges if e[0] != e[1]])
    assert {row.node: row.component for row in got} == want and len(got) == len(want)
    none = spark.createDataFrame([(3, 3)], "u long, v long")
    assert components.components(none).count() == 0


def _set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", words)
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def _near_copies(seed):
    r = random.Random(seed)
    docs = []
    for group in range(6):
        base = prose(seed * 100 + group, r.choice([3, 8, 40, 120])).split()
        for _ in range(r.choice([1, 5, 25])):
            own = list(base)
            for _ in range(r.randrange(6)):
                i = r.randrange(len(own))
                own[i:i + 1] = r.choice([[], [own[i].upper()], ["new" + str(r.randrange(5))], [own[i], "extra"]])
            docs.append(" ".join(own))
    docs += [None, "", " \n ", docs[0], docs[0].upper() if docs[0].isascii() else docs[0]]
    # A passage that many texts share, each with words of its own.
    passage = prose(seed + 999, 60)
    docs += [passage + " " + prose(seed * 1000 + i, r.randint(5, 40)) for i in range(25)]
    r.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_against_brute_force(spark, seed):
    docs = _near_copies(seed)
    sets = {d: _set(t) for d, t in docs}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = _components(edges)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = minhash.near_duplicates(frame).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == want.get(r.doc_id, r.doc_id), docs[r.doc_id]
    kept = minhash.drop_near_duplicates(frame).collect()
    assert sorted(r.doc_id for r in kept) == sorted(d for d in sets if want.get(d, d) == d)


def test_near_duplicates_on_messy_rows(messy, empty):
    rows = minhash.near_duplicates(messy).collect()
    assert len(rows) == messy.count()
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[None] is None and by_id[7] == 4 and all(by_id[i] == i for i in (1, 2, 3, 4, 5, 6, 8, 9))
    kept = minhash.drop_near_duplicates(messy)
    assert kept.columns == messy.columns and kept.where("doc_id is null").count() == 2
    assert minhash.near_duplicates(empty).count() == 0 and minhash.drop_near_duplicates(empty).count() == 0


def test_repeated_ids_lose_no_text(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    docs = [(1, a), (1, b), (2, b), (3, b + " more"), (4, c), (4, c), (4, a), (5, None), (5, ""), (6, "one"), (6, "two")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("first_id", F.lit("own"))
    rows = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame).collect())
    n = {t: len(_set(t)) for t in (a, b, c, b + " more")}
    assert rows == Counter([
        (1, n[a], 1), (1, n[b], 1), (2, n[b], 1), (3, n[b + " more"], 1), (4, n[c], 4), (4, n[c], 4), (4, n[a], 1),
        (5, 0, 5), (5, 0, 5), (6, 1, 6), (6, 1, 6)])
    for kept in (minhash.drop_near_duplicates(frame), corpus_pipeline.drop_near_duplicates(spark, frame, SMALL)):
        assert kept.columns == frame.columns and {r.first_id for r in kept.collect()} == {"own"}
        assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
            [(1, a), (1, b), (4, c), (5, None), (5, ""), (6, "one"), (6, "two")])


@pytest.mark.parametrize("share", [0, 1e-4, 1])
def test_copies_find_their_component_either_way(spark, monkeypatch, share):
    monkeypatch.setattr(minhash, "HOT_SHARE", share)
    docs = [(i, prose(7, 30) if i % 3 else prose(i, 30)) for i in range(1, 60)] + [(None, prose(7, 30)), (99, " ")]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == sorted(
        (i or 0, i if i == 99 or not i or i % 3 == 0 else 1) if i else (0, 0) for i, _ in docs)


def _lattice_score(word, weights):
    s = b" " + word
    a = [0.0] + [-math.inf] * len(s)
    for j in range(1, len(s) + 1):
        a[j] = np.logaddexp.reduce([a[i] + weights[s[i:j]] for i in range(j) if s[i:j] in weights])
    return a[-1]


def test_lattice_scores_sum_over_all_cuts():
    pieces = lattice.load_pieces(PIECES)
    weights = dict(zip(pieces.texts, pieces.logp))
    words = [w.encode() for w in prose(3, 200).lower().split()] + [b"\xff\x00", "日本語".encode(), b"a" * 300]
    got = lattice.Lattices(words, PIECES).scores(pieces.logp)
    assert np.allclose(got, [_lattice_score(w, weights) for w in words])
    # A word's expected pieces spell it exactly once.
    length = np.array([len(t) for t in pieces.texts])
    used = lattice.Lattices([words[0]], PIECES).expected(pieces.logp, np.array([3]))
    assert used @ length == pytest.approx(3 * (len(words[0]) + 1))


def test_document_scores_against_brute_force(spark):
    rows = queries.QUERIES["op1_subword_lattice"](spark, SMALL).collect()
    texts = {r.doc_id: (r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    tokens = {d: t.encode().lower().split() + [b""] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    counts = Counter(w for d in texts if not held[d] for w in tokens[d])
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(texts) and {r.train_tokens for r in rows} == {total}
    for r in rows:
        own = tokens[r.doc_id]
        assert r.held_out == held[r.doc_id] and r.n_tokens == len(own)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        assert r.base_score == pytest.approx(base)


def test_training_raises_the_held_out_score(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    score = [lattice.score_documents(docs, PIECES, rounds).where("held_out").agg(F.sum("score")).first()[0] for rounds in (0, 2)]
    assert score[1] > 0.8 * score[0] and score[1] > score[0]


def test_scores_of_messy_rows(messy, empty):
    rows = lattice.score_documents(messy, PIECES).collect()
    assert len(rows) == messy.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_tokens == by_id[3].n_tokens == by_id[6].n_tokens == 1 and not by_id[None].held_out
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert lattice.score_documents(empty, PIECES).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "minhash", "decontaminate", "bpe"]
    current, sizes = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = corpus_pipeline.written(stage(spark, current, SMALL), "test-stage")
        assert current.columns == docs.columns, name
        sizes.append(current.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.7 * sizes[0]
    last = corpus_pipeline.run(spark, SMALL)
    assert last.count() == sizes[-1] and last.where("n_tokens <> size(ids)").count() == 0


def test_pipeline_on_messy_rows(spark, messy, empty):
    for frame in (messy, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SMALL)
            assert name == "bpe" or out.columns == frame.columns
            out.count()


def test_line_stage_keeps_the_values_of_other_columns(spark, messy):
    """Columns that are named like the operator's own counts and helpers keep what they hold."""
    out = corpus_pipeline.dedup_lines(spark, messy.withColumn("row", F.lit("r")), SMALL)
    others = [c for c in messy.columns if c not in ("doc_id", "text")]
    kept = {tuple(r) for r in messy.select(*others).collect()}
    assert out.columns == [*messy.columns, "row"] and {tuple(r) for r in out.select(*others).collect()} == kept


def test_keys_found_twice_and_how_often_they_are_sent(spark):
    """Shared keys by ranges, at both ends of the range; one that all lines share is sent twice by a batch at most."""
    own = [[i, -i, 0, 2 ** 63 - 1, -(2 ** 63)] for i in range(1, 2000)] + [[0, 7, 7, -3], [], [0], [2 ** 62]]
    firsts = spark.createDataFrame([(k,) for k in own], "keys array<long>").coalesce(1)
    found = lines._found_twice(firsts, 5)
    assert sorted(r.key for r in found.collect()) == [-(2 ** 63), -3, 7, 2 ** 63 - 1]
    assert lines._found_twice(firsts.where("false"), 5).count() == 0
    many = spark.range(50_000).selectExpr("array(-1L, id + 1) AS keys").coalesce(1)
    sent = lines._sorted_ranges(many, lines.BUCKET_BITS)
    assert sent.agg({"sorted": "count"}).first()[0] > 0
    assert sent.selectExpr("max(length(sorted))").first()[0] <= 8 * 10_002
    assert sent.where(f"bucket = {2 ** lines.BUCKET_BITS - 1}").selectExpr("sum(length(sorted)) / 8 AS n").first()[0] <= 2 * 5


def test_lines_that_few_share_are_compared_without_keys_of_halves(spark, monkeypatch):
    """Rows of a step follow the lines that many share: pairs meet by a part alone, settled copies seek nothing."""
    sent = Counter()

    def counted(df, purpose):
        out = written(df, purpose)
        sent[purpose] += out.count()
        return out

    def dropped(texts):
        sent.clear()
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return lines.dedup_lines(docs, 2, 0.2).agg(F.sum("n_dropped")).first()[0]

    monkeypatch.setattr(lines, "written", counted)
    base = [prose(i, 24).split() for i in range(40)]
    copies = [[*words[:5], "changed", *words[6:15], "twice", *words[16:]] for words in base]
    assert dropped([" ".join(w) for w in base + copies]) == 40
    assert sent["half-keys"] + sent["place-keys"] == 0
    # The earliest settles all of a large group, whose rows are then those that seek: none.
    assert dropped([" ".join([*base[0][:12], f"w{i}", *base[0][13:]]) for i in range(200)]) == 199
    assert sent["half-keys"] + sent["place-keys"] <= 200 * len(lines._halves(2)) and sent["seekers"] == 0
