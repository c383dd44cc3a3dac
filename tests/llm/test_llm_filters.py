"""Rules, decontamination, sharding, toxicity and personal data on small and messy tables."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_texts import prose
from skyledger.llm import decontaminate, pii, queries, rules, sharding, toxicity


def test_rules_on_messy_rows(messy, empty):
    rows = rules.apply_policy(rules.ledger(messy), rules.POLICIES[-1]).collect()
    assert len(rows) == messy.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_words == by_id[3].n_words == by_id[6].n_words == 0 and not by_id[2].kept
    assert by_id[1].n_words == 80 and by_id[5].n_words == 20000 and by_id[8].word_chars == 50000
    assert by_id[9].n_dup_lines == 1
    assert rules.ledger(empty).count() == 0


def _repeats(words):
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)})


def test_repeated_words_against_brute_force(spark):
    r = random.Random(7)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 40))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in rules.measure(docs).collect():
        assert row.n_repeat_words == _repeats(texts[row.doc_id].split())


def test_policies_and_ablations(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, prose(1, 90)), (3, "x " * 60), (4, "# " * 70)], "doc_id long, text string")
    entries = rules.ledger(docs)
    kept = {p.version: {r.doc_id for r in rules.apply_policy(entries, p).where("kept").collect()} for p in rules.POLICIES}
    assert kept == {1: {2}, 2: {2}}
    report = {(r.policy, r.rule): (r.fails, r["only"]) for r in rules.ablations(entries).collect()}
    assert report[(1, "few_words")] == (1, 1)
    assert report[(2, "symbols")] == (1, 0)


def _words(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def _brute_hits(text, items):
    words, hit, found = _words(text), set(), set()
    for item, own in items:
        own = _words(own)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == own[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item))
    return hit, found


def test_decontamination_against_brute_force(spark):
    items = [(1, prose(10, 30)), (2, "Short Item"), (3, None), (4, "..."), (5, prose(11, 10)), (10, prose(10, 12)), (2, "Short Item")]
    long = prose(10, 30).split()
    texts = [
        prose(12, 40), prose(10, 30), prose(50, 20) + " " + " ".join(long[3:14]) + " y", " ".join(long[3:12]), "a b short, item c d",
        "SHORT-ITEM", None, "", prose(11, 10).upper(), " ".join(long) + " " + " ".join(long), "Ñu " + prose(11, 10)]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)] + [(None, "short item", "k")], "doc_id long, text string, items string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.mark(docs, benchmark).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = "short item" if r.doc_id is None else texts[r.doc_id]
        hit, found = _brute_hits(text, items)
        assert r.n_words == len(_words(text)) and r.hit_words == sorted(hit) and r["items"] == sorted(found), text
    left = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert 1 not in left and left[0] == texts[0] and left[6] is None
    assert left[2] == prose(50, 20) + " y"
    assert left[4] == "a b c d"


def test_decontamination_of_messy_rows(messy, empty, spark):
    benchmark = spark.createDataFrame([(1, prose(3, 70))], "item_id long, text string")
    hit = {r.doc_id for r in decontaminate.mark(messy, benchmark).where("size(hit_words) > 0").collect()}
    assert hit == {4, 7}
    assert decontaminate.mark(messy, benchmark.where("1 = 0")).where("size(hit_words) > 0").count() == 0
    assert decontaminate.mark(empty, benchmark).count() == 0
    assert decontaminate.decontaminate(messy, benchmark).columns == messy.columns


def test_shards_are_even_and_gapless(spark, messy, empty):
    docs = spark.createDataFrame([(i, "x" * (i * 7 % 900)) for i in range(3000)], "doc_id long, text string")
    rows = sharding.shard_documents(docs, shards=8).collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    loads = {}
    for r in rows:
        loads.setdefault(r.shard, []).append(r)
    sizes = [sum(r.size for r in own) for own in loads.values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 1000
    for own in loads.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sharding.shard_documents(messy).count() == messy.count()
    assert sharding.shard_documents(messy).where("doc_id = 2").first()["size"] == 1
    assert sharding.shard_documents(empty).count() == 0


def test_shard_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op3_virtual_slots"](spark, sf).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in texts.items()}
    places = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(16)}
    assert all(own == list(range(len(own))) for own in places.values())
    # The same greedy map, slot by slot from the largest down.
    slots = {}
    for r in rows:
        slots[r.virtual_slot] = slots.get(r.virtual_slot, 0) + r["size"]
    load, owner = [0] * 16, {}
    for slot, size in sorted(slots.items(), key=lambda x: (-x[1], x[0])):
        owner[slot] = load.index(min(load))
        load[owner[slot]] += size
    assert all(owner[r.virtual_slot] == r.shard for r in rows)


def test_new_shard_takes_slots_only_into_itself(spark):
    docs = sharding.with_slot(spark.range(20000).select(F.col("id").alias("doc_id"), F.lit(10).cast("long").alias("size")))
    first = sharding.first_map(sharding.slot_stats(docs), 4)
    second = sharding.add_shard(first)
    before = {r.virtual_slot: r for r in first.collect()}
    after = {r.virtual_slot: r for r in second.collect()}
    assert set(before) == set(after) and {r.version for r in after.values()} == {2}
    moved = [s for s in before if before[s].shard != after[s].shard]
    assert {after[s].shard for s in moved} == {4}
    assert sum(before[s].bytes for s in moved) == pytest.approx(200000 / 5, rel=0.1)


def _labelled(spark, n, seed=0):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * 100000 + i, r.randint(20, 60)).split()
        toxic = i % 4 == 0
        for _ in range(r.randint(2, 5) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(["grumbler", "grumbling", "vilest", "nastyword"]))
        rows.append((i + seed * 100000, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic long")


def test_toxicity_on_held_out_rows(spark):
    train, test = _labelled(spark, 800), _labelled(spark, 300, 1)
    model = toxicity.fit(train.drop("toxic"), train.select("doc_id", "toxic"))
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = toxicity.score(test, model, ("doc_id", "toxic")).collect()
    assert sum(r.rejected == bool(r.toxic) for r in rows) / len(rows) > 0.98
    grades = {r.grade for r in rows if r.toxic}
    assert len(grades) > 1 and all(0 <= r.severity <= 3 for r in rows)


def test_toxicity_without_labels_and_on_messy_rows(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic long")
    for own in (labels, labels.where("1 = 0"), labels.where("toxic = 1")):
        model = toxicity.fit(messy, own)
        assert toxicity.score(messy, model).count() == messy.count()
        assert toxicity.score(empty, model).count() == 0
    assert toxicity.drop_toxic(messy, toxicity.fit(messy, labels.where("1 = 0"))).count() == messy.count()


def _plain(text):
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 16, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                found.append((kind, *m.span()))
    return found


@pytest.mark.parametrize("letters", ["a.@-1 2+()é", "0123456789 -", "12.3.4 5+@ab", "19.+() -"])
def test_detectors_equal_plain_patterns(letters):
    r = random.Random(letters)
    for _ in range(4000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        assert pii.detect(text) == _plain(text), text


def _personal(spark):
    r = random.Random(4)
    pieces = [
        lambda: f"{prose(r.random(), 1).strip('.,')}.{r.randint(10, 99)}@mail{r.randint(1, 9)}.example.com",
        lambda: f"+1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}",
        lambda: ".".join(str(r.randint(1, 254)) for _ in range(4)), lambda: str(r.randint(1900, 2099))]
    rows = [(i, " ".join(r.choice(pieces)() if r.random() < 0.1 else prose(r.random(), 1) for _ in range(40))) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_field_learns_the_detectors_spans(spark):
    docs = _personal(spark)
    by_hand = len(pii.written_table()[0])
    table = pii.labelled_table(docs)
    cut = by_hand + (len(table) - by_hand) * 2 // 3
    field = pii.train(table[:cut])
    got = pii.viterbi(field, [rows for rows, _ in table[cut:]])
    pairs = [(a, b) for (_, want), own in zip(table[cut:], got) for a, b in zip(want, own)]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.99
    assert sum(a == b for a, b in pairs if a) / sum(1 for a, _ in pairs if a) > 0.97


def test_added_spans_touch_no_base_span(spark, messy, empty):
    field = pii.train(pii.labelled_table(_personal(spark)))
    docs = spark.createDataFrame([
        (1, "call (900) 555-2077 or +1 (900) 555-2077."), (2, None), (3, ""), (4, "a@b.co a@b.co"),
        (5, "9" * 30000), (6, "1." * 20000), (7, "a@" * 20000), (None, "ip 10.0.0.1")], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find(docs, field).collect()}
    assert len(rows) == 8
    assert [(s.kind, s.begin, s.end) for s in rows[4].base] == [("email", 0, 6), ("email", 7, 13)]
    assert rows[2].base == rows[2].added == []
    for r in rows.values():
        for a in r.added:
            assert not any(a.begin < b.end and a.end > b.begin for b in r.base)
    masked = {r.doc_id: r.text for r in pii.mask(docs, field).collect()}
    assert masked[4] == "[email] [email]" and masked[None] == "ip [ip]" and masked[2] is None
    named = messy.withColumn("added", F.lit("x")).withColumn("done", F.lit("y")).withColumn("row", F.lit("z"))
    others = [c for c in named.columns if c != "text"]
    same = lambda df: sorted(map(repr, df.select(*others).collect()))
    assert same(pii.mask(named, field)) == same(named) and pii.mask(named, field).columns == named.columns
    assert pii.find(messy, field).count() == messy.count() and pii.find(empty, field).count() == 0
    assert pii.train([]).features == {}


def _random_field(r, n_features):
    return [[r.gauss(0, 1) for _ in range(pii.N_STATES)] for _ in range(n_features)]


def _paths(field, rows):
    """(score, states) of every path, feature by feature."""
    for states in itertools.product(range(pii.N_STATES), repeat=len(rows)):
        score = sum(field.emit[field.features[f], s] for row, s in zip(rows, states) for f in row)
        yield score + sum(field.step[a, b] for a, b in zip(states, states[1:])), list(states)


@pytest.mark.parametrize("seed", range(4))
def test_field_against_enumeration(seed):
    r = random.Random(seed)
    names = [f"f{i}" for i in range(6)]
    field = pii.Field(
        {f: i for i, f in enumerate(names)}, np.array([*_random_field(r, 6), [0.0] * pii.N_STATES]),
        np.array(_random_field(r, pii.N_STATES)))
    rows = [[[r.choice(names) for _ in range(3)] for _ in range(n)] for n in (1, 2, 3, 4, 3)]
    truth = [[r.randrange(pii.N_STATES) for _ in own] for own in rows]
    assert pii.viterbi(field, rows) == [max(_paths(field, own))[1] for own in rows]

    want = 0.0
    for own, states in zip(rows, truth):
        paths = list(_paths(field, own))
        want += np.log(sum(np.exp(score) for score, _ in paths)) - next(s for s, path in paths if path == states)
    seen = sorted({f for own in rows for row in own for f in row})
    number, used, labels, sizes = pii._numbered(list(zip(rows, truth)))
    assert sorted(number) == seen
    emit = np.array([*(field.emit[field.features[f]] for f in seen), [0.0] * pii.N_STATES])
    step = field.step.copy()
    loss, d_emit, d_step = pii._log_loss(used, labels, sizes, emit, step)
    assert loss == pytest.approx(want)
    for value, gradient in ((emit, d_emit), (step, d_step)):
        for _ in range(12):
            i, j = r.randrange(len(value) - (value is emit)), r.randrange(pii.N_STATES)
            value[i, j] += 1e-5
            up = pii._log_loss(used, labels, sizes, emit, step)[0]
            value[i, j] -= 2e-5
            down = pii._log_loss(used, labels, sizes, emit, step)[0]
            value[i, j] += 1e-5
            assert gradient[i, j] == pytest.approx((up - down) / 2e-5, abs=1e-4)


ADDED = [
    ("phone", "Ring 212-555-0187 at noon", "212-555-0187"),
    ("phone", "leave word, (212) 555-0187, for Ada", "(212) 555-0187"),
    ("phone", "Telefon 040 7654321 ab neun", "040 7654321"),
    ("phone", "x=1&n=212-555-0187&y=2", "212-555-0187"),
    ("phone", "電話は212-555-0187です", "212-555-0187"),
    ("email", "write ada (at) engine (dot) net soon", "ada (at) engine (dot) net"),
    ("email", "<td>ada.l[at]engine[dot]net</td>", "ada.l[at]engine[dot]net"),
    ("card", "paid by 5500.0000.0000.0004 then", "5500.0000.0000.0004"),
    ("ip", "host 203[.]0[.]113[.]9 was down", "203[.]0[.]113[.]9"),
]
NOT_ADDED = [
    "on 2023-11-28 and 28-11-2023", "for $2,450.00 or 17.95 each", "release v3.11.4, then 3.11.5", "ISBN 978-0-14-044913-6",
    "from 1980-1995, at 09:45", "sold 212 555 0187 pieces", "paid by 5500.0000.0000.0005 then", "at (noon) and [dusk]",
    "met (at) dawn", "300[.]0[.]113[.]9", "some 1,234,567 of 25 000 000", "order INV-2023-00042 #77", "on 28.11.2023 at 7",
]


def test_field_adds_what_the_detectors_miss(spark):
    field = pii.train(pii.labelled_table(_personal(spark)))
    texts = [t for _, t, _ in ADDED] + NOT_ADDED
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find(docs, field).collect()}
    for i, (kind, text, span) in enumerate(ADDED):
        assert rows[i].base == [] and [(s.kind, text[s.begin:s.end]) for s in rows[i].added] == [(kind, span)], text
    for i, text in enumerate(NOT_ADDED, len(ADDED)):
        assert rows[i].base == rows[i].added == [], text


def test_words_are_read_whole():
    long = "a" * 200
    assert pii.shapes(long + "555-1234") != pii.shapes(long + "555-1235-9") and pii.shapes("x" * 500 + "@y")[1] == "x@x"
    text = "n" * 300 + "=212-555-0187;" + "m" * 300
    assert [text[a:b] for a, b in pii.stretches(text)[0]] == ["n" * 300 + "=", "212-555-0187;", "m" * 300]
    assert sum(map(len, pii.stretches("1 " * 500))) == 500


def test_sampled_look_alikes_are_no_negatives(spark):
    docs = spark.createDataFrame([(i, f"some words 212-555-0{i} here") for i in range(100, 200)], "doc_id long, text string")
    assert len(pii.labelled_table(docs)) == len(pii.written_table()[0])
