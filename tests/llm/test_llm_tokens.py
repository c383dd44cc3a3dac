"""Encoders and the wavelet store against the tokenizers library and plain arrays."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyledger.llm import bpe, queries, wavelet

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(WORD)
ODD = "abcdeThionsé ÄßΣσİ123'!<|>/w.,-_ñ日本 \t\n\x1c\u0107ﬁ½²\xa0"


@pytest.fixture(scope="module")
def coder():
    return bpe.WordBpe(WORD)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ODD, max_size=60))
def test_encoder_equals_library(text):
    coder, library = bpe.load(WORD), LIBRARY
    want = library.encode(text, add_special_tokens=False).ids
    assert coder.encode(text) == want
    assert coder.decode(want) == library.decode(want, skip_special_tokens=False)




@pytest.mark.parametrize("text", [
    "a<|endoftext|>b <|startoftext|><|endoftext|>", "", "x" * 5000, "the" * 3000, "'LL aaa'll", "</w></w>", "\x00\x1f"])
def test_encoder_on_special_texts(coder, library, text):
    assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_query_equals_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_backtracking_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encoding_keeps_rows_and_columns(messy, empty, library):
    out = bpe.encode_documents(messy, WORD)
    assert "shard" in out.columns and out.columns.count("ids") == 1
    rows = out.collect()
    assert len(rows) == messy.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
    assert bpe.encode_documents(empty, WORD).count() == 0


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (511, 3), (512, 200), (5000, 50000)])
def test_matrix_access_count_select(n, top):
    rng = np.random.default_rng(n)
    values = (rng.pareto(1, n) * 3 % top).astype(np.uint16)
    matrix = wavelet.TokenMatrix.from_bytes(wavelet.TokenMatrix.build(values).to_bytes())
    assert matrix.values().tolist() == values.tolist()
    for i in rng.integers(0, n, 50) if n else []:
        assert matrix.access(int(i)) == values[i]
    for token in {*values[:20].tolist(), 60000}:
        places = np.flatnonzero(values == token)
        assert matrix.count(token) == len(places)
        assert matrix.count(token, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
        for k in range(0, len(places), max(1, len(places) // 7)):
            assert matrix.select(token, k) == places[k]
        with pytest.raises(IndexError):
            matrix.select(token, len(places))


def test_byte_coder_equals_library():
    coder = wavelet._Coder(BYTE)
    r = random.Random(3)
    letters = "ab  \n\t\r'sTé.,1 \xa0日<|endoftext|>\x1c"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    for text in [*texts, "<|endoftext|>", " <|endoftext|> a", "a <|endoftext|>", "  a", "a  ", " "]:
        want = coder.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), coder.kind).tolist() == want, text


def test_shards_round_trip(spark, messy, empty, monkeypatch):
    monkeypatch.setattr(wavelet, "MIN_RANGES", 5)
    library = Tokenizer.from_file(BYTE)
    folder = wavelet.write_shards(messy, BYTE, 2)
    rows = wavelet.read_documents(spark, folder).collect()
    texts = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in messy.collect()), key=lambda r: r[:2])
    assert len(rows) == len(texts)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [t[1] if t[0] else None for t in texts]
    start = 0
    for r in rows:
        assert r.start == start and len(r.ids) == 4 * r.n_ids
        start += r.n_ids
    want = {(t[1] if t[0] else None, zlib.crc32(np.array([*library.encode(t[2]).ids, 2], "<u4").tobytes())) for t in texts}
    assert {(r.doc_id, zlib.crc32(r.ids)) for r in rows} == want
    found = wavelet.find(spark, folder, 2).agg({"n": "sum"}).first()[0]
    assert found >= len(texts)
    assert wavelet.read_documents(spark, wavelet.write_shards(empty, BYTE, 2)).count() == 0


def test_each_word_is_coded_once(monkeypatch):
    """Chunks that differ only in their marks, of letters of two bytes and a capital sigma, share the work on their words."""
    coder = bpe.WordBpe(WORD)
    asked = []
    plain = coder.encode_word
    monkeypatch.setattr(coder, "encode_word", lambda word: asked.append(word) or plain(word))
    texts = ["Schön schön, schön. (SCHÖN) ΟΔΟΣ ΟΔΟΣ. οδοσ!"]
    ids, decoded = bpe._code(texts, bpe._Known(coder))
    whole = LIBRARY
    expected = whole.encode(texts[0], add_special_tokens=False).ids
    assert np.frombuffer(ids[0], np.int32).tolist() == expected and decoded == [whole.decode(expected, skip_special_tokens=False)]
    assert len(asked) == len(set(asked))


def test_words_are_coded_side_by_side(coder, library, monkeypatch):
    """Words of a part are coded in one call, those that step back among them; a table that is emptied changes nothing."""
    calls = []
    plain = coder.encode_words
    monkeypatch.setattr(coder, "encode_words", lambda words: calls.append(len(words)) or plain(words))
    monkeypatch.setattr(bpe, "WORD_ENTRIES", 500)
    r = random.Random(5)
    letters = "aaabcdeenrsttth.,'1!é\u0301ΣςßİñÄ日<|>\x1c\x85\n  "
    known = bpe._Known(coder)
    for size in (0, 1, 400):
        texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 90))) for _ in range(size)]
        texts += ["", " ", "x" * 300 + " the" * 3, "a<|endoftext|>b <|endoftext|>"]
        before = len(calls)
        ids, decoded = bpe._code(texts, known)
        assert len(calls) <= before + 2
        for text, own, back in zip(texts, ids, decoded, strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(own, np.int32).tolist() == want, text
            assert back == library.decode(want, skip_special_tokens=False)
    words = ["".join(r.choice("aeinrstth") for _ in range(r.randint(1, 60))) for _ in range(3000)]
    assert [np.frombuffer(x, np.int32).tolist() for x in plain(words)] == [coder.encode_word(w) for w in words]


def test_texts_of_a_part_are_coded_together(monkeypatch):
    """A word that many texts hold is learned once; blanks that meet, odd letters and an emptied table change nothing."""
    coder = wavelet._Coder(BYTE)
    asked = []
    plain = coder._learn
    monkeypatch.setattr(coder, "_learn", lambda new: asked.extend(new) or plain(new))
    texts = ["one two, two,", "two, one", "", " ", "two,  one", "one\n two,", "日本 two, <|endoftext|> one", "-two, x-1 x-1"] * 3
    want = [coder.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, coder.kind).tolist() for x in coder.encode_all(pa.array(texts))] == want
    assert len(asked) == len(set(asked))
    monkeypatch.setattr(wavelet, "CACHE_ENTRIES", 3)
    for part in (texts[:5], texts[5:], []):
        got = [np.frombuffer(x, coder.kind).tolist() for x in coder.encode_all(pa.array(part, pa.string()))]
        assert got == [coder.library.encode(t, add_special_tokens=False).ids for t in part]


def test_tables_of_the_coder_stay_small(coder):
    """What a worker keeps of 20,000 distinct chunks: some 200 bytes each, no second table and no decoded texts."""
    r = random.Random(9)
    texts = [" ".join("".join(r.choice("abdeinorst") for _ in range(9)) + r.choice([".", ","]) for _ in range(1000)) for _ in range(20)]
    known = bpe._Known(coder)
    bpe._code(texts[:1], known)
    tracemalloc.start()
    bpe._code(texts[1:], known)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 19_000 * 250


def test_chunks_of_letters_are_not_cut(monkeypatch):
    """A chunk of letters alone is one word; the ids are the library's, also where the table is emptied in between."""
    coder, cut = wavelet._Coder(BYTE), []
    plain = coder._plain
    monkeypatch.setattr(coder, "_plain", lambda chunks: cut.extend(chunks) or plain(chunks))
    texts = ["so hello wörld été it's a.b x1 hello ǃ 中文 st", "", "a b  c\tword× end ", "ª º µ ɏ abc"]
    library = Tokenizer.from_file(BYTE)
    for entries in (wavelet.CACHE_ENTRIES, 2):
        monkeypatch.setattr(wavelet, "CACHE_ENTRIES", entries)
        for text, got in zip(texts, coder.encode_all(pa.array(texts))):
            assert np.frombuffer(got, coder.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    assert {"it's", "a.b", "x1", "word×"} & set(cut) and not {"hello", "wörld", "été", "ǃ", "ɏ", "abc"} & set(cut)
