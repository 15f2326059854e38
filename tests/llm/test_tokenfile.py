"""Simple-8b round trips, the chunk-wise encoder, and the file's digest."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomlog.llm import tokenfile as T

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\n", "don't I'll you're 'S x'T", "Ünïcödé É é ́x", "İstanbul ŒUVRE ß ﬁ ǅ", "a.b,c ... ?! -- (x)", "1234 5a6 ½ ²",
       "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "日本語 テスト。 😀😀x", "a\x1cb\x85c d e　f\tg\x0bh\x0ci", "`   Å K",
       "ʼn ŉ 'ŉ", "x" * 3000, "é" * 500 + ".,", "a̸= ≠", "ÀÉ.,;", "ａｂｃ．", "_a_ ^b` {c}", "Σας ΣΑΣ"]


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=400))
@settings(max_examples=150, deadline=None)
def test_round_trip(values):
    ids = np.array(values, np.uint64)
    words = T.pack(ids)
    assert np.array_equal(T.unpack(words), ids)
    first = T._first_ids(words)[2]
    assert np.array_equal(T.word_index(words), first[::T.STRIDE].astype(np.uint32))


def test_long_runs_and_density():
    zeros = np.zeros(1000, np.uint64)
    assert len(T.pack(zeros)) <= 12 and np.array_equal(T.unpack(T.pack(zeros)), zeros)
    ids = np.random.default_rng(0).integers(0, 1000, 6000).astype(np.uint64)
    assert len(T.pack(ids)) == 1000                               # six 10-bit ids a word


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_chunks_encode_as_whole_texts(text):
    _same([text])


WHOLE, ENCODER = Tokenizer.from_file(PATH), T.Encoder(PATH)


def _same(texts):
    whole, encoder = WHOLE, ENCODER
    for t in texts:
        raw = t.encode("utf-8", "surrogatepass") if t.isprintable() else t.encode("utf-8", "ignore")
        t = raw.decode("utf-8", "ignore")
        got, _ = encoder.encode([*encoder.chunks(t.encode()), b""])
        assert got.tolist() == [*whole.encode(t, add_special_tokens=False).ids, 2], repr(t)


def test_odd_texts():
    _same(ODD)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(T, "CACHED_WORDS", 5)
    monkeypatch.setattr(T, "CACHED_CHUNKS", 5)
    _same([f"w{i} x{i}. y{i}" for i in range(50)])


def brute(rows):
    whole, out, at = WHOLE, {}, 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        out.setdefault(doc_id, []).append((at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_digest(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 50)
    rows = [(i * 7 % 31, t, "x") for i, t in enumerate(ODD * 3)][:31] + [(100, None, "y"), (None, "null id", "z"), (5000, "a b " * 3000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string").repartition(3)
    got = {}
    for r in T.encoded(docs, PATH).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], r["ids_crc32"]))
    assert got == brute([(r[0], r[1]) for r in rows])


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "")], "doc_id long, text string")
    got = sorted(tuple(r)[:3] for r in T.encoded(docs, PATH).collect())
    assert [g[1] for g in got] == [0, 2, 4] and [g[2] for g in got] == [2, 2, 1]
    assert T.encoded(docs.where("false"), PATH).count() == 0


@pytest.mark.parametrize("bad", [b"\xff"])
def test_chunk_of_odd_bytes_is_not_expected(bad):
    with pytest.raises(UnicodeDecodeError):                       # Spark strings are valid UTF-8
        T.Encoder(PATH).encode([bad])
