"""Prefix tables of byte-level BPE against the tokenizer library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from loomlog.llm import prefixbpe as B
from loomlog.llm import queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = B.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = B.Coder(RANKS)
ODD = ["", " ", "\n\n \t x", "don't I'll we've 'S", "Ünïcödé É é ́x", "日本語 テスト。😀😀", "a\x1cb\x85c d　e", "<|endoftext|>", "1234 ½ ²",
       "x" * 3000, " " * 500 + "y", "=" * 700, "ab" * 400 + "\r\n" * 90, "ʼn İstanbul ß ﬁ"]
ALPHABET = st.lists(st.sampled_from([*"aetnr shio'\n0l.é=", "th", "ing ", "  ", "日"]), max_size=40).map("".join)


def whole(data: bytes) -> list[int]:
    return LIBRARY._core_bpe.encode_single_piece(data) if data else []


@given(ALPHABET)
@settings(max_examples=300, deadline=None)
def test_every_prefix(text):
    data = text.encode()
    table = B.Prefixes(CODER, data)
    for k in range(len(data) + 1):
        assert table.ids(k) == whole(data[:k])


@given(ALPHABET, ALPHABET, st.data())
@settings(max_examples=200, deadline=None)
def test_appends_and_edits_of_a_piece(text, new, data):
    table = B.Prefixes(CODER, text.encode())
    before = list(table.last)
    table.append(new.encode())
    assert table.last[:len(before)] == before and table.ids() == whole((text + new).encode())
    raw = table.data
    lo = data.draw(st.integers(0, len(raw)))
    hi = data.draw(st.integers(lo, len(raw)))
    table.replace(lo, hi, b"xq the")
    assert table.data == raw[:lo] + b"xq the" + raw[hi:] and table.ids() == whole(table.data)


def test_an_edit_works_near_itself_only():
    rnd = random.Random(4)
    raw = "".join(rnd.choice("abcdefgh ") for _ in range(20_000)).encode()
    table = B.Prefixes(CODER, raw)
    assert table.replace(5000, 5003, b"zz") < 3 * CODER.longest
    assert table.last == B.Prefixes(CODER, table.data).last


@given(ALPHABET, ALPHABET, st.data())
@settings(max_examples=200, deadline=None)
def test_appends_and_edits_of_a_text(text, new, data):
    tokens = B.TextTokens(CODER, public_tokenizers.PATTERN, text)
    assert tokens.ids() == LIBRARY.encode_ordinary(text)
    tokens.append(new)
    assert tokens.ids() == LIBRARY.encode_ordinary(text + new)
    now = tokens.text
    lo = data.draw(st.integers(0, len(now)))
    hi = data.draw(st.integers(lo, len(now)))
    tokens.replace(lo, hi, " 're  ")
    assert tokens.text == now[:lo] + " 're  " + now[hi:] and tokens.ids() == LIBRARY.encode_ordinary(tokens.text)
    assert tokens.ends[-1:] == [len(tokens.text)]


def test_a_text_edit_keeps_the_pieces_far_away():
    text = "some words here, " * 2000
    tokens = B.TextTokens(CODER, public_tokenizers.PATTERN, text)
    assert tokens.replace(9000, 9004, "XY") < 10 and tokens.ids() == LIBRARY.encode_ordinary(tokens.text)


def test_caches_turn_over(monkeypatch):
    monkeypatch.setattr(B, "CACHED_PIECES", 5)
    monkeypatch.setattr(B, "CACHED_PAIRS", 20)
    pieces, coder = B._Pieces(B.Coder(RANKS)), random.Random(1)
    for _ in range(300):
        piece = "".join(coder.choice("thezq") for _ in range(coder.randint(1, 4)))
        assert list(pieces[piece]) == whole(piece.encode())
        assert len(pieces) <= 5 and len(pieces.before) <= 5


def test_pieces_learnt_together():
    texts = [["the", " theory", " theories", "théo", "x" * 60, ""], [" theory", " q", "日本"]]
    pieces = B._Pieces(CODER)
    pieces.learn(texts)
    assert all(list(pieces[p]) == whole(p.encode()) for text in texts for p in text)


def test_ranks_without_a_byte():
    with pytest.raises(ValueError, match="lacks a byte"):
        B.Coder({b"a": 0, b"ab": 1}).ids(b"ba")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = [(k, text, "x", [7], b"z") for k, text in enumerate([*ODD, None, "long text. " * 40_000])] + [(None, "no id", "x", None, None)]
    rows += [rows[3], rows[3]]
    folder = str(tmp_path_factory.mktemp("bpe"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, ids array<int>, decoded binary") \
        .repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_query_against_the_library(spark, stored):
    folder, rows = stored                                          # columns named ids and decoded are there already
    want = []
    for k, text, *_ in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in queries.op11(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    ids = B.encode(none, PATH, public_tokenizers.PATTERN)
    assert ids.collect() == [] and B.decode(ids, PATH).collect() == []
    some = spark.createDataFrame([(1, None), (2, []), (3, [0, 50255])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in B.decode(some, PATH).collect()}
    assert got == {1: b"", 2: b"", 3: LIBRARY.decode_bytes([0, 50255])}
    with pytest.raises(ValueError, match="both kept and made"):
        B.encode(some.withColumn("text", some.doc_id.cast("string")), PATH, public_tokenizers.PATTERN, keep=["ids"])


def test_sf_table(spark):
    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: hashlib.sha256(" ".join(map(str, LIBRARY.encode_ordinary(r.text or ""))).encode()).hexdigest()
            for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.REGISTRY["op11_byte_bpe"][0](spark, sf).collect()
    assert {r.doc_id: r.ids_sha256 for r in got} == want and len(got) == len(want)
