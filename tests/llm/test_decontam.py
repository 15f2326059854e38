"""Decontamination against brute force, shards, and offsets."""

import hashlib
import re

from loomlog.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(SMALL))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for item, text in items:
            v = words(text)
            if item is None or not v:
                continue
            for k in range(max(1, len(v) - 12)):
                x = v[k:k + 13]
                for j in range(len(w) - len(x) + 1):
                    if w[j:j + len(x)] == x:
                        hit.update(range(j, j + len(x)))
                        names.add(str(item))
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


LONG = " ".join(f"w{k % 17} v{k}" for k in range(20))
ITEMS = [(1, LONG), (2, "Short, item!"), (3, LONG), (10, ""), (11, None), (12, "..."), (20, "x x x x x x x x x x x x x x"), (None, "null id"), (2, "Short, item!"),
         (30, "É été 99 ça")]
DOCS = [(1, "before " + LONG.upper() + " after"), (2, "a short   ITEM, again"), (3, "shorty item"), (4, None), (5, ""), (6, "x " * 40),
        (7, "word " * 400 + "short item"), (8, LONG[:60]), (9, "éÉ é été 99 ça É été-99:ça"), (None, "short item"), (2, "a short   ITEM, again"),
        (11, "long " * 50_000 + LONG)]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 0, "c") for i, t in DOCS], "doc_id long, text string, n_words int, items string")
    bench = spark.createDataFrame([(i, t, "e") for i, t in ITEMS], "item_id long, text string, doc_id string")
    want = brute(DOCS, ITEMS)
    for shard_bytes in (10**9, 150):
        scanned = decontam.scan(docs, bench, keep=["doc_id"], shard_bytes=shard_bytes)
        assert sorted((tuple(r) for r in decontam.digest(scanned).collect()), key=str) == want


def test_spans_are_original_characters(spark):
    docs = spark.createDataFrame([(1, "Ünï (Short  -- ITEM) ü short.item")], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    r = decontam.scan(docs, bench).first()
    assert [r["text"][s["start"]:s["end"]] for s in r["spans"]] == ["Short  -- ITEM", "short.item"]
    assert r["items"] == ["2"] and r["n_hit"] == 4


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.digest(decontam.scan(docs.where("false"), bench)).count() == 0
    r = decontam.digest(decontam.scan(docs, bench.where("false"))).first()
    assert (r["n_words"], r["n_hit"], r["contaminated"]) == (2, 0, False)
