"""Near-dedup against brute force: all pairs, full sets."""

import random
import re

import pytest

from loomlog.llm import neardup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(SMALL))
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, s) in enumerate(sets):
        if s:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)] if s else i, i == (least[find(k)] if s else i)) for k, (i, s) in enumerate(sets))


def got(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, n int")
    found = neardup.near_duplicates(docs.repartition(3), **more).select("doc_id", "n_shingles", "component_id", "kept")
    return sorted(tuple(r) for r in found.collect())


def edited(rnd, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"e{rnd.randrange(10**9)}"
    return " ".join(out)


def test_groups_chains_and_passages(spark):
    rnd = random.Random(4)
    vocab = [f"w{k}" for k in range(3000)]
    base = [rnd.choice(vocab) for _ in range(120)]
    rows = [(100 + k, edited(rnd, base, rnd.randrange(0, 7))) for k in range(90)]       # one family, many not linked with its hub
    chain = [rnd.choice(vocab) for _ in range(100)]
    for k in range(25):                                                                   # a chain: ends far apart
        rows.append((300 + k, " ".join(chain)))
        chain = chain[2:] + [f"c{k}a", f"c{k}b"]
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    rows += [(400 + k, passage + " " + " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(0, 80)))) for k in range(60)]
    pair = edited(rnd, base, 6).split()                                                   # linked with each other, not with the family
    rows += [(500, " ".join(pair)), (501, edited(rnd, pair, 1)), (502, edited(rnd, pair, 1))]
    rows += [(600, "Same  words\there"), (601, "same words here"), (602, "same words"), (603, "A"), (604, "a")]
    rnd.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (6, "x " * 5), (7, "x " * 500), (8, "  é"), (9, "  é")]
    assert got(spark, rows) == brute(rows)
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (0, "A B")], "doc_id long, text string")
    assert sorted((r["doc_id"] is None, r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()) == [
        (False, 0, 0, True), (False, 1, 0, False), (False, 1, 0, False), (True, None, None, True)]
    assert neardup.near_duplicates(docs.where("false")).count() == 0


def test_long_text(spark):
    rnd = random.Random(1)
    words = [f"w{rnd.randrange(5000)}" for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, edited(rnd, words, 300)), (3, edited(rnd, words, 3000))]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("links", [[(1, 2), (2, 3), (9, 8), (5, 5)], [(k, k + 1) for k in range(40)], []])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    root = {x: x for p in links for x in p}
    for _ in links:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {r["id"]: r["label"] for r in neardup.components(df).collect()} == root


def test_long_lists_of_differences_are_not_paired(spark, monkeypatch):
    """A family whose hub is an outlier: all its members share what sets them apart from the hub."""
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(60):
        words = list(base)
        words[7 * k % 300] = f"own{k}"
        if k == 0:
            words[100:108] = [f"far{j}" for j in range(8)]
        rows.append((k, 296, [" ".join(words[j:j + 5]) for j in range(296)]))
    hash_of = {s: 2 * k for k, s in enumerate(sorted({s for _, _, w in rows for s in w}))}
    sets = {k: {hash_of[s] for s in w} for k, _, w in rows}
    met = []
    for k in range(1, 60):
        hub, own = sets[0], sets[k]
        both = len(hub & own)
        # only every fourth is given as linked with the hub: the others have to be found through their differences
        met.append((0, k, both, len(hub), len(own), k % 4 == 0, sorted([e for e in own - hub] + [e | 1 for e in hub - own])))
    near = spark.createDataFrame(met, "hub long, id long, both long, n_hub long, n_id long, link boolean, apart array<long>")
    links = [tuple(r) for r in neardup._between(near, 85).collect()]
    reached, found = {k for k in range(1, 60) if k % 4 == 0}, set()
    for a, b in links:
        both = len(sets[a] & sets[b])
        assert 100 * both >= 85 * len(sets[a] | sets[b])
    while reached != found:
        found = set(reached)
        reached |= {x for a, b in links for x in (a, b) if a in found or b in found}
    assert reached == set(range(1, 60))
    assert len(set(links)) < 4 * 60                                # not the square
