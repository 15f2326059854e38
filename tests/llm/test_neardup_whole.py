"""Links that no round of inverted lists brings together."""

import random

import pyarrow as pa

from loomlog.llm import neardup
from loomlog.llm import textbytes as B
from test_neardup import brute, got


def codes(words, size=5):
    """Hash of each shingle, in the order of the text."""
    return [int(neardup._sets(next(B.slices(pa.array([" ".join(words[k:k + size])]))), size)[0][0]) for k in range(len(words) - size + 1)]


def hidden_pair(rnd, tag):
    """Texts of 7 and 6 shingles (Jaccard 6/7).  In hash order the seventh lies between two
    halves that are neighbours in the text; for each half three templates of 7 shingles hold
    its three as neighbouring values and, through fillers, are the most central of their lists."""
    while True:
        words = [f"{tag}{rnd.randrange(10**6)}" for _ in range(11)]
        h = codes(words)
        ranks = [sorted(h).index(x) for x in h]
        if ranks[6] == 3 and {frozenset(ranks[:3]), frozenset(ranks[3:6])} == {frozenset((0, 1, 2)), frozenset((4, 5, 6))}:
            break
    texts = [" ".join(words), " ".join(words[:10])]
    for part in (words[:7], words[3:10]):
        for fillers in (40, 30, 20):
            while True:
                tail = [f"{tag}t{rnd.randrange(10**6)}" for _ in range(4)]
                t = codes(part + tail)
                at = sorted(sorted(t).index(x) for x in t[:3])
                if at[2] - at[0] == 2:
                    break
            texts.append(" ".join(part + tail))
            texts += [" ".join([part[6], *tail, *(f"{tag}f{rnd.randrange(10**9)}" for _ in range(6))]) for _ in range(fillers)]
    return texts


def test_short_templated_texts(spark):
    rnd = random.Random(5)
    texts = hidden_pair(rnd, "a") + hidden_pair(rnd, "b")
    data = list(enumerate(texts))
    want = brute(data)
    assert sum(not keep for *_, keep in want) == 2
    assert got(spark, data) == want
