"""op3: steps that are made once, and turns that end."""

import random

from loomlog.llm import neardup
from test_neardup import brute, got


def names_of(monkeypatch):
    names, real = [], neardup.written

    def spy(df, name):
        names.append(name)
        return real(df, name)

    monkeypatch.setattr(neardup, "written", spy)
    return names


def test_texts_are_found_once_for_all_rounds(spark, monkeypatch):
    rnd = random.Random(7)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(40):                                           # far from each other, but lists hold several of them
        words = list(base)
        for at in rnd.sample(range(12), 6):
            words[at * 5] = f"x{k}-{at}"
        texts.append(" ".join(words))
    data = list(enumerate(texts + [texts[3] + " end"]))
    names = names_of(monkeypatch)
    assert got(spark, data) == brute(data)
    assert names.count("dup-verified") > 1
    assert names.count("dup-ids") == 1


def test_turns_end_where_one_connects_few(spark, monkeypatch):
    hub = set(range(0, 2000, 2))
    met = []
    for k in range(1, 61):                                        # all lack the same 40, and have 200 of their own: none are linked
        s = hub - {2 * j for j in range(40)} | {100_000 * k + 2 * j for j in range(200)}
        met.append((0, k, len(hub & s), len(hub), len(s), k % 4 == 0, sorted([e for e in s - hub] + [e | 1 for e in hub - s])))
    near = spark.createDataFrame(met, "hub long, id long, both long, n_hub long, n_id long, link boolean, apart array<long>")
    names = names_of(monkeypatch)
    assert neardup._between(near, 85).collect() == []
    assert names.count("dup-centred") == 1
