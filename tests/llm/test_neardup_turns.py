"""op3: what a turn finds goes to members, whatever the number of their differences."""

import random

from loomlog.llm import neardup
from test_neardup import brute, got


def test_turns_join_one_row_a_member(spark, monkeypatch):
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(60)]
    texts = []
    for k in range(40):                                           # near the hub, linked with some of the others only
        words = list(base)
        for at in rnd.sample(range(12), 1 + k % 3):
            words[at * 5] = f"x{at}"
        texts.append(" ".join(words))
    data = list(enumerate(texts))
    tables = []
    real = neardup.written

    def spy(df, name):
        out = real(df, name)
        if name == "dup-differences":
            tables.append(out)
        return out

    monkeypatch.setattr(neardup, "written", spy)
    assert got(spark, data) == brute(data)
    assert tables
    for t in tables:
        assert t.count() == t.select("hub", "id").distinct().count()
