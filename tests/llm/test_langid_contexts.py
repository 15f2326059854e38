"""Every three-byte context counts, however many there are and however small its language."""

import math
import random
from collections import Counter

import numpy as np

from loomlog.llm import langid, textbytes


def test_small_language_beside_many_contexts(spark):
    rnd = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    big = ["".join(rnd.choices(letters, k=10_000)) for _ in range(30)]
    tiny = ["żółw łąka żółta", "łąka żółw"]
    df = spark.createDataFrame([(t, "big") for t in big] + [(t, "tiny") for t in tiny], "t string, l string")
    trees = langid.freeze(langid.count_runs(df, "t", "l"))
    counts = {"big": {}, "tiny": {}}
    for lang, texts in (("big", big), ("tiny", tiny)):
        for t in texts:
            b = bytes(3) + t.encode()
            for k in range(3, len(b)):
                for n in range(4):
                    counts[lang].setdefault(b[k - n:k], Counter())[b[k]] += 1
    assert len({c for lang in counts.values() for c in lang if len(c) == 3}) > 40_000

    def prob(lang, context, s):
        c = counts[lang].get(context)
        lower = (lambda v: 1 / 256) if context == b"" else (lambda v: prob(lang, context[1:], v))
        if not c:
            return lower(s)
        n, d = sum(c.values()), len(c)
        return c[s] / (n + d) if s in c else d / (n + d) * lower(s) / (1 - sum(lower(v) for v in c))
    for text in ("łąka żółta", "żółw", "abc łą", big[0][:60]):
        b = text.encode()
        s = textbytes.Slice(0, 1, np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        line = bytes(3) + b
        want = [-sum(math.log2(prob(lang, line[k - 3:k], line[k])) for k in range(3, len(line))) for lang in ("big", "tiny")]
        assert np.allclose(langid.code_lengths(trees, s)[0], want, rtol=1e-4, atol=1e-2)
