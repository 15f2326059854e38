"""What the pipeline's stages must not leave behind."""

import random

import pytest

import corpus_pipeline
from loomlog.llm import neardup
from test_neardup import brute, edited, got

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_near_duplicate_stage_links_from_080(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = {i for i, _, _, keep in brute(texts, 80) if keep}
    assert len(kept) < sum(keep for *_, keep in brute(texts, 85))
    assert rows(STAGE["near_duplicates"](spark, docs, SF)) == [r for r in rows(docs) if r[0] in kept]


@pytest.mark.parametrize("percent", [80, 85])
def test_thresholds_against_brute_force(spark, percent):
    assert abs(neardup.far_at(percent) - (neardup.NEAR + 1 - percent / 100)) < 1e-12
    rnd = random.Random(percent)
    vocab = [f"w{k}" for k in range(3000)]
    base = [rnd.choice(vocab) for _ in range(120)]
    family = [edited(rnd, base, rnd.randrange(0, 11)) for _ in range(60)]
    data = [(k, t) for k, t in enumerate(family)]
    data += [(100 + k, edited(rnd, family[k].split(), rnd.randrange(1, 5))) for k in range(40)]
    assert got(spark, data, percent=percent) == brute(data, percent)


def test_line_stage_takes_out_passages_spread_over_sources(spark):
    def line(tag, n):
        return " ".join(f"{tag}{k}" for k in range(n))
    passage, shorter, rare, whole = line("p", 60), line("s", 50), line("r", 60), line("w", 70)
    data = []
    for k in range(400):                                           # 20 sources of 20
        text = [line(f"own{k}x", 60), line(f"end{k}x", 8)]
        if k % 20 == 7 or k in (0, 1):
            text.insert(1, f" {passage} ")
        if 30 <= k < 36:
            text.append(shorter)
        if k in (11, 222, 333):                                    # on three documents: below the least
            text.append(rare)
        data.append((k + 5, "\n".join(text), "en", f"src{k % 20 if k % 20 != 7 else k // 20}", 1))
    data += [(1000 + k, whole, "en", f"src{k}", 1) for k in range(6)]
    data += [(None, passage + "\nno id", "en", "src1", 1), (None, None, None, None, None), (5, data[0][1], "en", "src0", 1)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    out = STAGE["lines"](spark, spark.createDataFrame(data, schema).repartition(5), SF).collect()
    want = []
    for i, t, _, _, _ in data:
        want.append((i, t if t is None or i == 5 else t.replace(f" {passage} \n", "").replace(passage + "\n", "")))
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(want, key=str)
    assert sum(passage in t for _, t in want if t) == 2            # the repeated row of the smallest id
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out)
