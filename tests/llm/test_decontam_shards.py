"""Every scan uses its own patterns, whatever the Python workers scanned before."""

from loomlog.llm import decontam
from test_decontam import DOCS, ITEMS, brute


def scanned(spark, items, shard_bytes):
    docs = spark.createDataFrame([(i, t, 0, "c") for i, t in DOCS], "doc_id long, text string, n_words int, items string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.scan(docs, bench, keep=["doc_id"], shard_bytes=shard_bytes)
    return sorted((tuple(r) for r in decontam.digest(out).collect()), key=str)


def test_shards_first_then_other_benchmarks(spark):
    assert scanned(spark, ITEMS, 150) == brute(DOCS, ITEMS)
    for other in ([(7, "word word word word")], [(8, "another ITEM again"), (9, "x x x")], ITEMS):
        assert scanned(spark, other, 10**9) == brute(DOCS, other)
