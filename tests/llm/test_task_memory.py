"""What a task holds while it counts words or encodes passages follows the slice, not the batch."""

import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StructField

from loomlog.llm import mixing, quality

TEXT = " ".join(f"w{k * 7919 % 5000}" for k in range(5000))


class Caught(Exception):
    pass


def caught(run, schema):
    raise Caught(run)


def peak(run, batch):
    """(MB at most, what it yields) of a task over one batch."""
    tracemalloc.start()
    try:
        out = list(run(iter([batch])))
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_words_are_counted_in_short_slices():
    n = 260                                                        # 7 MB
    with pytest.raises(Caught) as e:
        mixing.count_words(SimpleNamespace(mapInArrow=caught))
    most, out = peak(e.value.args[0], pa.RecordBatch.from_pydict({"text": [TEXT] * n, "train": [k % 2 == 0 for k in range(n)]}))
    assert most < 150
    words = [r for b in out for r in b.to_pylist() if r["size"] == 0]
    assert len(words) == len({r["h"] for r in words}) == 5000      # the slices' counts are put together
    assert all((r["n"], r["train"]) == (n, n // 2) for r in words)


def test_passages_are_encoded_in_short_slices():
    spark = SimpleNamespace(sparkContext=SimpleNamespace(master="none", broadcast=lambda v: SimpleNamespace(value=v)))
    docs = SimpleNamespace(columns=["doc_id"], schema={"doc_id": StructField("doc_id", LongType())},
                           sparkSession=spark, mapInArrow=caught)
    model = quality.Model(0, 1, None, 0.25)
    with pytest.raises(Caught) as e:
        quality.score(docs, model)
    most, out = peak(e.value.args[0], pa.RecordBatch.from_pydict({"doc_id": list(range(70)), "text": [TEXT] * 70}))
    assert most < 60
    assert out[0].column("__score").to_pylist() == [0.25] * 70
