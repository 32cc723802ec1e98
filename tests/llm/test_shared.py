import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from devtide.llm import bpe, shared

from . import corpus


def test_slices_are_the_whole_batch(monkeypatch):
    monkeypatch.setattr(shared, "CHUNK_BYTES", 50)
    texts = ["a" * (k * 7 % 90) for k in range(40)] + [None, "", "b" * 500]
    batch = pa.RecordBatch.from_pydict({"k": range(len(texts)), "text": texts}).slice(3)
    parts = list(shared.slices(batch))
    assert len(parts) > 20
    assert pa.Table.from_batches([part for part, _ in parts]) == pa.Table.from_batches([batch])
    for part, own in parts:
        assert own.to_pylist() == [t or "" for t in part["text"].to_pylist()]
    assert list(shared.slices(batch.slice(0, 0))) == []


def test_a_coded_batch_leaves_in_slices(spark, monkeypatch):
    """What a worker makes at once is bounded by the bytes of text, not by the rows of a batch."""
    rng = random.Random(3)
    rows = [(k, corpus.text(rng, 400), "aa", "s", 0) for k in range(60)]
    docs = corpus.documents(spark, rows).coalesce(1)
    made = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, run, schema: made.append(run) or df)
    bpe.round_trip(docs, bpe.public_vocabulary())
    monkeypatch.setattr(shared, "CHUNK_BYTES", 5000)
    texts = pa.array([r[1] for r in rows])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    found = list(made[0](iter([batch])))
    assert max(b.num_rows for b in found) < 10
    assert pa.Table.from_batches(found)["decoded"].to_pylist() == texts.to_pylist()


def test_arrays_are_folded_in_a_tree_by_workers_of_one_kind(spark, monkeypatch):
    monkeypatch.setattr(shared, "FAN", 3)
    rows = [(np.arange(5, dtype=np.int64) * k).tobytes() for k in range(25)]
    parts = spark.createDataFrame([(r,) for r in rows], "part binary").repartition(11)
    want = (np.arange(5) * sum(range(25))).tolist()
    assert shared.tree_sum(parts, "part", "int64", 5).tolist() == want
    packed = spark.createDataFrame([(zlib.compress(r),) for r in rows], "part binary").repartition(11)
    start = np.zeros(5, np.int64)

    def refused(*_):
        raise AssertionError("RDD workers stay beside those of DataFrames")

    for name in ("treeAggregate", "map", "mapPartitions", "reduce", "collect"):
        monkeypatch.setattr("pyspark.RDD." + name, refused)
    assert shared.tree_fold(packed, "part", start, np.add, packed=True).tolist() == want
    assert shared.tree_fold(packed.filter(F.lit(False)), "part", start, np.add, packed=True).tolist() == [0] * 5
