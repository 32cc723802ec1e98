import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from devtide.llm import secret_scan

from . import corpus
from .test_ngram_join import brute

COLUMNS = [part.split()[0] for part in corpus.SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two languages, copies and near copies, leaks, secrets, and texts without a letter."""
    path = tmp_path_factory.mktemp("pipeline")
    rng = random.Random(21)
    items = [(k, corpus.text(rng, 30)) for k in range(4)]
    rows = []
    for k in range(80):
        lang = ("aa", "bb")[k % 2]
        own = corpus.words(rng, rng.randint(40, 90), lang)
        if k % 10 == 3:
            own = own[:20] + items[k % 4][1].split() + own[20:]
        if k % 10 == 4:
            own.insert(5, f'token = "{rng.getrandbits(128):032x}"')
        rows.append((k, " ".join(own), lang, "s", 0))
        if k % 8 == 0:
            rows.append((100 + k, " ".join(own), lang, "s", 0))
            rows.append((200 + k, " ".join([*own, "more"]), lang, "s", 0))
    rows += [(300, None, "aa", "s", 0), (301, "", "bb", "s", 0), (302, "123 456", "aa", "s", 0)]
    corpus.save(corpus.documents(spark, rows), path)
    corpus.save(spark.createDataFrame(items, "item_id long, text string"), path, "benchmark")
    return str(path), rows, items


def expected(rows, items):
    """By plain Python: letters, all pairs, containment, the same patterns, the library."""
    scanner = secret_scan.Scanner(*secret_scan.public_ranks())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    first = {i for i, _, c in brute(rows) if i == c}
    rows = [r for r in rows if r[0] in first]
    rows = [r for r in rows if not any(text in r[1] for _, text in items)]
    out = {}
    for number, text, *_ in rows:
        for a, b, _ in reversed([s for s in scanner.spans(text) if s[2] == "assign"]):
            text = text[:a] + "[SECRET]" + text[b:]
        out[number] = library.encode(text, add_special_tokens=False).ids
    return out


def test_run_equals_brute_force(spark, folder):
    path, rows, items = folder
    got = corpus_pipeline.run(spark, path).collect()
    want = expected(rows, items)
    assert {r["doc_id"]: r["ids"] for r in got} == want and len(got) == len(want)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_stages_return_documents(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_join", "decontamination", "secret_scan", "bpe",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == COLUMNS


def test_an_empty_table_passes_through(spark, folder, tmp_path):
    corpus.save(corpus.documents(spark, []), tmp_path)
    corpus.save(spark.createDataFrame([], "item_id long, text string"), tmp_path, "benchmark")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_clashing_columns_stay(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("node", F.lit(1)).withColumn("a", F.lit(2))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
