import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from devtide.llm import importance
from devtide.llm.ordering import numbered
from pyspark.sql import functions as F

from . import corpus

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(value: str | None, runs: int = 1) -> list[int]:
    words = WORD.findall(corpus.lowered(value))
    found = [" ".join(words[k : k + n]) for n in range(1, runs + 1) for k in range(len(words) - n + 1)]
    return [zlib.crc32(f.encode()) % importance.BUCKETS for f in found]


def brute(rows: list[tuple], target: list[str], runs: int = 1) -> list[tuple]:
    s = Counter(b for r in rows for b in features(r[1], runs))
    t = Counter(b for x in target for b in features(x, runs))
    out, fit = [], []
    for r in rows:
        found = features(r[1], runs)
        size = importance.BUCKETS
        gain = [
            math.floor(1000 * math.log((t[b] + 1) * (s.total() + size) / ((s[b] + 1) * (t.total() + size)))) for b in found
        ]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(found), weight, score, None])
        if len(WORD.findall(corpus.lowered(r[1]))) >= importance.LEAST_WORDS:
            fit.append(out[-1])
    fit.sort(key=lambda x: (-x[3], x[0] is not None, x[0], x[1]))
    for k, row in enumerate(fit[: len(fit) * importance.SHARE // 100]):
        row[4] = k + 1
    return sorted(map(tuple, out), key=repr)


@given(st.lists(st.tuples(st.binary(max_size=90), st.binary(max_size=90)), min_size=1, max_size=20))
def test_composed_payloads_are_those_of_the_joined_strings(pairs):
    left = np.array([zlib.crc32(a) for a, _ in pairs], np.uint32)
    right = np.array([zlib.crc32(b) for _, b in pairs], np.uint32)
    got = importance.composed(left, right, np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_automaton_words_and_others_have_the_same_payloads(monkeypatch):
    monkeypatch.setattr(importance, "DICTIONARY", 40)
    rng, scanner = random.Random(1), importance.Scanner()
    for _ in range(30):
        words = [w.encode() for w in corpus.words(rng, 300)] + [b"q" * 200] * 3
        rng.shuffle(words)
        crcs, lengths, _ = scanner.payloads(b" " + b"  ".join(words) + b" ")
        assert crcs.tolist() == [zlib.crc32(w) for w in words] and lengths.tolist() == [len(w) for w in words]
    assert scanner.ready and len(scanner.automaton) <= 40


def sample(seed: int, n: int = 150) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(k, corpus.text(rng, rng.randint(0, 60), rng.choice(["aa", "bb"])), "aa", "s", 0) for k in range(10, n)]
    return rows + [rows[-1], (None, corpus.text(rng, 30), None, None, None)] + corpus.edge_rows()


@pytest.mark.parametrize("runs", [1, 3])
def test_against_brute_force(spark, monkeypatch, runs):
    monkeypatch.setattr(importance.shared, "CHUNK_BYTES", 700)
    rows, target = sample(runs), [corpus.text(random.Random(9), 40, "bb"), None, ""]
    docs = corpus.documents(spark, rows, clashing=True).repartition(5)
    bench = spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string")
    got = importance.resampled(docs, bench, runs=runs)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, target, runs)


def test_contract_and_sql(spark, tmp_path):
    rows, target = sample(3), ["KA lo-mi", "tu"]
    folder = corpus.save(corpus.documents(spark, rows), tmp_path)
    bench = spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string")
    corpus.save(bench, tmp_path, "benchmark")
    got = importance.op12_importance_resampling(spark, folder)
    assert {kind for _, kind in got.dtypes} == {"bigint"}
    want = brute(rows, target)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    with duckdb.connect() as con:
        for table in ("documents", "benchmark"):
            con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
        rows = con.sql(importance.ORACLE).select(*got.columns).fetchall()
    assert sorted(rows, key=repr) == want


def test_empty_tables(spark):
    docs = corpus.documents(spark, [])
    assert importance.resampled(docs, docs.select("text")).collect() == []
    one = corpus.documents(spark, [(1, "ka lo", "aa", "s", 0)])
    assert [r.rank for r in importance.resampled(one, docs.select("text")).collect()] == [None]


@pytest.mark.parametrize("key", [None, "g"])
def test_numbers_across_tasks(spark, key):
    """A group that holds most rows spreads over all tasks and is numbered without gaps."""
    rng = random.Random(4)
    rows = [(7 if rng.random() < 0.7 else rng.randint(0, 40), rng.randint(0, 10**6), k) for k in range(4000)]
    df = spark.createDataFrame(rows, "g long, v long, k long")
    got = numbered(df, [F.desc("v"), F.asc("k")], "place", key)
    want = {}
    for g, v, k in sorted(rows, key=lambda r: (-r[1], r[2])):
        want.setdefault(g if key else 0, []).append(k)
    expected = {k: place for ks in want.values() for place, k in enumerate(ks)}
    assert {r.k: r.place for r in got.collect()} == expected
    assert numbered(df.limit(0), [F.asc("v")], "place", key).collect() == []
