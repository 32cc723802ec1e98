import random
import re

import pytest

from devtide.llm import ngram_join
from devtide.llm.components import components

from . import corpus


def shingles(value):
    found = re.findall(corpus.SPACE, corpus.lowered(value))
    if not found:
        return set()
    if len(found) < 5:
        return {tuple(found)}
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def brute(rows):
    """Size of the set and smallest id reachable, for each row; all pairs are compared."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    names = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            names[top(i)] = min(names.get(top(i), row[0]), row[0])
    return sorted(
        ((r[0], len(sets[i]), names.get(top(i)) if sets[i] else r[0]) for i, r in enumerate(rows)),
        key=repr,
    )


def found(spark, rows, **how):
    got = ngram_join.join_classes(corpus.documents(spark, rows, **how)).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr)


def copies():
    """Groups of near copies (one larger than a small run), a passage that unlike texts share,
    short texts and the edge cases."""
    rng = random.Random(11)
    rows, number = corpus.edge_rows(), 100
    for size, length in ((3, 30), (5, 120), (60, 200), (2, 8)):
        base = corpus.words(rng, length)
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, max(1, length // 40))):
                own[rng.randrange(length)] = "new" + str(rng.randrange(1000))
            rows.append((number, " ".join(own), "aa", "s", 0))
            number += 1
    passage = corpus.text(rng, 60)
    for _ in range(70):
        own = corpus.text(rng, rng.randint(5, 60))
        rows.append((number, f"{own} {passage} {corpus.text(rng, rng.randint(0, 30))}", "aa", "s", 0))
        number += 1
    for _ in range(12):
        rows.append((number, " ".join(rng.choices(["lo", "ka"], k=rng.randint(1, 7))), "aa", "s", 0))
        number += 1
    return rows


def test_equals_all_pairs(spark):
    rows = copies()
    assert found(spark, rows, clashing=True) == brute(rows)


def test_frequent_shingles_lose_no_link(spark, monkeypatch):
    rows = copies()
    # Every shingle counts as frequent, so that all signatures are pairs.
    monkeypatch.setattr(
        ngram_join, "frequent_cells", lambda sketches: ngram_join.np.ones((2, ngram_join.SKETCH), bool)
    )
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_keep_one(spark):
    rows = copies()
    kept = ngram_join.keep_one(corpus.documents(spark, rows))
    assert kept.columns == [f.split()[0] for f in corpus.SCHEMA.split(", ")]
    got = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    stay = {(i, n) for i, n, c in brute(rows) if i == c or n == 0 or i is None}
    want = sorted([i for i, n, c in brute(rows) if i is None] + [i for i, n in stay if i is not None], key=repr)
    assert got == want


def test_keep_one_shuffles_few_texts(spark, monkeypatch):
    """Rows that certainly stay move nowhere, whatever is too large for a broadcast."""
    rng = random.Random(5)
    rows = [(k, corpus.text(rng, 12), "aa", "s", 0) for k in range(3000)]
    rows += [(5000 + k, rows[k][1], "aa", "s", 0) for k in range(0, 3000, 30)]
    split, real = [], ngram_join._by_filter

    def kept_parts(*args):
        split.append(real(*args))
        return split[0]

    monkeypatch.setattr(ngram_join, "_by_filter", kept_parts)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["doc_id"] for r in ngram_join.keep_one(corpus.documents(spark, rows)).collect()}
        clear, others = ([r["doc_id"] for r in part.collect()] for part in split[0])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == set(range(3000))
    assert sorted(clear + others) == sorted(r[0] for r in rows)
    assert 100 <= len(others) < 400 and set(others) >= {r[0] for r in rows[3000:]}
    assert "Exchange" not in split[0][0]._jdf.queryExecution().executedPlan().toString()


def test_a_bitmap_is_short():
    for n in (1, 16, 100, 5000):
        tokens = ngram_join.np.arange(n, dtype=ngram_join.np.uint64) << ngram_join.np.uint64(32)
        assert len(ngram_join._parity(tokens)) <= max(8, n // 2)


@pytest.mark.parametrize("n", [2, 3, 4, 5, 7, 20, 333])
def test_similar_sets_share_a_signature(n):
    """For rare, mixed and frequent shingles alike."""
    rng = ngram_join.np.random.default_rng(n)
    for share in (0.0, 0.5, 1.0):
        frequent = rng.random((2, ngram_join.SKETCH)) < share**0.5
        for _ in range(30):
            base = rng.integers(1, 2**63, n, ngram_join.np.uint64)
            lost = rng.integers(0, n // 5 + 1)
            left = ngram_join.np.unique(base)
            right = ngram_join.np.unique(base[lost:])
            if 100 * len(right) < 80 * len(left) or len(right) < 2:
                continue
            a, b = (set(ngram_join.signatures(t, frequent).tolist()) for t in (left, right))
            assert a & b


def test_components_of_a_long_path(spark):
    links = spark.range(200).selectExpr("id as a", "id + 1 as b")
    rows = components(links).collect()
    assert len(rows) == 201 and {r["component"] for r in rows} == {0}
