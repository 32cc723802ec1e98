import math
import time
import random
import re

import pyarrow as pa
import pytest

from devtide.llm import quality

from . import corpus


def brute(value):
    value = value or ""
    found = re.findall(corpus.SPACE, value)
    windows = {}
    for i in range(len(found) - 2):
        windows.setdefault(tuple(found[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, again = set(), 0
    for line in value.split("\n"):
        if re.search(corpus.SPACE, line):
            again += line in seen
            seen.add(line)
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", value)),
        again,
        len(covered),
    )


def texts():
    rng = random.Random(8)
    made = [r[1] for r in corpus.edge_rows()]
    for _ in range(200):
        parts = rng.choices(["a", "B", "é", "#x", "a b c", "\n", " \n", "l1\n", "\r", "&", "中文"], k=rng.randint(0, 60))
        made.append(rng.choice(["", " "]).join(parts))
    return made


def test_counts_equal_brute_force():
    values = texts()
    got = quality.measure(pa.array([v or "" for v in values], pa.large_string()))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(int(got[n][i]) for n in names) for i in range(len(values))] == [brute(v) for v in values]


@pytest.mark.parametrize(("k", "n", "p"), [(0, 300, 0.02), (3, 500, 0.02), (1, 40, 0.1), (0, 1, 0.5)])
def test_bound_is_the_exact_binomial(k, n, p):
    tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert quality.within(k, n, p, tail * 1.0001) and not quality.within(k, n, p, tail * 0.9999)


def test_no_sample_no_cutoff():
    assert not quality.within(0, 0, 0.1, 0.05) and not quality.within(5, 5, 0.1, 0.05)


def rows():
    """Good texts of two languages (too few of one), and bad ones full of signs."""
    rng = random.Random(9)
    made, labels = [], []
    for k in range(4000):
        good, lang = k % 5 > 0, "aa" if k < 3900 else "bb"
        own = corpus.words(rng, 60, lang)
        if not good:
            own = [w + "%" for w in own]
        made.append((k, " ".join(own), lang, "s", 0))
        labels.append((k, int(good), 0))
    return made, labels


def test_cutoffs_keep_good_and_drop_bad(spark, tmp_path):
    made, labels = rows()
    extra = [(5000 + k, *r[1:]) for k, r in enumerate(corpus.edge_rows())]
    folder = corpus.save(corpus.documents(spark, made + extra, clashing=True), tmp_path)
    table = spark.createDataFrame([*labels, labels[1], (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    corpus.save(table, tmp_path, "labels")
    got = {r["doc_id"]: r for r in quality.op8_quality_rules(spark, folder).collect()}
    assert len(got) == len(made) + len(extra)
    assert all(got[k]["kept"] for k, q, _ in labels if q)
    assert not any(got[k]["kept"] for k, q, _ in labels if not q and k < 3900)
    # Too few documents to be sure of anything: no rule.
    assert all(got[k]["kept"] for k, q, _ in labels if k >= 3900)
    for k, r in enumerate(extra):
        want = brute(r[1])
        row = got[5000 + k]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want
        assert row["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row["base_failed"] and row["kept"])


def test_empty_tables(spark):
    docs, labels = corpus.documents(spark, []), spark.createDataFrame([], "doc_id long, quality int")
    assert quality.keep_good(docs, labels).collect() == []
    got = quality.keep_good(corpus.documents(spark, rows()[0][:60]), labels).collect()
    assert all(r["kept"] for r in got)


def test_the_bound_takes_few_steps():
    """A billion labels, with the cutoff's share close to the risk; and small cases term by term."""
    began = time.perf_counter()
    assert quality.within(9_900_000, 10**9, 0.01, 1e-6)
    assert not quality.within(9_999_999, 10**9, 0.01, 1e-6)
    assert not quality.within(900_000_000, 10**9, 0.01, 1e-6)
    assert time.perf_counter() - began < 2
    for n in (1, 7, 40):
        for k in range(n):
            for p in (0.02, 0.3):
                tail = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
                for error in (0.9, 0.2, 1e-3, 1e-9):
                    assert quality.within(k, n, p, error) == (tail <= error)
