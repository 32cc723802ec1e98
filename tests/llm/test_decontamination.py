import random

import numpy as np
import pyarrow as pa
import pytest

from devtide.llm import decontamination

from . import corpus

ITEMS = "item_id long, text string"


def items():
    rng = random.Random(5)
    made = [(k, corpus.text(rng, rng.randint(16, 58)) + "? Answer: " + corpus.text(rng, 9)) for k in range(30)]
    made.append((30, corpus.text(rng, 200) + ". " + corpus.text(rng, 30)))
    return made + [(31, None), (32, ""), (33, made[3][1]), (3, made[3][1]), (None, "lo ka mi tu")]


def rows():
    rng, made = random.Random(6), dict(i for i in items() if i[0] is not None)
    out = []
    for k in range(60):
        own = corpus.text(rng, rng.randint(10, 150)).split(" ")
        at = rng.randrange(len(own))
        leak = made[k % 10] if k % 3 == 0 else ""
        if k % 6 == 0:
            leak = leak.upper().replace(" ", "\n")
        out.append((100 + k, " ".join([*own[:at], leak, *own[at:]]), "aa", "s", 0))
    return out + corpus.edge_rows()


def wanted():
    found = set()
    for k in range(0, 60, 3):
        found |= {(100 + k, i) for i in ((3, 33) if k % 10 == 3 else (k % 10,))}
    return found


def test_finds_planted_items_only(spark):
    docs = corpus.documents(spark, rows(), clashing=True)
    got = decontamination.leaks(docs, spark.createDataFrame(items(), ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == wanted()
    assert len(got) == len(wanted())
    assert all(r["score"] >= decontamination.THRESHOLD for r in got)


def test_blocks_of_items_give_the_same(spark):
    docs, benchmark = corpus.documents(spark, rows()), spark.createDataFrame(items(), ITEMS)
    whole = {tuple(r) for r in decontamination.leaks(docs, benchmark).collect()}
    parts = {tuple(r) for r in decontamination.leaks(docs, benchmark, items=4).collect()}
    assert {r[:2] for r in whole} == {r[:2] for r in parts}
    assert sorted(round(r[2], 9) for r in whole) == sorted(round(r[2], 9) for r in parts)


def test_stage_drops_leaks_and_keeps_the_rest(spark):
    docs = corpus.documents(spark, rows(), clashing=True)
    kept = decontamination.without_leaks(docs, spark.createDataFrame(items(), ITEMS))
    assert kept.schema == docs.schema
    bad = {d for d, _ in wanted()}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r[0]) for r in rows() if r[0] not in bad
    )


@pytest.mark.parametrize("benchmark", [[], [(1, None)], [(1, " ... ")]])
def test_nothing_to_leak(spark, benchmark):
    docs = corpus.documents(spark, rows())
    table = spark.createDataFrame(benchmark, ITEMS)
    assert decontamination.leaks(docs, table).collect() == []
    assert decontamination.without_leaks(docs, table).count() == len(rows())


def test_empty_documents(spark):
    assert decontamination.leaks(
        corpus.documents(spark, []), spark.createDataFrame(items(), ITEMS)
    ).collect() == []


def _index(seed, n):
    rng = random.Random(seed)
    texts = [(k, " ".join(rng.choices([f"w{i}" for i in range(40)], k=rng.randint(3, 90)))) for k in range(n)]
    hashes = {int(w) for _, t in texts for w in decontamination._words_of(t)}
    weights = {w: rng.uniform(0.1, 5) for w in hashes}
    return decontamination.make_index(texts, weights, 40.0), rng


def _plain(index, words):
    scores = np.zeros(len(index.items))
    for w in words:
        for item, part in zip(*index.postings[w][:2], strict=True):
            scores[item] += part
    return scores


def test_wand_finds_all_above_the_threshold():
    index, rng = _index(1, 300)
    for _ in range(300):
        words = sorted(rng.sample(range(len(index.words)), rng.randint(1, 25)))
        least = rng.choice([0.05, 0.3, 0.6])
        scores = _plain(index, words)
        want = {int(i): scores[i] for i in np.flatnonzero(scores >= least - 1e-9)}
        got = dict(decontamination.search(index, words, least))
        assert got.keys() == want.keys()
        assert all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_the_bound_lets_every_passage_through_that_scores():
    index, rng = _index(2, 150)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(55)], k=rng.randint(0, 200))) for _ in range(80)]
    found = {(row, start) for row, _, start, _ in decontamination.passages(index, pa.array(texts, pa.large_string()))}
    for row, text in enumerate(texts):
        words = decontamination._words_of(text) if text else np.zeros(0, np.uint64)
        for start in decontamination._starts(len(words)):
            inside = np.flatnonzero(np.isin(index.words, words[start : start + decontamination.WINDOW]))
            if (_plain(index, inside) >= decontamination.THRESHOLD).any():
                assert (row, start) in found


@pytest.mark.parametrize(
    ("text", "answer"),
    [
        ("What is it? A thing.", " A thing."),
        ("Say it. Answer: a thing", "Answer: a thing"),
        ("One. Two three.", "Two three."),
        ("only one sentence", ""),
        ("Why?", ""),
    ],
)
def test_question_and_answer(text, answer):
    assert text[decontamination.question_end(text) :] == answer


def test_an_item_id_with_and_without_text(spark):
    items = [(1, None), (1, "lo ka mi tu ren sol va di"), (1, None), (2, ""), (None, "ka lo")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    leaked = "x " * 30 + "lo ka mi tu ren sol va di " + "y " * 30
    docs = corpus.documents(spark, [*corpus.edge_rows(), (77, leaked, "aa", "s", len(leaked))])
    found = [
        sorted(((r.doc_id, r.item_id) for r in decontamination.leaks(docs, rows).collect()), key=repr)
        for rows in (bench, bench.filter("text is not null"))
    ]
    assert found[0] == found[1] and found[0]
