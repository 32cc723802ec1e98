import random

from pyspark.sql import functions as F

from devtide.llm import language_id

from . import corpus


def rows():
    rng = random.Random(3)
    return [
        (k, corpus.text(rng, rng.randint(20, 80), lang), lang, "s", 0)
        for k in range(120)
        for lang in [("aa", "bb")[k % 2]]
    ]


def test_held_out_accuracy_and_contract(spark, tmp_path):
    folder = corpus.save(corpus.documents(spark, rows() + corpus.edge_rows(), clashing=True), tmp_path)
    got = language_id.op2_language_id(spark, folder)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    known = {r[0]: r[2] for r in rows()}
    seen = [r for r in got.collect() if r["doc_id"] in known and r["doc_id"] > 8]
    assert sum(r["held_out"] for r in seen) > 10
    assert all(r["lang_pred"] == known[r["doc_id"]] for r in seen)
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert not any(r["rejected"] for r in seen)


def test_edge_cases(spark):
    model = language_id.fit(corpus.documents(spark, rows()))
    got = language_id.predict(corpus.documents(spark, corpus.edge_rows()), model).collect()
    assert len(got) == len(corpus.edge_rows())
    by_id = {r["doc_id"]: r for r in got}
    for number in (1, 2, 3, 8):
        assert by_id[number]["lang_pred"] == "und" and by_id[number]["score"] == 0
        assert by_id[number]["rejected"]
    twice = [tuple(r) for r in got if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_nothing_to_learn(spark):
    empty = corpus.documents(spark, [])
    model = language_id.fit(empty)
    assert language_id.predict(empty, model).collect() == []
    got = language_id.predict(corpus.documents(spark, rows()[:3]), model).collect()
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in got} == {("und", 0.0, True)}


def test_the_label_of_a_row_is_not_its_prediction(spark):
    docs = corpus.documents(spark, rows())
    model = language_id.fit(docs)
    swapped = docs.withColumn("lang", F.lit("zz"))
    assert {r["lang_pred"] for r in language_id.predict(swapped, model).collect()} == {"aa", "bb"}


def test_features_of_a_batch_are_those_of_each_text():
    import numpy as np
    import pyarrow as pa

    texts = ["", "a", "ab c", "  ", "éü x1y  z", "A B"]
    together = {}
    for a, _, row, feature, count in language_id._each(pa.array(texts, pa.large_string())):
        for r, f, c in zip(row + a, feature, count, strict=True):
            together.setdefault(int(r), []).append((int(f), int(c)))
    for k, one in enumerate(texts):
        alone = [
            (int(f), int(c))
            for _, _, _, feature, count in language_id._each(pa.array([one], pa.large_string()))
            for f, c in zip(feature, count, strict=True)
        ]
        assert together.get(k, []) == alone
    assert np.array_equal(sorted(together), [1, 2, 4, 5])


def test_unseen_languages_and_gibberish_are_rejected(spark):
    rng = random.Random(8)
    made = [(k, corpus.text(rng, rng.randint(20, 80), lang), lang, "s", 0) for k in range(600) for lang in [("aa", "bb")[k % 2]]]
    # Labelled junk does not open the gate.
    odd = ["".join(rng.choices("bcfghjpqwxyz", k=3)) for _ in range(16)]
    junk = [(1000 + k, word, ("aa", "bb")[k % 2], "s", 0) for k, word in enumerate(odd)]
    model = language_id.fit(corpus.documents(spark, made + junk))
    other = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki"
    drawn = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(60)]
    strange = [(1, other, None, None, None), (2, " ".join(drawn), None, None, None)]
    clean = [(10 + k, corpus.text(rng, rng.randint(5, 80), ("aa", "bb")[k % 2]), None, None, None) for k in range(200)]
    got = language_id.predict(corpus.documents(spark, strange + clean), model).collect()
    assert all(r["rejected"] for r in got if r["doc_id"] < 10)
    assert sum(r["rejected"] for r in got if r["doc_id"] >= 10) <= 8
    kept = language_id.keep_known(corpus.documents(spark, strange + clean), model).collect()
    assert not {1, 2} & {r["doc_id"] for r in kept}
