import random
import re
import time

import pytest

from devtide.llm import toxicity

from . import corpus

BAD = ["grompel", "vilkash", "dratzug"]


def rows():
    rng = random.Random(12)
    made, labels = [], []
    for k in range(900):
        own = corpus.words(rng, rng.randint(20, 60))
        bad = k % 4 == 0
        if bad:
            for word in rng.sample(BAD, 2):
                own.insert(rng.randrange(len(own)), word)
        made.append((100 + k, " ".join(own), "aa", "s", 0))
        labels.append((100 + k, 1, int(bad)))
    return made, labels


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def model(spark):
    made, labels = rows()
    return toxicity.fit(corpus.documents(spark, made), spark.createDataFrame(labels, LABELS))


def test_held_out_and_contract(spark, tmp_path):
    made, labels = rows()
    folder = corpus.save(corpus.documents(spark, made + corpus.edge_rows(), clashing=True), tmp_path)
    corpus.save(spark.createDataFrame([*labels, labels[0], (None, 1, 1), (4, 0, None)], LABELS), tmp_path, "labels")
    got = toxicity.op5_toxicity(spark, folder)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    toxic = {k: t for k, _, t in labels}
    seen = [r for r in found if r["held_out"] and r["doc_id"] in toxic]
    assert len(seen) > 200 and all(r["predicted"] == toxic[r["doc_id"]] for r in seen)
    assert len(found) == len(made) + len(corpus.edge_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)


@pytest.mark.parametrize("word", ["gr0mpel", "v1lk4sh", "dr@tzug", "grrrompel", "v i l k a s h", "d.r.a.t.z.u.g", "GROMPEL"])
def test_disguised_words_count(spark, model, word):
    rng = random.Random(1)
    plain = corpus.text(rng, 30)
    docs = corpus.documents(spark, [(1, plain, None, None, None), (2, f"{plain} {word} {plain}", None, None, None)])
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert got[1] < 0.3 and got[2] >= 0.7


def test_restored_text(spark, model):
    docs = corpus.documents(spark, [(1, "lo gr0mpel ka v i l k a s h mi", "aa", "s", 0), *corpus.edge_rows()])
    got = {r["doc_id"]: r["text"] for r in toxicity.restore(docs, model).collect()}
    assert got[2] == ""
    assert toxicity.Restorer(model.trigrams, model.pairs).deobfuscated("lo gr0mpel ka v i l k a s h mi") == (
        "lo grompel ka vilkash mi"
    )


def test_viterbi_is_the_best_path():
    """Against all readings of a short lattice, under the same costs."""
    from itertools import product

    rows = [{"letters": t, "n": n} for t, n in (("^^s", 3), ("^so", 3), ("sol", 4), ("ol$", 5), ("^si", 1), ("sil", 1), ("il$", 1))]
    restorer = toxicity.Restorer(*toxicity._letter_model(rows))

    def cost(signs, letters):
        total, before = 0.0, "^^"
        for sign, letter in zip(signs, letters, strict=True):
            total += 0.0 if sign not in toxicity.LOOKALIKES else (
                toxicity._LITERAL if letter == sign else toxicity._SWAP
            )
            total += restorer._next(before, letter)
            before = before[1] + letter
        return total + restorer._next(before, "$")

    for signs in ("s01", "5o1", "$!1", "501"):
        options = [[s, *toxicity.LOOKALIKES.get(s, "")] for s in signs]
        best = max(("".join(p) for p in product(*options)), key=lambda p: cost(signs, p))
        assert restorer.word(signs) == best


def test_prefilter_loses_nothing(model):
    import pyarrow as pa

    restorer = toxicity.Restorer(model.trigrams, model.pairs)
    texts = ["a1b", "x y z w", "aaab", "s.t.u.p", "plain words only.", "4567 (a", "é1é", "", "a- -b c", "1 2 3 4", "$a"]
    texts += [r[1] or "" for r in corpus.edge_rows()]
    flags = toxicity.suspects(pa.array(texts, pa.large_string()))
    assert all(flag or not restorer.restored(t) for flag, t in zip(flags, texts, strict=True))


@pytest.mark.parametrize("labels", [[], [(100, 1, 1)], [(k, 1, 0) for k in range(100, 200)]])
def test_nothing_to_learn(spark, labels):
    docs = corpus.documents(spark, rows()[0][:50])
    nothing = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    assert {r["score"] for r in toxicity.score(docs, nothing).collect()} == {0.0}


def test_empty_table(spark, model):
    assert toxicity.score(corpus.documents(spark, []), model).collect() == []


def test_long_runs_two_byte_letters_and_mixed_gaps(model):
    import pyarrow as pa

    restorer = toxicity.Restorer(model.trigrams, model.pairs)
    long = "gr" + "o" * 60 + "mpel"
    assert restorer.restored(long) == restorer.restored("grooompel") == ["grompel"]
    assert restorer.restored("a s s") and restorer.restored("v.i-l k a s_h") == ["vilkash"]
    # Words of any length are searched.
    assert restorer.restored("ab" * 30 + "ccc")[0] in ("ab" * 30 + "c", "ab" * 30 + "cc")
    texts = [long, "blööööd", "ééé", "x ééé", "é1", "a s s", "ö.s-s", "v.i-l k a s_h", "no. a s s", "ab", "a b"]
    for value in texts:
        # Alone, and between other texts that end and begin with letters.
        flags = toxicity.suspects(pa.array(["plain", value, "plain"], pa.large_string()))
        assert flags[1] or not restorer.restored(value)
        assert not flags[0] and not flags[2]
    flags = toxicity.suspects(pa.array(texts, pa.large_string())).tolist()
    assert flags == [True] * 9 + [False] * 2


def test_long_disguised_words_are_searched_in_linear_time():
    rng = random.Random(2)
    plain = re.sub(r"(.)\1+", r"\1", "".join(rng.choices("stupidmoran", k=500)))
    trigrams = {}
    shown = f"^^{plain}$"
    for k in range(len(shown) - 2):
        trigrams[shown[k : k + 3]] = -0.1
    restorer = toxicity.Restorer(trigrams, {})
    swaps = {"s": "$", "i": "!", "o": "0", "a": "@"}
    assert restorer.word("".join(swaps.get(c, c) for c in plain)) == plain
    assert restorer.restored(" ".join(plain[:60])) == [plain[:60]]
    began = time.perf_counter()
    restorer.word("".join(rng.choices("abcdefghij0123456789", k=20_000)))
    assert time.perf_counter() - began < 30
