import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from devtide.llm import language_model
from devtide.llm.elias_fano import Sequence

from . import corpus


@pytest.mark.parametrize(
    ("n", "bound"), [(1, 10), (5, 5), (1000, 10**6), (1000, 1001), (3000, 4000), (64, 64), (20000, 2**40)]
)
def test_sequence(n, bound):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, bound, n))
    sequence = Sequence(Sequence.encode(values, bound))
    wanted = np.concatenate([values, rng.integers(0, bound, 500)])
    place, equal = sequence.successor(wanted)
    assert np.array_equal(equal, np.isin(wanted, values))
    assert np.array_equal(place[equal], np.searchsorted(values, wanted[equal]))
    assert np.array_equal(sequence.at(np.arange(n)), values)


def rows():
    rng = random.Random(2)
    common = corpus.words(rng, 30)
    made = []
    for k in range(300):
        own = [rng.choice(common) if rng.random() < 0.8 else corpus.words(rng, 1)[0] for _ in range(rng.randint(0, 60))]
        made.append((100 + k, " ".join(w.title() if rng.random() < 0.1 else w for w in own), "aa", "s", 0))
    return made + corpus.edge_rows()


def tokens(value):
    return [*re.findall(corpus.SPACE, corpus.lowered(value)), None]


def held_out(number):
    return number is not None and zlib.crc32(str(number).encode()) % 7 == 2


def test_base_scores_equal_brute_force(spark, tmp_path):
    folder = corpus.save(corpus.documents(spark, rows(), clashing=True), tmp_path)
    got = language_model.op10_lm_scores(spark, folder)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    counts = Counter(t for r in rows() if not held_out(r[0]) for t in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for r in rows():
        own = tokens(r[1])
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        want.append((r[0], held_out(r[0]), len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)))
    found = [(*tuple(r)[:5], round(r["base_score"], 6)) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_rare_words_meet_their_counts_in_the_join(spark, tmp_path, monkeypatch):
    """The same scores if the direct table holds only the most frequent words."""
    folder = corpus.save(corpus.documents(spark, rows()), tmp_path)
    whole = {tuple(r) for r in language_model.op10_lm_scores(spark, folder).collect()}
    real = language_model.frequent_words
    monkeypatch.setattr(language_model, "frequent_words", lambda counts: real(counts, 40))
    few = {tuple(r) for r in language_model.op10_lm_scores(spark, folder).collect()}
    assert {r[:5] for r in whole} == {r[:5] for r in few}
    assert sorted(round(r[5], 6) for r in whole) == sorted(round(r[5], 6) for r in few)


def test_probabilities_equal_the_formula_and_sum_to_one(spark):
    docs = corpus.documents(spark, rows())
    folder, words, counts = language_model.build(docs)
    trie = language_model.Trie(folder, words)
    name = {}
    singles, pairs, triples = Counter(), Counter(), Counter()
    for r in rows():
        own = tokens(r[1])
        singles.update(own)
        pairs.update(zip(own, own[1:]))
        triples.update(zip(own, own[1:], own[2:]))
    for word in singles:
        hashed = language_model.END if word is None else language_model.shared.hash_word(word)
        name[word] = int(words.of(np.array([hashed], np.uint64))[0])
    floor, cut = sum(singles.values()) + len(singles) + 1, language_model.DISCOUNT
    inside = {w for w in singles if name[w] < language_model.LEVELS[1]}
    follow = {}
    for gram, c in [*pairs.items(), *triples.items()]:
        if name[gram[-1]] < language_model.LEVELS[len(gram) - 2]:
            follow[gram[:-1]] = follow.get(gram[:-1], 0) + c - cut

    def plain(*gram):
        if len(gram) == 1:
            return (singles[gram[0]] + 1) / floor
        seen = pairs if len(gram) == 2 else triples
        context = gram[:-1]
        total = singles[context[0]] if len(gram) == 2 else pairs[context]
        if not total or context[0] is None:
            return plain(*gram[1:])
        known = language_model.LEVELS[len(gram) - 2]
        if any(name[w] >= known for w in context):
            return plain(*gram[1:])
        rest = 1 - follow.get(context, 0) / total
        own = max(seen[gram] - cut, 0) / total if name[gram[-1]] < known else 0
        return own + rest * plain(*gram[1:])

    rng = random.Random(3)
    texts = [[w for w in tokens(r[1])] for r in rows() if r[0] and r[0] >= 100][:25]
    error = 1.6 / language_model.STEPS
    for own in texts:
        number = np.array([name[w] for w in own])
        got = trie.scores(number, np.zeros(len(own), np.int64))
        for i, value in enumerate(got):
            assert abs(value - math.log10(plain(*own[max(0, i - 2) : i + 1]))) <= error
    for context in rng.sample(sorted(p for p in pairs if None not in p and set(p) <= inside), 5):
        assert abs(sum(plain(*context, w) for w in singles) + 1 / floor - 1) < 0.01


def test_followers(spark):
    folder, words, _ = language_model.build(corpus.documents(spark, [(1, "a b a c a b", None, None, None)]))
    number = {w: int(words.of(np.array([language_model.shared.hash_word(w)], np.uint64))[0]) for w in "abc"}
    level = language_model.Trie(folder, words).level(2, number["a"] % language_model.SHARDS)
    got = level.followers(number["a"] // language_model.SHARDS)
    assert set(got.tolist()) == {number["b"], number["c"]}


def test_empty_tables(spark, tmp_path):
    folder = corpus.save(corpus.documents(spark, []), tmp_path)
    assert language_model.op10_lm_scores(spark, folder).collect() == []
    model = language_model.build(corpus.documents(spark, []))
    got = language_model.score(corpus.documents(spark, [(1, "a b", None, None, None)]), *model).collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got] == [(3, 0, 0.0, 0.0)]


def test_every_pair_and_triple_counts(spark, tmp_path, monkeypatch):
    """Scores are those of the formula over all n-grams, however few words are frequent ones and
    however the levels are cut."""
    made = rows()
    monkeypatch.setattr(language_model, "_CONTEXTS", 1024)
    real = language_model.frequent_words
    monkeypatch.setattr(language_model, "frequent_words", lambda counts: real(counts, 5))
    folder = corpus.save(corpus.documents(spark, made), tmp_path)
    got = [tuple(r) for r in language_model.op10_lm_scores(spark, folder).collect()]
    grams, follow = Counter(), {}
    for r in made:
        if not held_out(r[0]):
            own = tokens(r[1])
            for n in (1, 2, 3):
                grams.update(zip(*(own[k:] for k in range(n))))
    for gram in grams:
        if len(gram) > 1:
            follow.setdefault(gram[:-1], []).append(grams[gram])
    total = sum(c for g, c in grams.items() if len(g) == 1)
    floor = total + sum(len(g) == 1 for g in grams) + 1

    def plain(gram):
        if len(gram) == 1:
            return (grams[gram] + 1) / floor
        if gram[:-1] not in follow:
            return plain(gram[1:])
        after, cut = follow[gram[:-1]], language_model.DISCOUNT
        return max(grams[gram] - cut, 0) / sum(after) + cut * len(after) / sum(after) * plain(gram[1:])

    want = Counter()
    for r in made:
        if len(own := tokens(r[1])) > 1:
            score = sum(math.log10(plain(tuple(own[max(0, i - 2) : i + 1]))) for i in range(len(own)))
            want[r[0]] = score / len(own)
    seen = {r[0]: r[6] / r[2] for r in got if r[2] > 1}
    assert {k: (seen[k], v) for k, v in want.items() if abs(seen[k] - v) >= 1.6 / language_model.STEPS} == {}
    assert len(set(grams)) > 1000 and sum(len(g) == 2 for g in grams) > 1024


def test_a_search_goes_on_only_where_a_range_is_open(monkeypatch):
    """One long range must not make all other lookups take its steps."""
    dense, apart = np.arange(4096), np.arange(1, 4097) << 40
    values = np.concatenate([dense, apart]).astype(np.uint64)
    sequence = Sequence(Sequence.encode(values, 1 << 53))
    taken, real = [], Sequence._low
    monkeypatch.setattr(Sequence, "_low", lambda self, at: taken.append(len(at)) or real(self, at))
    wanted = np.concatenate([[4000], apart]).astype(np.uint64)
    place, equal = sequence.successor(wanted)
    assert equal.all() and (values[place] == wanted).all()
    assert sum(taken) < 3 * len(wanted)


def test_chunks_are_looked_up_together(monkeypatch):
    monkeypatch.setattr(language_model.shared, "CHUNK_BYTES", 20)
    texts = pa.array(["lo ka mi", "", "tu ren sol va di", "lo", "ka ka"] * 4, pa.large_string())
    (lot,) = language_model.lots_of(texts)
    parts = list(language_model.tokens_of(texts))
    assert len(parts) > 1
    assert lot[0].tolist() == np.concatenate([tokens for _, tokens, _ in parts]).tolist()
    assert lot[1].tolist() == np.concatenate([first + row for first, _, row in parts]).tolist()


def test_words_are_found_by_the_first_bits_of_their_hashes():
    rng = np.random.default_rng(3)
    hashes = np.unique(np.concatenate([rng.integers(0, 2**64, 500, np.uint64), np.arange(2**63, 2**63 + 40, dtype=np.uint64)]))
    number = rng.permutation(len(hashes))
    words = language_model.Words(hashes, number, np.ones(len(hashes), np.int64), 1, 1)
    for asked in (hashes, hashes + np.uint64(1), hashes - np.uint64(1), np.array([0, 2**64 - 1], np.uint64)):
        want = dict(zip(hashes.tolist(), number.tolist(), strict=True))
        assert words.of(asked).tolist() == [want.get(h, -1) for h in asked.tolist()]
