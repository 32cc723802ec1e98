"""Toxicity scores of deobfuscated text.

Words that look disguised (letters replaced by digits or signs, letters drawn out, letters set
apart by blanks or dots) become lattices: each sign may stand for itself or for letters it
resembles, a run for one letter or two; the separators of letters that stand alone are left out
before. A Viterbi search over all states of a character trigram model, which is counted over all
given documents, finds the likeliest letters of a word of any length. Words and their beginnings that toxic
training documents hold far more often than others are the evidence; a logistic model of the
evidence in the plain and the restored words gives the score.

Labels are learned from at most ``2 * SAMPLE`` labelled documents (about ``SAMPLE``, by a hash of
the id); near copies among them count once. Everything else covers all documents.

Defined results: a text that is null or empty has no evidence and gets the model's lowest score;
if there are no labels, or all are equal, every score is 0; a document is toxic if any of its
labels says so; equal texts get equal scores. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .ngram_join import sets_of

#: Labelled documents that are learned from (twice as many at most).
SAMPLE = 20_000
#: Toxic documents a feature needs, its least log odds, and how many features are kept.
LEAST_DOCUMENTS, LEAST_ODDS, FEATURES = 8, 2.0, 20_000
#: Bytes of a word's beginning that are a feature of their own, if the word is longer.
STEM = 5
#: Score from which a document is predicted to be toxic.
CUTOFF = 0.7
#: Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou",
}
#: Log costs of the channel: a letter for a sign, a drawn-out letter, a sign left as it is.
_SWAP, _DRAWN, _LITERAL = -1.0, -1.5, -6.0
_REMEMBERED = 50_000
#: Longest disguised word whose letters are remembered.
_SHORT = 40
#: Trigrams of the letter model, the most frequent ones of all documents; others are backed off to
#: pairs, as unseen ones are. An alphabet of hundreds of letters has fewer.
TRIGRAMS = 1 << 18

_SIGNS = re.escape("".join(LOOKALIKES))
_LETTER = "a-zA-ZÀ-ɏ"
_DISGUISED = re.compile(
    rf"(?<![{_LETTER}{_SIGNS}])(?=[{_LETTER}{_SIGNS}]*[{_LETTER}])"
    rf"(?=[{_LETTER}]*[{_SIGNS}]|[{_LETTER}]*?([{_LETTER}])\1\1)[{_LETTER}{_SIGNS}]{{3,}}"
    rf"(?![{_LETTER}{_SIGNS}])"
)
_SPACED = re.compile(
    rf"(?<![{_LETTER}{_SIGNS}])[{_LETTER}{_SIGNS}]"
    rf"(?:[ ._\-*][{_LETTER}{_SIGNS}]){{2,}}(?![{_LETTER}{_SIGNS}])"
)
_REPEATED = re.compile(r"(.)\1{3,}", re.DOTALL)
_SIGN_BYTE = np.zeros(256, bool)
_SIGN_BYTE[list("".join(LOOKALIKES).encode())] = True
_LETTER_BYTE = np.zeros(256, bool)
_LETTER_BYTE[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = True
#: First bytes of letters and signs.
_WORD_BYTE = _SIGN_BYTE | _LETTER_BYTE
_GAP_BYTE = np.zeros(256, bool)
_GAP_BYTE[list(b" ._-*")] = True


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    trigrams: dict[str, float]
    pairs: dict[str, float]
    logistic: np.ndarray


class Restorer:
    """Viterbi search for the letters behind a disguised word."""

    def __init__(self, trigrams: dict[str, float], pairs: dict[str, float]) -> None:
        self.trigrams, self.pairs = trigrams, pairs
        self.known: dict[str, str] = {}

    def _next(self, before: str, letter: str) -> float:
        """Log probability of a letter after the two before it, backing off to one and none."""
        if (found := self.trigrams.get(before + letter)) is not None:
            return found
        return self.pairs.get(before[-1] + letter, -9.0) - 1.0

    def word(self, shown: str) -> str:
        # Three equal signs stand for any more.
        shown = _REPEATED.sub(r"\1\1\1", shown.lower())
        if shown in self.known:
            return self.known[shown]
        # Lattice edges: for each run of one sign, what it may stand for and its cost.
        edges = []
        for run in re.finditer(r"(.)\1*", shown, re.DOTALL):
            sign, times = run.group(1), len(run.group())
            options = [(sign, 0.0 if sign not in LOOKALIKES else _LITERAL)]
            options += [(letter, _SWAP) for letter in LOOKALIKES.get(sign, "")]
            if times > 1:
                # One letter drawn out, or a double letter.
                options = [
                    (letter * copies, cost + _DRAWN * (times - copies > 0) + _DRAWN * (times > 2))
                    for letter, cost in options
                    for copies in (1, 2)
                ]
            edges.append(options)
        # A state is the last two letters: all states are followed, and each keeps the way that it
        # was reached best, so that a word of any length takes linear time.
        best: dict[str, float] = {"^^": 0.0}
        ways: list[dict[str, tuple[str, str]]] = []
        for options in [*edges, [("$", 0.0)]]:
            reached: dict[str, float] = {}
            way: dict[str, tuple[str, str]] = {}
            for before, score in best.items():
                for letters, cost in options:
                    state, total = before, score + cost
                    for letter in letters:
                        total += self._next(state, letter)
                        state = state[1] + letter
                    if state not in reached or (total, before, letters) > (reached[state], *way[state]):
                        reached[state], way[state] = total, (before, letters)
            best = reached
            ways.append(way)
        state, parts = max(best, key=lambda s: (best[s], s)), []
        for way in reversed(ways):
            state, letters = way[state]
            parts.append(letters)
        found = "".join(reversed(parts[1:]))
        if len(shown) <= _SHORT:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            self.known[shown] = found
        return found

    def restored(self, text: str) -> list[str]:
        """The likeliest words behind all that look disguised."""
        words = [self.word(m.group()) for m in _DISGUISED.finditer(text)]
        words += [self.word(m.group()[::2]) for m in _SPACED.finditer(text)]
        return words

    def deobfuscated(self, text: str) -> str:
        """``text`` with the disguised words restored."""
        text = _SPACED.sub(lambda m: self.word(m.group()[::2]), text)
        return _DISGUISED.sub(lambda m: self.word(m.group()), text)


def suspects(texts: pa.Array) -> np.ndarray:
    """Whether a text can have a disguised word: a sign next to a letter, one letter three
    times, or three letters that stand alone in a row."""
    out = np.zeros(len(texts), bool)
    for first, _, data, offsets in shared.chunks(texts):
        if len(data) < 3:
            continue
        # By code points: first bytes, and for letters of two bytes the second ones.
        place = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[place]
        if len(lead) < 3:
            continue
        second = np.where(lead >= 0x80, data[np.minimum(place + 1, len(data) - 1)], 0)
        sign, letter, gap, word = (kind[lead] for kind in (_SIGN_BYTE, _LETTER_BYTE, _GAP_BYTE, _WORD_BYTE))
        beside = (sign[:-1] & letter[1:]) | (letter[:-1] & sign[1:])
        equal = (lead[:-1] == lead[1:]) & (second[:-1] == second[1:])
        at = [place[np.flatnonzero(beside)], place[np.flatnonzero(letter[:-2] & equal[:-1] & equal[1:])]]
        if len(lead) > 4:
            border = np.zeros(len(data) + 1, bool)
            border[offsets] = True
            starts = border[place]
            before, after = np.ones(len(lead), bool), np.ones(len(lead), bool)
            before[1:] = ~word[:-1] | starts[1:]
            after[:-1] = ~word[1:] | starts[1:]
            alone = before[:-4] & word[:-4] & gap[1:-3] & word[2:-2] & gap[3:-1] & word[4:] & after[4:]
            at.append(place[np.flatnonzero(alone)])
        out[first + np.searchsorted(offsets, np.concatenate(at), "right") - 1] = True
    return out


def _stem_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the beginnings of longer words, and which words those are."""
    longer = np.flatnonzero(ends - starts > STEM)
    codes = np.zeros(len(longer), np.uint64)
    for k in range(STEM):
        byte = data[starts[longer] + k].astype(np.uint64)
        byte = np.where((byte >= 65) & (byte <= 90), byte + np.uint64(32), byte)
        codes = codes * np.uint64(256) + byte
    return shared.mix(codes + shared.MULTIPLIERS[50]), longer


def _features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, then row (from there) and feature of all words and beginnings of words."""
    for first, _, data, offsets in shared.chunks(texts):
        words, begin, starts, ends = shared.word_hashes(data, offsets, shared.ALNUM)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(begin))
        stems, longer = _stem_hashes(data, starts, ends)
        yield first, np.concatenate([row, row[longer]]), np.concatenate([words, stems])


def _evidence(texts: pa.Array, model: Model, restorer: Restorer) -> np.ndarray:
    """For each text: sum and highest of its distinct features' weights."""
    out = np.zeros((len(texts), 2))
    if not len(model.features):
        return out
    extra: dict[int, list[str]] = {}
    for i in np.flatnonzero(suspects(texts)).tolist():
        if words := restorer.restored(texts[i].as_py()):
            extra[i] = words
    found: list[np.ndarray] = []
    for first, row, feature in _features(texts):
        found.append(_known(model, row + first, feature))
    if extra:
        again = pa.array([" ".join(w) for w in extra.values()], pa.large_string())
        rows = np.array(list(extra))
        for first, row, feature in _features(again):
            found.append(_known(model, rows[row + first], feature))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    weights = model.weights[pairs[1]]
    np.add.at(out[:, 0], pairs[0], weights)
    np.maximum.at(out[:, 1], pairs[0], weights)
    return out


def _known(model: Model, row: np.ndarray, feature: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(model.features, feature), len(model.features) - 1)
    here = model.features[at] == feature
    return np.stack([row[here], at[here]])


def _inputs(evidence: np.ndarray) -> np.ndarray:
    return np.column_stack(
        [np.ones(len(evidence)), np.log1p(evidence[:, 0]), evidence[:, 1]]
    )


def _scores(model: Model, evidence: np.ndarray) -> np.ndarray:
    if not len(model.logistic):
        return np.zeros(len(evidence))
    return 1 / (1 + np.exp(-np.clip(_inputs(evidence) @ model.logistic, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic model by Newton's method, with a small ridge."""
    weights = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 1e-2
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge @ weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the documents to learn from: a bounded sample, near copies (those with
    the same smallest shingle) once."""
    known = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    total = known.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    chosen = known.filter(place < min(1.0, SAMPLE / max(total, 1)) * (1 << 30)).limit(2 * SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [
                int(tokens.min().view(np.int64)) if len(tokens) else 0
                for _, tokens in sets_of(shared.texts_of(batch))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.int64())],
                ["text", "toxic", "key"],
            )

    rows = shared.arrow_map(rows.select("text", "toxic"), keyed, "text string, toxic int, key long")
    return shared.stored(rows.dropDuplicates(["key", "toxic"]).select("text", "toxic"), "sample")


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature: toxic ones, others."""
    for batch in batches:
        texts, toxic = shared.texts_of(batch), batch.column(1).to_numpy()
        for first, row, feature in _features(texts):
            pairs = np.unique(np.stack([feature, row.astype(np.uint64)]), axis=1)
            bad = toxic[pairs[1].astype(np.int64) + first] > 0
            found, start = np.unique(pairs[0], return_index=True)
            if not len(found):
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.view(np.int64)),
                    pa.array(np.add.reduceat(bad, start, dtype=np.int64)),
                    pa.array(np.add.reduceat(~bad, start, dtype=np.int64)),
                ],
                ["feature", "bad", "good"],
            )


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams of letters within words that are not disguised."""
    counts: Counter[str] = Counter()
    for batch in batches:
        words: Counter[str] = Counter()
        for text in shared.texts_of(batch).to_pylist():
            words.update(re.findall(rf"(?<![{_SIGNS}])\b[{_LETTER}]+\b(?![{_SIGNS}])", text.lower()))
        for word, times in words.items():
            shown = f"^^{word}$"
            for k in range(len(shown) - 2):
                counts[shown[k : k + 3]] += times
    yield pa.RecordBatch.from_pydict(
        {"letters": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
    )


def _letter_model(rows: list) -> tuple[dict[str, float], dict[str, float]]:
    trigrams = {r["letters"]: r["n"] for r in rows}
    contexts: Counter[str] = Counter()
    pairs: Counter[str] = Counter()
    firsts: Counter[str] = Counter()
    for letters, n in trigrams.items():
        contexts[letters[:2]] += n
        pairs[letters[1:]] += n
        firsts[letters[1]] += n
    pair_logs = {p: math.log(n / firsts[p[0]]) for p, n in pairs.items()}
    return {
        t: math.log(0.9 * n / contexts[t[:2]] + 0.1 * pairs[t[1:]] / firsts[t[1]])
        for t, n in trigrams.items()
    }, pair_logs


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled ones of ``docs``."""
    sample = sample_of(docs, labels)
    sizes = {r["bad"]: r["count"] for r in sample.groupBy((F.col("toxic") > 0).alias("bad")).count().collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), {}, {}, np.zeros(0))
    if not bad or not good:
        return nothing
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    features = (
        shared.arrow_map(sample, _feature_counts, "feature long, bad long, good long")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .withColumn("weight", odds)
        .filter((F.col("bad") >= LEAST_DOCUMENTS) & (F.col("weight") >= LEAST_ODDS))
        .orderBy(F.desc("bad"), "feature")
        .limit(FEATURES)
        .collect()
    )
    letters = (
        shared.arrow_map(docs.select("text"), _letter_counts, "letters string, n long")
        .groupBy("letters")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "letters")
        .limit(TRIGRAMS)
        .collect()
    )
    order = sorted((r["feature"] % 2**64, r["weight"]) for r in features)
    model = Model(
        np.array([f for f, _ in order], np.uint64),
        np.array([w for _, w in order]),
        *_letter_model(letters),
        np.zeros(0),
    )
    known = docs.sparkSession.sparkContext.broadcast(model)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(known.value.trigrams, known.value.pairs)
        for batch in batches:
            found = _evidence(shared.texts_of(batch), known.value, restorer)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1]), batch.column(1)], ["a", "b", "toxic"]
            )

    rows = np.array(
        [tuple(r) for r in shared.arrow_map(sample, evidence, "a double, b double, toxic int").collect()],
        float,
    )
    model.logistic = _logistic(_inputs(rows[:, :2]), (rows[:, 2] > 0).astype(float))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, evidence (sum of weights) of each text."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(known.value.trigrams, known.value.pairs)
        for batch in batches:
            found = _evidence(shared.texts_of(batch), known.value, restorer)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(known.value, found)), pa.array(found[:, 0])],
                ["doc_id", "score", "evidence"],
            )

    return shared.arrow_map(
        docs.select("doc_id", "text"), work, "doc_id long, score double, evidence double"
    )


def restore(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the deobfuscated text (null stays null)."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(known.value.trigrams, known.value.pairs)
        for batch in batches:
            texts = [t if t is None else restorer.deobfuscated(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return shared.arrow_map(docs.select("doc_id", "text"), work, "doc_id long, text string")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: learn where crc32(doc_id) mod 3 is not 1, score every document."""
    docs, labels = (shared.read(spark, sf_dir, t) for t in ("documents", "labels"))
    part = F.coalesce(shared.fold("doc_id", 3) == 1, F.lit(False))
    model = fit(docs.filter(~part), labels.filter(~part))
    return score(docs, model).select(
        "doc_id",
        part.alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
        "evidence",
    )
