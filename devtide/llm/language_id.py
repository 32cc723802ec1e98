"""Language identification by nearest centroids.

A text is the vector of its hashed byte trigrams (ASCII letters lower-cased, everything in
ASCII that is no letter as one blank), weighted by log term frequency and inverse document
frequency and scaled to length 1. Each language has up to ``CLUSTERS`` centroids, found by
spherical k-means; the nearest centroid by cosine names the language. A text is rejected if its
cosine is below that of almost all labelled texts of the language which were not clustered, cut to
the same length.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected;
if nothing can be learned (no labelled row), all rows are; repeated rows get equal results;
ties go to the first language in byte order and its first centroid. Other columns of the
input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Buckets of the hashed trigrams (a power of two).
FEATURES = 1 << 13
#: Centroids per language.
CLUSTERS = 3
#: Clusters are found on about this many labelled texts per language, chosen by a hash of the id,
#: and on no more than twice as many; as many others set the limits of rejection. Document frequencies cover all of them.
SAMPLE = 400
#: A text is rejected below this quantile of the cosines of labelled texts that were not
#: clustered, at the text's length (in trigrams; between two lengths, in proportion).
REJECT_QUANTILE = 0.01
LENGTHS = 2 ** np.arange(1, 12)
#: Without such texts, below this share of the lowest cosine among the clustered ones.
REJECT_SHARE = 0.1
_STEPS = 12

_FOLD = np.zeros(256, np.uint32)
_FOLD[128:] = np.arange(128, 256)
for _i in range(26):
    _FOLD[65 + _i] = _FOLD[97 + _i] = 97 + _i
_SLICE = 64
_LOG = np.log1p(np.arange(1 << 16))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floors: np.ndarray


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts, and where those of each text begin. Each text stands
    between blanks; blanks next to each other count once."""
    n = len(offsets) - 1
    at = np.repeat(np.arange(1, n + 1), np.diff(offsets)) + np.arange(len(data))
    letters = np.zeros(len(data) + n + 1, np.uint32)
    letters[at] = _FOLD[data]
    edge = offsets + np.arange(n + 1)
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] > 0) | (letters[:-1] > 0)
    keep[edge] = True
    place = np.cumsum(keep)[edge] - 1
    x = np.append(letters[keep], np.uint32(0))
    mixed = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA6B)
    mixed = (mixed + x[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    grams = (mixed >> np.uint32(32 - (FEATURES.bit_length() - 1))).astype(np.int64)
    # The trigram around the blank between two texts belongs to neither.
    inner = np.ones(len(grams), bool)
    inner[place[1:] - 1] = False
    return grams[inner], place - np.arange(n + 1)


def _counts(grams: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and count of all that occur, in order of the rows."""
    rows = len(first) - 1
    row = np.repeat(np.arange(rows) * FEATURES, np.diff(first))
    counts = np.bincount(row + grams[first[0] : first[-1]], minlength=rows * FEATURES)
    at = np.flatnonzero(counts)
    return at // FEATURES, at % FEATURES, counts[at]


def _weights(row: np.ndarray, feature: np.ndarray, count: np.ndarray, idf: np.ndarray, rows: int):
    """Weights of the vectors scaled to length 1."""
    weight = _LOG[np.minimum(count, len(_LOG) - 1)] * idf[feature]
    norm = np.sqrt(np.bincount(row, weight * weight, minlength=rows))
    return weight / np.maximum(norm, 1e-9)[row]


def _each(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First and end of some rows, and their rows (from 0), features and counts."""
    for first, _, data, offsets in shared.chunks(texts):
        grams, begin = _features(data, offsets)
        for a in range(0, len(offsets) - 1, _SLICE):
            b = min(a + _SLICE, len(offsets) - 1)
            yield first + a, first + b, *_counts(grams, begin[a : b + 1])


def _dense(texts: pa.Array, idf: np.ndarray) -> np.ndarray:
    vectors = np.zeros((len(texts), FEATURES), np.float32)
    for a, b, row, feature, count in _each(texts):
        vectors[a + row, feature] = _weights(row, feature, count, idf, b - a)
    return vectors


def _cosines(texts: pa.Array, model: Model) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and end of some rows, their cosines and their numbers of trigrams."""
    columns = np.ascontiguousarray(model.centroids.T)
    for a, b, row, feature, count in _each(texts):
        weight = _weights(row, feature, count, model.idf, b - a)
        out = np.zeros((b - a, columns.shape[1]))
        if len(row):
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            out[row[starts]] = np.add.reduceat(columns[feature] * weight[:, None], starts, axis=0)
        yield a, b, out, np.bincount(row, count, minlength=b - a)


def _floors(texts: pa.Array, idf: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each of ``LENGTHS``, the low quantile of the cosines of the texts' beginnings of that
    length with their nearest centroid; lower where it stands on few texts."""
    cosines: list[list[np.ndarray]] = [[] for _ in LENGTHS]
    columns = np.ascontiguousarray(centroids.T)
    for _, _, data, offsets in shared.chunks(texts):
        grams, begin = _features(data, offsets)
        size = np.diff(begin)
        for k, length in enumerate(LENGTHS):
            long = np.flatnonzero(size >= length)
            for part in (long[a : a + _SLICE] for a in range(0, len(long), _SLICE)):
                cut = grams[begin[part][:, None] + np.arange(length)].ravel()
                row, feature, count = _counts(cut, np.arange(len(part) + 1) * length)
                weight = _weights(row, feature, count, idf, len(part))
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                near = np.add.reduceat(columns[feature] * weight[:, None], starts, axis=0)
                cosines[k].append(near.max(axis=1))
    floors, enough, last = np.zeros(len(LENGTHS)), len(texts) / 8, 0.0
    for k, found in enumerate(cosines):
        near = np.concatenate(found) if found else np.zeros(0)
        if len(near) and len(near) >= enough:
            low = np.quantile(near, REJECT_QUANTILE, method="lower")
            last = float(low) * (1 - 1 / np.sqrt(len(near) + 1))
        floors[k] = last
    return floors


def _letters(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)


def labelled(docs: DataFrame) -> DataFrame:
    """The rows to learn from: a text with a letter and a language."""
    return docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("doc_id", "text", "lang")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES + 1, np.int64)
    for batch in batches:
        texts = shared.texts_of(batch)
        total[FEATURES] += len(texts)
        for _, _, _, feature, _ in _each(texts):
            total[:FEATURES] += np.bincount(feature, minlength=FEATURES)
    yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})


def _cluster(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-point seeds; centroids and each row's nearest."""
    mean = vectors.sum(0)
    seeds = [int(np.argmax(vectors @ mean))]
    best = vectors @ vectors[seeds[0]]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int(np.argmin(best)))
        best = np.maximum(best, vectors @ vectors[seeds[-1]])
    centroids = vectors[seeds]
    for _ in range(_STEPS):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack(
            [vectors[own == c].sum(0) if (own == c).any() else centroids[c] for c in range(len(seeds))]
        )
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-9)[:, None]
    return centroids.astype(np.float32), np.argmax(vectors @ centroids.T, axis=1)


def fit(docs: DataFrame) -> Model:
    """Learn from ``text`` and ``lang`` of all rows given. Document frequencies are summed
    over every row; clusters are found per language on the sample."""
    rows = labelled(docs)
    sums = shared.tree_sum(
        shared.arrow_map(rows.select("text"), _frequencies, "part binary"),
        "part",
        "int64",
        FEATURES + 1,
    )
    idf = np.log((1 + sums[-1]) / (1 + sums[:-1])).astype(np.float32) + np.float32(1)
    # One row per language, as many as the model has names for.
    sizes = rows.groupBy("lang").count().collect()
    chances = [x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, 2 * SAMPLE / r["count"])))]
    chance = F.create_map(*chances)[F.col("lang")] if chances else F.lit(0.0)
    place = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(place < chance).select("lang", "text", place.alias("place"))
    shared_idf = rows.sparkSession.sparkContext.broadcast(idf)

    def per_language(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("text", "ascending")]).slice(0, 4 * SAMPLE)
        texts = pc.fill_null(table["text"].combine_chunks().cast(pa.large_string()), "")
        # Every other one is kept back. Texts that are equal stay on one side.
        texts = pc.unique(texts)
        rest, texts = texts.take(np.arange(1, len(texts), 2)), texts.take(np.arange(0, len(texts), 2))
        vectors = _dense(texts, shared_idf.value)
        centroids, own = _cluster(vectors, CLUSTERS)
        near = np.einsum("ij,ij->i", vectors, centroids[own])
        used = np.unique(own)
        if len(rest):
            floors = [_floors(rest, shared_idf.value, centroids[used])] * len(used)
        else:
            floors = [np.full(len(LENGTHS), near[own == c].min() * REJECT_SHARE) for c in used]
        return pa.table(
            {
                "lang": [key[0].as_py()] * len(used),
                "centroid": [centroids[c].astype(np.float32).tobytes() for c in used],
                "floors": [f.astype(np.float64).tobytes() for f in floors],
            }
        )

    found = sorted(
        sample.groupBy("lang")
        .applyInArrow(per_language, "lang string, centroid binary, floors binary")
        .collect(),
        key=lambda r: (r["lang"].encode(), r["centroid"]),
    )
    names = sorted({r["lang"] for r in found}, key=str.encode)
    return Model(
        names,
        idf,
        np.stack([np.frombuffer(r["centroid"], np.float32) for r in found])
        if found
        else np.zeros((0, FEATURES), np.float32),
        np.array([names.index(r["lang"]) for r in found], np.int64),
        np.array([np.frombuffer(r["floors"]) for r in found]).reshape(-1, len(LENGTHS)),
    )


def _nearest(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    n = len(texts)
    lang, score = np.zeros(n, np.int64), np.zeros(n)
    floor, margin = np.ones(n), np.zeros(n)
    known = _letters(texts) & (len(model.centroids) > 0)
    if known.any():
        for a, b, cosine, size in _cosines(texts, model):
            best = np.argmax(cosine, axis=1)
            lang[a:b] = model.owner[best]
            score[a:b] = cosine[np.arange(b - a), best]
            at = np.clip(np.log2(np.maximum(size, 1)) - np.log2(LENGTHS[0]), 0, len(LENGTHS) - 1)
            low = np.minimum(at.astype(np.int64), len(LENGTHS) - 2)
            limits = model.floors[best]
            below, above = limits[np.arange(b - a), low], limits[np.arange(b - a), low + 1]
            floor[a:b] = below + (above - below) * (at - low)
            rest = np.where(model.owner[None, :] == lang[a:b, None], 0.0, cosine).max(axis=1)
            margin[a:b] = score[a:b] - rest
    score = np.where(known, np.clip(score, 0, 1), 0.0)
    names = [model.languages[k] if ok else "und" for k, ok in zip(lang, known, strict=True)]
    return names, score, np.where(known, margin, 0.0), ~known | (score < floor)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, margin (to the best other language), rejected per row."""
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, margin, rejected = _nearest(shared_model.value, shared.texts_of(batch))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "lang_pred": pa.array(names, pa.string()),
                    "score": score,
                    "margin": margin,
                    "rejected": rejected,
                }
            )

    return shared.arrow_map(
        docs.select("doc_id", "text"),
        work,
        "doc_id long, lang_pred string, score double, margin double, rejected boolean",
    )


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not rejected, with all their columns; nothing is shuffled."""
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = _nearest(shared_model.value, shared.texts_of(batch))[3]
            yield batch.filter(pa.array(~rejected))

    return shared.arrow_map(docs, work, docs.schema)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query: learn where crc32(doc_id) mod 4 is not 2, predict every document."""
    docs = shared.read(spark, sf_dir, "documents")
    part = F.coalesce(shared.fold("doc_id", 4) == 2, F.lit(False))
    model = fit(docs.filter(~part))
    return predict(docs, model).select(
        "doc_id", part.alias("held_out"), "lang_pred", "score", "margin", "rejected"
    )
