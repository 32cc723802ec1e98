"""Importance resampling towards a target distribution, on hashed word runs.

Texts are scanned by an Aho-Corasick automaton over whole words, set between delimiters. A word's
payload is the CRC-32 and the length of its bytes; the CRC of a run of words is composed from
neighbouring payloads without looking at the text again. The bucket of a run is its CRC modulo
``BUCKETS``; the buckets of the corpus and of the target are counted over all rows, and the
logarithm of their ratio is the gain of a bucket. A document's weight is the mean gain of its
runs; Gumbel noise drawn from its id and the weight make the score, and the highest scores are
drawn, which is sampling without replacement in proportion to the weights.

The automaton's words are those a worker has met repeatedly, up to ``DICTIONARY`` words; the CRC
of any other word is taken directly, so that results do not depend on what it holds.

Null texts have no word, weight 0 and are never drawn; a null id draws the noise of the empty
string. Repeated rows are scored and drawn as rows of their own. Other columns than id and text
do not matter; empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .ordering import numbered

BUCKETS = 10_000
SEED = "2024:"
LEAST_WORDS = 20
SHARE = 10
#: Words of a worker's automaton, and the longest of them in bytes.
DICTIONARY = 1 << 17
LONGEST = 48

_LENGTH = 32
#: Letters lower-cased, delimiters as blanks.
_PLAIN = np.where(shared.ALNUM, np.arange(256), 32).astype(np.uint8)
_PLAIN[65:91] += 32


def _shifts() -> np.ndarray:
    """How a CRC-32 changes when 2^k zero bytes are appended, for each k, byte of the CRC and
    value of that byte; the map is linear over the bits."""
    step = [int(zlib.crc32(b"\0", 1 << bit)) ^ int(zlib.crc32(b"\0", 0)) for bit in range(32)]
    tables = np.zeros((32, 4, 256), np.uint32)
    for k in range(32):
        for place in range(4):
            for bit in range(8):
                half = 1 << bit
                tables[k, place, half : 2 * half] = tables[k, place, :half] ^ np.uint32(step[8 * place + bit])
        step = [int(x) for x in _through(tables[k], np.array(step, np.uint32))]
    return tables


def _through(table: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    out = np.zeros(len(crcs), np.uint32)
    for place in range(4):
        out ^= table[place][(crcs >> np.uint32(8 * place)) & np.uint32(255)]
    return out


_SHIFTS = _shifts()


def composed(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC of two strings one behind the other, from theirs and the length of the second."""
    out = left.copy()
    for k in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero(lengths >> k & 1)
        out[at] = _through(_SHIFTS[k], out[at])
    return out ^ right


class Scanner:
    """Payloads of the words of texts."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        self.ready = False
        self.waiting: dict[str, int] = {}

    def payloads(self, line: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRCs and lengths of the words of a line that begins and ends with a blank, and where
        each word ends."""
        blank = np.frombuffer(line, np.uint8) == 32
        ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        found = np.full(len(ends), -1, np.int64)
        if self.ready:
            hits = chain.from_iterable(self.automaton.iter(line.decode("latin-1")))
            hits = np.fromiter(hits, np.int64).reshape(-1, 2)
            found[np.searchsorted(ends, hits[:, 0])] = hits[:, 1]
        missing = np.flatnonzero(found < 0)
        words = [line[a:b] for a, b in zip(starts[missing].tolist(), ends[missing].tolist())]
        values = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        found[missing] = values | (ends - starts)[missing] << _LENGTH
        self._learn(words)
        return (found & 0xFFFFFFFF).astype(np.uint32), found >> _LENGTH, ends

    def _learn(self, words: list[bytes]) -> None:
        room = DICTIONARY - len(self.automaton) - len(self.waiting)
        if room <= 0 and not self.waiting:
            return
        for word, count in Counter(words).items():
            if room > 0 and count > 1 and len(word) <= LONGEST and (key := word.decode("latin-1")) not in self.waiting:
                self.waiting[key] = zlib.crc32(word) | len(word) << _LENGTH
                room -= 1
        # Building again costs as much as all words: wait until enough of them are new.
        if room <= 0 or len(self.waiting) > 1000 + len(self.automaton) // 4:
            for key, payload in self.waiting.items():
                self.automaton.add_word(f" {key} ", payload)
            self.waiting = {}
            self.automaton.make_automaton()
            self.ready = True


def _scanned(texts: pa.Array, runs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For texts in bounded chunks: words a text, runs a text, buckets of the runs by text."""
    # A worker's scanner depends on no table.
    scanner = shared.held(Scanner, lambda make: make())
    for _, _, data, offsets in shared.chunks(texts):
        plain = _PLAIN[data].tobytes()
        ends = offsets.tolist()
        line = b" " + b" ".join(plain[a:b] for a, b in zip(ends, ends[1:])) + b" "
        crcs, lengths, places = scanner.payloads(line)
        # Text k lies k + 1 bytes further on, after one blank for each text before it.
        first = np.searchsorted(places, offsets + np.arange(len(offsets)), "right")
        first[0], first[-1] = 0, len(places)
        words = np.diff(first)
        text = np.repeat(np.arange(len(words)), words)
        owners, buckets, run = [text], [crcs % BUCKETS], crcs
        for n in range(1, runs):
            # Runs of n + 1 words: those of n, a blank and the word behind them.
            keep = text[: len(text) - n] == text[n:]
            blank = np.full(max(len(run) - 1, 0), zlib.crc32(b" "), np.uint32)
            run = composed(run[:-1], blank, np.ones(len(blank), np.int64))
            run = composed(run, crcs[n:], lengths[n:])
            owners.append(text[: len(text) - n][keep])
            buckets.append(run[keep] % BUCKETS)
        owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.int64)
        yield words, np.bincount(owner, minlength=len(words)), bucket[np.argsort(owner, kind="stable")]


def bucket_counts(rows: DataFrame, text: str = "text", runs: int = 1) -> np.ndarray:
    """How many runs of 1 to ``runs`` words of all rows fall into each bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, buckets in _scanned(shared.texts_of(batch, text), runs):
                total += np.bincount(buckets, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    parts = shared.arrow_map(rows.select(text), work, "bucket long, n long", holds=True)
    out = np.zeros(BUCKETS, np.int64)
    # One row a bucket reaches the driver.
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of the target's smoothed share over the corpus's, floored."""
    s, t = corpus.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", runs: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros((3, 0), np.int64)]
            for words, features, buckets in _scanned(shared.texts_of(batch, text), runs):
                sums = np.concatenate([[0], np.cumsum(gain[buckets])])
                ends = np.cumsum(features)
                total = sums[ends] - sums[ends - features]
                # Floor division: a mean below zero goes down as well.
                mean = np.where(features > 0, total // np.maximum(features, 1), 0)
                parts.append(np.stack([words, features, mean]))
            found = np.concatenate(parts, axis=1)
            ids = batch.column(batch.schema.get_field_index(doc_id))
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, found)], ["doc_id", "n_words", "n_features", "weight"])

    schema = f"doc_id {kind}, n_words long, n_features long, weight long"
    return shared.arrow_map(docs.select(doc_id, text), work, schema, holds=True)


def _noise() -> F.Column:
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
    runs: int = 1,
) -> DataFrame:
    """Every document with its weight, score and rank; the rank is null for those that are not
    among the ``share`` percent drawn of the documents of ``least_words`` words and more."""
    gain = gains(bucket_counts(docs, runs=runs), bucket_counts(target, runs=runs))
    scored = shared.stored(weights(docs, gain, runs=runs).withColumn("score", F.col("weight") + _noise()), "scored")
    fit = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features")]
    placed = numbered(scored.filter(fit), order, "place")
    drawn = placed.count() * share // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*columns, rank.alias("rank")).unionByName(
        scored.filter(~fit).select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Contract query: draw documents that are like the benchmark."""
    return resampled(shared.read(spark, sf_dir, "documents"), shared.read(spark, sf_dir, "benchmark"))


#: CRC-32 of a word's bytes, bit by bit (the polynomial is a fixed value).
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT,
  list_transform(range(1, octet_length(encode(w)) + 1), lambda i: ('0x' || substr(hex(encode(w)), (2 * i - 1)::BIGINT, 2))::UBIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda k: 0::UBIGINT)),
    lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))))"""

ORACLE = rf"""
WITH texts AS (
  SELECT 'd' AS side, row_number() OVER () AS n, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark
), words AS (
  SELECT side, n, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM texts
), buckets AS (
  SELECT w, CAST({_CRC} % {BUCKETS} AS BIGINT) AS bucket FROM (SELECT DISTINCT w FROM words)
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
  FROM words JOIN buckets USING (w) GROUP BY bucket
), gained AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + {BUCKETS})
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + {BUCKETS})))) AS BIGINT) AS gain
  FROM counts
), summed AS (
  SELECT n, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM words JOIN buckets USING (w) JOIN gained USING (bucket) WHERE side = 'd' GROUP BY n
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT + 0.5)::DOUBLE
      / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN summed USING (n) WHERE side = 'd'
), placed AS (
  SELECT *, CASE WHEN n_features >= {LEAST_WORDS} THEN row_number() OVER (
    PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST, n_features) END AS place
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT {SHARE} * count(*) // 100 FROM scored WHERE n_features >= {LEAST_WORDS}) THEN place END AS rank
FROM placed
"""
