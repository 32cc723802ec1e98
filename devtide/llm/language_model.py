"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are words (A-Z lower-cased) and an end. Every word of the training documents has a number:
the ``DIRECT`` most frequent ones by falling count, the others in the order of their hashes. The
trie's second level holds all pairs of words, the third all triples, counted over all training
documents, so the levels grow with them. A level lists for each context, in order, the words that
follow; the starts of these lists are an Elias-Fano sequence, and so are the words, each as the
context's number times the vocabulary plus its own, so that a lookup is a search for a successor
within the context's range. Probabilities are smoothed by absolute discounting and interpolation
down to the add-one unigrams, and kept as 8-bit logarithms, with the weight of the shorter context
for each context. Levels are files of flat arrays in the shared folder, and tasks map them into
memory: the second is cut by the first word, into more files for more tokens; the third is cut by
the place of its context among all pairs, so that the pairs of a frequent word are dealt to many
files. N-grams move to their files counted, sorted and packed.

The most frequent words' counts go to every task; numbers and counts of the others, however many
words there are, are files too.

Defined results: null is the empty text, which is one end; without training documents N and V
are 0 and every token has probability 1 (log 0); equal rows get equal results; very long texts
are taken whole. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .elias_fano import Sequence, mapped, write

#: Words whose counts every task holds (at most).
DIRECT = 1 << 18
#: Numbers of words lie below these in the levels: what the codes of n-grams have room for. More
#: words are an error, none is left out.
LEVELS = (1 << 31, 1 << 31)
DISCOUNT = 0.75
#: Files of the second level, and the tokens for a file from which they are doubled.
SHARDS = 64
_TOKENS = 1 << 22
#: Contexts in a file of the third level; words in a file of the less frequent ones.
_CONTEXTS = 1 << 18
_WORDS = 1 << 20
#: Steps of the 8-bit logarithms in a power of ten.
STEPS = 32
#: Hash of the end token (a fixed value).
END = int(shared.mix(np.array([0xE0D], np.uint64))[0])
#: Tokens that are looked up at once, or a batch's: each file is then asked for many at a time.
LOT = 800_000
#: Distinct n-grams that a task gathers before it gives them on.
_GATHERED = 800_000


def tokens_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, hashes of all tokens, row (from there) of each."""
    end = np.array([END], np.uint64)
    for first, _, data, offsets in shared.chunks(texts):
        words, begin, _, _ = shared.word_hashes(data, offsets)
        rows = len(offsets) - 1
        row = np.repeat(np.arange(rows), np.diff(begin))
        out, owner = np.empty(len(words) + rows, np.uint64), np.empty(len(words) + rows, np.int64)
        ends = begin[1:] + np.arange(rows)
        out[ends], owner[ends] = end, np.arange(rows)
        inner = np.arange(len(words)) + row
        out[inner], owner[inner] = words, row
        yield first, out, owner


def lots_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the tokens of several chunks of whole texts, row of each."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for first, tokens, row in tokens_of(texts):
        held.append((tokens, row + first))
        if sum(len(tokens) for tokens, _ in held) >= LOT:
            yield tuple(np.concatenate(part) for part in zip(*held, strict=True))
            held = []
    if held:
        yield tuple(np.concatenate(part) for part in zip(*held, strict=True))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
    return key[start], np.add.reduceat(count, start) if len(key) else count


def _gathered(parts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted numbers and their counts, added up as far as memory allows."""
    keys, counts, held = [], [], 0
    for part in parts:
        found, times = np.unique(part, return_counts=True)
        keys.append(found)
        counts.append(times)
        held += len(found)
        if held > _GATHERED:
            key, count = _summed(keys, counts)
            keys, counts, held = [key], [count], len(key)
            if held > _GATHERED // 2:
                yield key, count
                keys, counts, held = [], [], 0
    if keys:
        yield _summed(keys, counts)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, so that equal high bytes lie together."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _packed(key: np.ndarray, count: np.ndarray) -> bytes:
    """Rising numbers as differences, and their counts."""
    data = _planes(np.diff(key, prepend=key.dtype.type(0))) + _planes(count)
    return len(key).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 16 * n, "zstd", asbytes=True), np.uint8)
    delta, count = (np.ascontiguousarray(p.reshape(8, n).T).view("<u8").ravel() for p in (planes[: 8 * n], planes[8 * n :]))
    return np.cumsum(delta, dtype=np.uint64), count.astype(np.int64)


def _united(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all parts in order, with their counts added up."""
    keys, counts, held, least = [], [], 0, _GATHERED
    for part in table["part"]:
        key, count = _unpacked(part.as_py())
        keys.append(key)
        counts.append(count)
        held += len(key)
        if held > 2 * least:
            key, count = _summed(keys, counts)
            keys, counts, held, least = [key], [count], len(key), max(least, len(key))
    return _summed(keys, counts)


def word_counts(docs: DataFrame) -> DataFrame:
    """``key`` (hash of the token) and ``c`` over all ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _gathered(tokens for b in batches for _, tokens, _ in tokens_of(shared.texts_of(b)))
        for key, count in found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(count)], ["key", "c"]
            )

    counted = shared.arrow_map(docs.select("text"), work, "key long, c long")
    return counted.groupBy("key").agg(F.sum("c").alias("c"))


@dataclass
class Words:
    """The most frequent words: sorted hashes, their numbers, counts by number; and N, V."""

    hashes: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """Numbers of the tokens; -1 for other words."""
        if not len(self.hashes):
            return np.full(len(tokens), -1)
        shift, first = self.directory
        at = first[tokens >> shift]
        # A few hashes at most have the same first bits.
        last = len(self.hashes) - 1
        behind = np.flatnonzero((self.hashes[at] < tokens) & (at < last))
        while len(behind):
            at[behind] += 1
            here = at[behind]
            behind = behind[(self.hashes[here] < tokens[behind]) & (here < last)]
        return np.where(self.hashes[at] == tokens, self.numbers[at], -1)

    @cached_property
    def directory(self) -> tuple[np.uint64, np.ndarray]:
        """Bits to cut off a hash, and for each value of the others the place of the first word
        whose hash is not below (the last place at most)."""
        bits = len(self.hashes).bit_length()
        shift = np.uint64(64 - bits)
        first = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << shift)
        return shift, np.minimum(first, len(self.hashes) - 1)

    @property
    def floor(self) -> float:
        """log10 of what an add-one count is divided by."""
        return float(np.log10(max(self.total + self.distinct + 1, 1)))


def frequent_words(counts: DataFrame, most: int = DIRECT) -> Words:
    """The words above the lowest count at which they are ``most`` at most. Counts are looked up
    by steps of a 64th of an octave, so what reaches the driver is bounded."""
    step = F.floor(F.log2("c") * 64)
    sizes = counts.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("words"), F.sum("c").alias("tokens")
    )
    rows = sorted((tuple(r) for r in sizes.collect()), reverse=True)
    above, lowest = 0, None
    for at, words, _ in rows:
        if above + words > most:
            break
        above, lowest = above + words, at
    found = [] if lowest is None else counts.filter(step >= lowest).collect()
    key = np.array([r["key"] for r in found], np.int64).view(np.uint64)
    count = np.array([r["c"] for r in found], np.int64)
    order = np.lexsort((key, -count))
    numbers = np.empty(len(key), np.int64)
    numbers[order] = np.arange(len(key))
    by_hash = np.argsort(key)
    return Words(
        key[by_hash],
        numbers[by_hash],
        count[order],
        sum(r[2] for r in rows),
        sum(r[1] for r in rows),
    )


def _file_of_word(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def number_words(counts: DataFrame, words: Words, folder: str) -> None:
    """Files of the words that are not among ``words``: by the first bits of their hashes, sorted
    hashes and counts; and the file ``shape`` of what is common to all levels."""
    direct = len(words.counts)
    bits = max(4, (max(words.distinct - direct, 1) // _WORDS).bit_length())
    rare = counts.filter(F.col("c") < int(words.counts[-1])) if direct else counts
    rows = rare.select(F.shiftrightunsigned("key", 64 - bits).cast("int").alias("file"), "key", "c")

    def work(key: tuple, table: pa.Table) -> pa.Table:
        file, hashes = key[0].as_py(), np.array(table["key"], np.int64).view(np.uint64)
        order = np.argsort(hashes)
        write(folder, f"words-{file:05d}", {"hashes": hashes[order], "counts": np.array(table["c"], np.int64)[order]})
        return pa.table({"file": pa.array([file], pa.int32()), "size": pa.array([len(hashes)], pa.int64())})

    sizes = np.zeros(1 << bits, np.int64)
    for r in rows.groupBy("file").applyInArrow(work, "file int, size long").collect():
        sizes[r["file"]] = r["size"]
    shards = SHARDS << max(0, (words.total // (SHARDS * _TOKENS)).bit_length())
    starts = np.concatenate([[0], np.cumsum(sizes)]) + direct
    if starts[-1] > LEVELS[0]:
        raise OverflowError("more words than codes of pairs have room for")
    write(folder, "shape", {"words": starts, "cut": np.array([shards, _CONTEXTS])})


def _counted(docs: DataFrame, folder: str, words: Words, order: int, span: int, files: int) -> DataFrame:
    """``file`` and ``part`` (packed codes within the file, counts) of the n-grams of ``docs``. A
    file has ``span`` codes."""
    known = docs.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(folder, known.value)

        def parts() -> Iterator[np.ndarray]:
            for batch in batches:
                for tokens, row in lots_of(shared.texts_of(batch)):
                    yield trie.codes(order, trie.numbers(tokens), row)

        for key, count in _gathered(parts()):
            if not len(key):
                continue
            file = (key // np.uint64(span)).astype(np.int64)
            start = np.flatnonzero(np.diff(file, prepend=-1))
            ends = np.append(start[1:], len(key))
            inner = key - file.astype(np.uint64) * np.uint64(span)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(file[start], pa.int64()),
                    pa.array([_packed(inner[i:j], count[i:j]) for i, j in zip(start, ends, strict=True)], pa.binary()),
                ],
                ["file", "part"],
            )

    rows = shared.arrow_map(docs.select("text"), work, "file long, part binary")
    return rows.repartition(max(1, files), "file")


def _quantised(probability: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-np.log10(probability) * STEPS), 0, 255).astype(np.uint8)


class Level:
    """One file: contexts in order, the words that follow each, and their logarithms."""

    def __init__(self, parts: dict[str, np.ndarray], vocabulary: int) -> None:
        self.starts = Sequence({k[7:]: v for k, v in parts.items() if k.startswith("starts.")})
        self.words = Sequence({k[6:]: v for k, v in parts.items() if k.startswith("words.")})
        self.logs, self.backoff, self.vocabulary = parts["logs"], parts["backoff"], vocabulary

    @staticmethod
    def arrays(
        context: np.ndarray, word: np.ndarray, logs: np.ndarray, backoff: np.ndarray, vocabulary: int
    ) -> dict[str, np.ndarray]:
        """``context`` and ``word`` sorted; ``backoff`` for each context."""
        starts = np.searchsorted(context, np.arange(len(backoff) + 1))
        values = context.astype(np.uint64) * np.uint64(vocabulary) + word.astype(np.uint64)
        out = {"logs": logs, "backoff": backoff}
        for name, part in (
            ("starts", Sequence.encode(starts, len(word) + 1)),
            ("words", Sequence.encode(values, (len(backoff) + 1) * vocabulary)),
        ):
            out |= {f"{name}.{k}": v for k, v in part.items()}
        return out

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the word among its context's followers (in the whole level), and whether it
        is there."""
        wanted = context.astype(np.uint64) * np.uint64(self.vocabulary) + word.astype(np.uint64)
        return self.words.successor(wanted)

    def followers(self, context: int) -> np.ndarray:
        first, last = self.starts.at(np.array([context, context + 1])).astype(np.int64)
        found = self.words.at(np.arange(first, last))
        return (found - np.uint64(context) * np.uint64(self.vocabulary)).astype(np.int64)


class Trie:
    """The levels' files, opened when they are needed."""

    def __init__(self, folder: str, words: Words) -> None:
        self.folder, self.words = folder, words
        self.levels: dict[tuple[int, int], Level | None] = {}
        self.rare: dict[int, dict[str, np.ndarray] | None] = {}
        shape = mapped(folder, "shape")
        self.starts = shape["words"]
        self.shards, self.contexts = (int(x) for x in shape["cut"])
        self.vocabulary = int(self.starts[-1])
        #: Contexts of a file of the second level.
        self.width = self.vocabulary // self.shards + 1
        self._places: np.ndarray | None = None

    @property
    def places(self) -> np.ndarray:
        """First place of each file of the second level among all pairs."""
        if self._places is None:
            self._places = mapped(self.folder, "places")["places"]
        return self._places

    def level(self, order: int, shard: int) -> Level | None:
        if (order, shard) not in self.levels:
            parts = mapped(self.folder, f"level{order}-{shard:03d}")
            self.levels[order, shard] = parts and Level(parts, self.vocabulary)
        return self.levels[order, shard]

    def _rare(self, file: int) -> dict[str, np.ndarray] | None:
        if file not in self.rare:
            self.rare[file] = mapped(self.folder, f"words-{file:05d}")
        return self.rare[file]

    def numbers(self, tokens: np.ndarray) -> np.ndarray:
        """Numbers of the tokens; -1 for words that were not seen."""
        out = self.words.of(tokens)
        at = np.flatnonzero(out < 0)
        if not len(at) or self.vocabulary == len(self.words.counts):
            return out
        hashes, back = np.unique(tokens[at], return_inverse=True)
        found = np.full(len(hashes), -1)
        file = _file_of_word(hashes, (len(self.starts) - 1).bit_length() - 1)
        for k in np.unique(file).tolist():
            if (part := self._rare(k)) is None:
                continue
            here = np.flatnonzero(file == k)
            place = np.minimum(np.searchsorted(part["hashes"], hashes[here]), len(part["hashes"]) - 1)
            same = part["hashes"][place] == hashes[here]
            found[here[same]] = self.starts[k] + place[same]
        out[at] = found[back]
        return out

    def counts(self, number: np.ndarray) -> np.ndarray:
        """Counts of the words; 0 for those that were not seen."""
        out = np.zeros(len(number), np.int64)
        direct = len(self.words.counts)
        near = (number >= 0) & (number < direct)
        out[near] = self.words.counts[number[near]]
        at = np.flatnonzero(number >= direct)
        file = np.searchsorted(self.starts, number[at], "right") - 1
        for k in np.unique(file).tolist():
            here = at[file == k]
            out[here] = self._rare(k)["counts"][number[here] - self.starts[k]]
        return out

    def unigrams(self, number: np.ndarray) -> np.ndarray:
        return np.log10(self.counts(number) + 1.0) - self.words.floor

    def codes(self, order: int, number: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Codes of all pairs or triples within rows; all words have numbers. The file is the
        code's highest part, then the context in it, then the word."""
        size = np.uint64(self.vocabulary)
        here = np.flatnonzero(row[order - 1 :] == row[: 1 - order])
        if order == 2:
            a, last = number[here], number[here + 1]
            context = a % self.shards * self.width + a // self.shards
        else:
            last = number[here + 2]
            key, back = np.unique(number[here] * self.vocabulary + number[here + 1], return_inverse=True)
            context = self.pairs(key // max(self.vocabulary, 1), key % max(self.vocabulary, 1))[1][back]
        return context.astype(np.uint64) * size + last.astype(np.uint64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each pair: logarithm (nan if it is not there), place among all pairs, backoff of
        its context."""
        logs, place, back = np.full(len(a), np.nan), np.full(len(a), -1), np.zeros(len(a))
        order = np.argsort(a % self.shards, kind="stable")
        cuts = np.searchsorted((a % self.shards)[order], np.arange(self.shards + 1))
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            level, at = self.level(2, shard), order[cuts[shard] : cuts[shard + 1]]
            if level is None:
                continue
            at = at[a[at] // self.shards < len(level.backoff)]
            context = a[at] // self.shards
            found, equal = level.find(context, b[at])
            logs[at[equal]] = level.logs[found[equal]] / -STEPS
            place[at[equal]] = found[equal] + (self.places[shard] if equal.any() else 0)
            back[at] = level.backoff[context] / -STEPS
        return logs, place, back

    def triples(self, place: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words after the pair at ``place``: logarithm, backoff."""
        logs, back = np.full(len(place), np.nan), np.zeros(len(place))
        order = np.argsort(place, kind="stable")
        file = place[order] // self.contexts
        start = np.flatnonzero(np.diff(file, prepend=-1))
        for i, j in zip(start, np.append(start[1:], len(place)), strict=True):
            level, at = self.level(3, int(file[i])), order[i:j]
            if level is None:
                continue
            at = at[place[at] % self.contexts < len(level.backoff)]
            context = place[at] % self.contexts
            found, equal = level.find(context, c[at])
            logs[at[equal]] = level.logs[found[equal]] / -STEPS
            back[at] = level.backoff[context] / -STEPS
        return logs, back

    def seconds(self, first: int, last: int) -> np.ndarray:
        """Second words of the pairs at the places from ``first`` to before ``last``."""
        found = []
        for shard in range(self.shards):
            a, b = (int(min(max(x, self.places[shard]), self.places[shard + 1])) for x in (first, last))
            if a < b:
                values = self.level(2, shard).words.at(np.arange(a, b) - self.places[shard])
                found.append((values % np.uint64(self.vocabulary)).astype(np.int64))
        return np.concatenate(found)

    def scores(self, number: np.ndarray, row: np.ndarray, single: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each token after the two before it (``single``: alone)."""
        out = self.unigrams(number) if single is None else single.copy()
        n, size = len(number), self.vocabulary
        # Pairs: equal ones are looked up once.
        same = np.zeros(n, bool)
        same[1:] = row[1:] == row[:-1]
        before = np.concatenate([[-1], number[:-1]])
        at = np.flatnonzero(same & (before >= 0))
        if not len(at):
            return out
        inside = np.where(number[at] >= 0, number[at], size)
        key, back = np.unique(before[at] * (size + 1) + inside, return_inverse=True)
        logs, place, weight = self.pairs(key // (size + 1), key % (size + 1))
        logs, place, weight = logs[back], place[back], weight[back]
        seen = ~np.isnan(logs) & (inside < size)
        out[at] = np.where(seen, logs, weight + out[at])
        places = np.full(n, -1)
        places[at] = np.where(seen, place, -1)
        # Triples: the pair before the token is its context, if it is there itself.
        context = np.concatenate([[-1], places[:-1]])
        at = np.flatnonzero(same & (context >= 0))
        if not len(at):
            return out
        inside = np.where(number[at] >= 0, number[at], size)
        key, back = np.unique(context[at] * (size + 1) + inside, return_inverse=True)
        logs, weight = self.triples(key // (size + 1), key % (size + 1))
        logs, weight = logs[back], weight[back]
        out[at] = np.where(np.isnan(logs) | (inside == size), weight + out[at], logs)
        return out


def build(docs: DataFrame) -> tuple[str, Words, DataFrame]:
    """Train on ``docs``: the folder of the levels, the frequent words, all word counts."""
    spark = docs.sparkSession
    counts = shared.stored(word_counts(docs), "words")
    words = frequent_words(counts)
    folder = shared.fresh(spark, "trie")
    number_words(counts, words, folder)
    shape = Trie(folder, words)
    size, shards, width, contexts = shape.vocabulary, shape.shards, shape.width, shape.contexts
    known = spark.sparkContext.broadcast(words)

    def save(file: int, order: int, context: np.ndarray, word: np.ndarray, c: np.ndarray, lower: np.ndarray) -> pa.Table:
        # A context is followed by a token each time, so its count is that of its followers.
        total = np.bincount(context, c)
        held = (c - DISCOUNT) / total[context]
        rest = 1 - np.bincount(context, held)
        logs = _quantised(held + rest[context] * lower)
        write(folder, f"level{order}-{file:03d}", Level.arrays(context, word, logs, _quantised(rest), size))
        return pa.table({"file": pa.array([file], pa.int64()), "size": pa.array([len(word)], pa.int64())})

    def second(key: tuple, table: pa.Table) -> pa.Table:
        code, c = _united(table)
        context, b = (code // np.uint64(size)).astype(np.int64), (code % np.uint64(size)).astype(np.int64)
        return save(key[0].as_py(), 2, context, b, c, 10 ** Trie(folder, known.value).unigrams(b))

    def third(key: tuple, table: pa.Table) -> pa.Table:
        file, trie = key[0].as_py(), Trie(folder, known.value)
        code, c = _united(table)
        context, last = (code // np.uint64(size)).astype(np.int64), (code % np.uint64(size)).astype(np.int64)
        # The shorter context of each, whose pair with the last word was counted as well.
        b = trie.seconds(file * contexts, file * contexts + int(context[-1]) + 1)[context]
        pair, back = np.unique(b * size + last, return_inverse=True)
        lower = 10 ** trie.pairs(pair // size, pair % size)[0][back]
        return save(file, 3, context, last, c, lower)

    schema = "file long, size long"
    sizes = np.zeros(shards, np.int64)
    grams = _counted(docs, folder, words, 2, max(width * size, 1), shards)
    for r in grams.groupBy("file").applyInArrow(second, schema).collect():
        sizes[r["file"]] = r["size"]
    places = np.concatenate([[0], np.cumsum(sizes)])
    write(folder, "places", {"places": places})
    pairs = int(places[-1])
    if pairs * (size + 1) >= 1 << 63:
        raise OverflowError("more pairs than codes of triples have room for")
    files = -(-pairs // contexts)
    grams = _counted(docs, folder, words, 3, max(contexts * size, 1), files)
    grams.groupBy("file").applyInArrow(third, schema).agg(F.sum("size")).collect()
    return folder, words, counts


def score(docs: DataFrame, folder: str, words: Words, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of each row."""
    known = docs.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(folder, known.value)
        for batch in batches:
            n = len(batch)
            size, found = np.zeros(n, np.int64), np.zeros(n, np.int64)
            base, model = np.zeros(n), np.zeros(n)
            for tokens, row in lots_of(shared.texts_of(batch)):
                number = trie.numbers(tokens)
                single = trie.unigrams(number)
                size += np.bincount(row, minlength=n)
                found += np.bincount(row[number >= 0], minlength=n)
                base += np.bincount(row, single, n)
                model += np.bincount(row, trie.scores(number, row, single), n)
            if not n:
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(found), pa.array(base), pa.array(model)],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    return shared.arrow_map(
        docs.select("doc_id", "text"),
        work,
        "doc_id long, n_tokens long, n_known long, base_score double, score double",
    )


def op10_lm_scores(spark, sf_dir: str) -> DataFrame:
    """Contract query: train where crc32(doc_id) mod 7 is not 2, score every document."""
    docs = shared.read(spark, sf_dir, "documents")
    part = F.coalesce(shared.fold("doc_id", 7) == 2, F.lit(False))
    folder, words, counts = build(docs.filter(~part))
    return score(docs, folder, words, counts).select(
        "doc_id",
        F.coalesce(shared.fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(words.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
