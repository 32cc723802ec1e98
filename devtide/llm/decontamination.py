"""Benchmark decontamination: BM25 over an inverted index of the test items.

Texts are lower-cased words of ASCII letters, digits and all that is beyond ASCII. Every
training document is cut into overlapping passages of ``WINDOW`` words, and each passage is a
query. A score is the part of an item's own BM25 weight that the passage holds (of its best
``WINDOW`` words, if it is longer), so one threshold fits all items. The items stand in ``GROUPS`` blocks; passages whose words cannot
reach it with the highest weights of any block go at once, for whole batches together; the rest
are searched by block-max WAND, and all items above the threshold are retrieved. A retrieved item is a leak if the words around the passage
hold enough of its question and of its answer in the item's order (runs of ``RUN`` words).

The index is held in blocks of about ``ITEMS`` items: each block is broadcast (its size is
bounded) and meets all documents.

Defined results: texts that are null or have no word, and items without a word, leak nothing;
an item that is there twice, or two equal items, are reported by their ids, each id once a
document; an empty benchmark leaves all documents as they are; repeated documents get equal
results. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Words from one passage's start to the next; a passage has two such steps.
STRIDE = 32
WINDOW = 2 * STRIDE
#: Part of an item's weight from which a passage retrieves it.
THRESHOLD = 0.6
K1, B = 1.2, 0.75
#: Words in a row that count as the same, and the parts of the question, of the answer and of
#: the whole item that make a leak: both parts, or the whole.
RUN = 3
PART_OVERLAP, WHOLE_OVERLAP = 0.5, 0.7
#: Items of a block of the index, postings of a block within a list, and groups of items whose
#: highest weights bound a passage before it is searched.
ITEMS, POSTINGS, GROUPS = 4096, 64, 64
_STEPS = 512

_ANSWER = re.compile(r"\b(?:answer|antwort|réponse|respuesta)\s*:", re.IGNORECASE)
_SENTENCE = re.compile(r"[.!?]\s+(?=\S)")
LEAKS = (
    "doc_id long, item_id long, score double, n_passages int,"
    " question_overlap double, answer_overlap double"
)


def _words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    lowered = pc.utf8_lower(texts)
    for first, end, data, offsets in shared.chunks(lowered):
        hashes, begin, _, _ = shared.word_hashes(data, offsets, shared.ALNUM)
        yield first, end, hashes, begin


def _words_of(text: str) -> np.ndarray:
    return next(_words(pa.array([text], pa.large_string())))[2]


def question_end(text: str) -> int:
    """Where the answer begins: after a mark such as "Answer:", else after the first question
    mark, else with the last sentence; a single sentence is all question."""
    if marks := list(_ANSWER.finditer(text)):
        return marks[-1].start()
    if 0 <= (at := text.find("?")) < len(text.rstrip()) - 1:
        return at + 1
    ends = [m.end() for m in _SENTENCE.finditer(text.rstrip())]
    return ends[-1] if ends else len(text)


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    question: int
    runs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))


@dataclass
class Index:
    items: list[Item]
    words: np.ndarray
    #: By word: items, weights, highest weight of each block of postings, highest weight.
    postings: list[tuple[list[int], list[float], list[float], float]]
    highest: np.ndarray
    #: By word (one more row, of no word) and group of items: the highest weight.
    groups: np.ndarray


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    last = max(len(words) - size + 1, 0)
    out = np.zeros(last, np.uint64)
    for k in range(size):
        out += words[k : last + k] * shared.MULTIPLIERS[40 + k]
    return shared.mix(out)


def _starts(words: int) -> range:
    return range(0, max(1, words - WINDOW + STRIDE), STRIDE)


def make_index(rows: list, weights: dict[int, float], mean: float) -> Index:
    """``rows``: item_id and text. ``weights``: inverse document frequency by word."""
    items, lists = [], {}
    for item_id, text in rows:
        words = _words_of(text or "")
        if not len(words):
            continue
        item = Item(item_id, words, len(_words_of(text[: question_end(text)])))
        item.runs = _runs(words, min(RUN, len(words)))
        found, counts = np.unique(words, return_counts=True)
        length = K1 * (1 - B + B * len(words) / mean)
        gain = {
            int(w): weights[int(w)] * c * (K1 + 1) / (c + length)
            for w, c in zip(found, counts, strict=True)
        }
        whole = max(
            sum(gain[w] for w in {*words[a : a + WINDOW].tolist()}) for a in _starts(len(words))
        )
        for w, g in gain.items():
            lists.setdefault(w, []).append((len(items), g / whole))
        items.append(item)
    known = np.array(sorted(lists), np.uint64)
    postings = []
    for w in known.tolist():
        where, parts = [p[0] for p in lists[w]], [p[1] for p in lists[w]]
        blocks = [max(parts[k : k + POSTINGS]) for k in range(0, len(parts), POSTINGS)]
        postings.append((where, parts, blocks, max(parts)))
    highest = np.array([p[3] for p in postings])
    groups = np.zeros((len(known) + 1, GROUPS), np.float32)
    for k, (where, parts, _, _) in enumerate(postings):
        np.maximum.at(groups[k], np.array(where) * GROUPS // max(len(items), GROUPS), parts)
    return Index(items, known, postings, highest, groups)


def search(index: Index, words: list[int], least: float = THRESHOLD) -> list[tuple[int, float]]:
    """All items whose weights over the distinct ``words`` (numbers in the index) add up to
    ``least`` or more, by block-max WAND."""
    least -= 1e-9
    lists = [index.postings[w] for w in words]
    at = [0] * len(lists)
    active = list(range(len(lists)))
    found = []
    while active:
        active.sort(key=lambda k: lists[k][0][at[k]])
        bound, pivot = 0.0, -1
        for place, k in enumerate(active):
            bound += lists[k][3]
            if bound >= least:
                pivot = place
                break
        if pivot < 0:
            break
        item = lists[active[pivot]][0][at[active[pivot]]]
        while pivot + 1 < len(active) and lists[active[pivot + 1]][0][at[active[pivot + 1]]] == item:
            pivot += 1
        # The blocks that may hold the item bound its score, and that of all up to their ends.
        bound, ends = 0.0, item + 1 << 40
        for k in active[: pivot + 1]:
            where, _, blocks, _ = lists[k]
            place = bisect_left(where, item, at[k])
            if place < len(where):
                block = place // POSTINGS
                bound += blocks[block]
                ends = min(ends, where[min((block + 1) * POSTINGS, len(where)) - 1])
        if bound >= least:
            score = 0.0
            for k in active[: pivot + 1]:
                where, parts = lists[k][:2]
                at[k] = bisect_left(where, item, at[k])
                if at[k] < len(where) and where[at[k]] == item:
                    score += parts[at[k]]
                    at[k] += 1
            if score >= least:
                found.append((item, score))
        else:
            after = lists[active[pivot + 1]][0][at[active[pivot + 1]]] if pivot + 1 < len(active) else ends + 1
            skip = max(min(ends + 1, after), item + 1)
            for k in active[: pivot + 1]:
                at[k] = bisect_left(lists[k][0], skip, at[k])
        active = [k for k in active if at[k] < len(lists[k][0])]
    return found


def overlap(item: Item, words: np.ndarray) -> tuple[float, float, float]:
    """Parts of the item's question, answer and whole that lie in runs of its words that
    ``words`` has too. An item without an answer has all of it."""
    size = min(RUN, len(item.words))
    here = np.isin(item.runs, _runs(words, size))
    covered = np.zeros(len(item.words), bool)
    for k in range(size):
        covered[np.flatnonzero(here) + k] = True
    question, answer = covered[: item.question], covered[item.question :]
    return (
        float(question.mean()) if len(question) else 1.0,
        float(answer.mean()) if len(answer) else 1.0,
        float(covered.mean()),
    )


def is_leak(question: float, answer: float, whole: float) -> bool:
    return (question >= PART_OVERLAP and answer >= PART_OVERLAP) or whole >= WHOLE_OVERLAP


def _reaching(groups: np.ndarray, at: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int]]:
    """Text and first word of the passages whose words, each as often as it is there, could
    reach the threshold in some group of items."""
    counts = np.diff(begin)
    steps = -(-counts // STRIDE)
    owner = np.repeat(np.arange(len(counts)), steps)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(steps) - steps, steps)
    starts = begin[owner] + number * STRIDE
    sums = np.zeros((len(owner), GROUPS), np.float32)
    for a in range(0, len(owner), _STEPS):
        b = min(a + _STEPS, len(owner))
        low, high = int(starts[a]), int(starts[b]) if b < len(owner) else len(at)
        sums[a:b] = np.add.reduceat(groups[at[low:high]], starts[a:b] - low, axis=0)
    follows = np.zeros(len(owner), bool)
    follows[:-1] = owner[1:] == owner[:-1]
    both = sums.copy()
    both[:-1][follows[:-1]] += sums[1:][follows[:-1]]
    # A last step of its own is part of the passage before it.
    alone = follows | (number == 0)
    for k in np.flatnonzero(alone & (both.max(axis=1) >= THRESHOLD - 1e-4)).tolist():
        yield int(owner[k]), int(starts[k])


def passages(index: Index, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, int, list[int]]]:
    """Row, all words of the text, first word of the passage, distinct known words of each
    passage that could reach the threshold with some item."""
    none = len(index.words)
    for first, _, hashes, begin in _words(texts):
        if not len(hashes) or not none:
            continue
        at = np.minimum(np.searchsorted(index.words, hashes), none - 1)
        at[index.words[at] != hashes] = none
        for i, start in _reaching(index.groups, at, begin):
            end = min(start + WINDOW, int(begin[i + 1]))
            words = np.unique(at[start:end])
            words = words[words < none]
            if index.groups[words].sum(axis=0).max() >= THRESHOLD - 1e-4:
                own = hashes[begin[i] : begin[i + 1]]
                yield first + i, own, start - int(begin[i]), words.tolist()


def leaks_of(index: Index, texts: pa.Array) -> dict[int, dict[int, list]]:
    """By row and item id: score, passages, question and answer overlap of each leak."""
    out: dict[int, dict[int, list]] = {}
    for row, words, start, distinct in passages(index, texts):
        for place, score in search(index, distinct):
            item = index.items[place]
            around = words[max(0, start - len(item.words)) : start + WINDOW + len(item.words)]
            question, answer, whole = overlap(item, around)
            if not is_leak(question, answer, whole):
                continue
            best = out.setdefault(row, {}).setdefault(item.item_id, [0.0, 0, 0.0, 0.0])
            best[0], best[1] = max(best[0], score), best[1] + 1
            if question + answer > best[2] + best[3]:
                best[2:] = question, answer
    return out


def indexes(benchmark: DataFrame, items: int = ITEMS) -> Iterator[Index]:
    """The index, block after block. Word counts are over the whole benchmark."""
    spark = benchmark.sparkSession
    rows = benchmark.select("item_id", "text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, end, hashes, begin in _words(shared.texts_of(batch)):
                row = np.repeat(np.arange(first, end), np.diff(begin))
                pair = np.unique(np.stack([row.astype(np.uint64), hashes]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[pair[0].astype(np.int64)], pa.int64(), from_pandas=True),
                        pa.array(pair[1].view(np.int64)),
                        pa.array(np.full(pair.shape[1], 0)),
                    ],
                    ["item_id", "word", "size"],
                )
                sizes = np.diff(begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[first:end], pa.int64(), from_pandas=True),
                        pa.nulls(end - first, pa.int64()),
                        pa.array(sizes.astype(np.int64)),
                    ],
                    ["item_id", "word", "size"],
                )

    held = shared.stored(shared.arrow_map(rows, words, "item_id long, word long, size long"), "items")
    whole = held.filter("word is null and size > 0").agg(F.count("size"), F.avg("size")).first()
    total, mean = whole[0], whole[1]
    if not total:
        return
    counts = held.filter("word is not null").groupBy("word").agg(F.count("word").alias("df"))
    blocks = -(-total // items)
    for block in range(blocks):
        part = F.coalesce(F.pmod(F.xxhash64("item_id"), F.lit(blocks)), F.lit(0)) == block
        own = held.filter(part & F.col("word").isNotNull()).select("word").distinct()
        weights = {
            w % 2**64: float(np.log(1 + (total - df + 0.5) / (df + 0.5)))
            for w, df in counts.join(own, "word").select("word", "df").collect()
        }
        found = rows.filter(part & F.col("item_id").isNotNull()).collect()
        found = sorted(found, key=lambda r: (r["item_id"], r["text"] is not None, r["text"] or ""))
        yield make_index([(r["item_id"], r["text"]) for r in found], weights, mean)


def leaks(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """One row for each document and item that leaks into it."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], LEAKS)
    for index in indexes(benchmark, items):
        known = spark.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = leaks_of(known.value, shared.texts_of(batch))
                ids = batch.column(0)
                rows = [
                    (ids[row].as_py(), item, *values)
                    for row, by_item in sorted(found.items())
                    for item, values in sorted(by_item.items())
                ]
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "item_id", "score", "n_passages", "question_overlap", "answer_overlap"],
                )

        out = out.union(shared.arrow_map(docs.select("doc_id", "text"), work, LEAKS))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """The documents into which no item leaks, with all their columns; nothing is shuffled."""
    for index in indexes(benchmark, items):
        known = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[list(leaks_of(known.value, shared.texts_of(batch)))] = False
                yield batch.filter(pa.array(keep))

        docs = shared.arrow_map(docs, work, docs.schema)
    return docs


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """All leaks of the benchmark into the documents."""
    return leaks(shared.read(spark, sf_dir, "documents"), shared.read(spark, sf_dir, "benchmark"))
