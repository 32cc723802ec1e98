"""Exact token counts at every prefix of a text, by dynamic programming.

A merge tokenizer cuts a text into tokens that are pairwise compatible: two neighbours, encoded
on their own, stay the same two tokens; and a sequence whose neighbours are all compatible is what
the tokenizer returns. So each prefix has one last token: the one that ends there and is
compatible with the last token of the prefix before it. One pass from left to right gives every
prefix its count (that of the shorter prefix plus one) and its last token.

Where no piece of the vocabulary reaches across a place (before the white space of a word), the
counts on both sides add up. Words are therefore worked out once and their counts remembered as
differences; those of a text are the words' differences one behind the other. They are kept with
the document (``prefix_tokens``), and budgets and truncations are answered from them.

Null texts count as empty, an empty text has no token and no prefix but itself. Rows are neither
merged nor dropped: repeated rows give repeated rows, null ids stay null. Columns that have the
name of a result column are replaced by it; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

BLANK = "▁"
#: Words and pairs a worker remembers, in each of two generations.
REMEMBERED = 250_000
#: Longer words are worked out anew each time.
LONG = 64
LIMIT = 4096


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their merge priority (higher first)."""

    pieces: dict[str, float]


def load(path: str) -> Vocabulary:
    """A sentencepiece BPE model with byte fallback that leaves texts as they are but for blanks."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, kind = model.normalizer_spec, model.trainer_spec
    own = [p for p in model.pieces if p.type == proto.ModelProto.SentencePiece.NORMAL]
    other = {p.type for p in model.pieces} - {
        getattr(proto.ModelProto.SentencePiece, n) for n in ("NORMAL", "UNKNOWN", "CONTROL", "BYTE")
    }
    if (
        kind.model_type != proto.TrainerSpec.BPE
        or not kind.byte_fallback
        or kind.treat_whitespace_as_suffix
        or rules.precompiled_charsmap
        or rules.remove_extra_whitespaces
        or not (rules.add_dummy_prefix and rules.escape_whitespaces)
        or other
    ):
        raise ValueError(f"{path} is no model of the kind that is counted here")
    return Vocabulary({p.piece: p.score for p in own})


def public_vocabulary(path: str | None = None) -> Vocabulary:
    """The public vocabulary at ``path``, by default the one installed with the tokenizers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return load(path)


class _Remembered(dict):
    """A function's results in two generations: what is not used for long is forgotten. Of texts,
    only short ones are kept."""

    def __init__(self, work: Callable):
        super().__init__()
        self.work, self.old = work, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.work(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if type(key) is int or len(key) <= LONG:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = value


class PrefixCounts:
    """Token counts of all prefixes of a text."""

    def __init__(self, vocabulary: Vocabulary):
        self.scores = vocabulary.pieces
        letters = {c for piece in self.scores for c in piece}
        #: Tokens by number: pieces, and letters of pieces that are none themselves; 0 is none.
        self.tokens = ["", *self.scores, *sorted(letters - self.scores.keys())]
        self.numbers = {t: k for k, t in enumerate(self.tokens) if k}
        #: A letter without a piece is written as its bytes.
        self.costs = [1 if t in self.scores else len(t.encode()) for t in self.tokens]
        #: Lengths of the tokens that end with one or two letters, longest first.
        ends: dict[str, set[int]] = {}
        for token in self.tokens[1:]:
            ends.setdefault(token[-1], {1})
            ends.setdefault(token[-2:], {1}).add(len(token))
        self.lengths = {c: tuple(sorted(sizes, reverse=True)) for c, sizes in ends.items()}
        self.cut = self._cut()
        self.pairs = _Remembered(self._stays)
        self.words = _Remembered(self._steps)

    def _cut(self) -> Callable[[str], list[str]]:
        """A cut into words of one kind of letters with the blanks before them, if no piece
        reaches across such a cut; it depends on the two letters beside it only."""
        inside = {x + y for piece in self.scores for x, y in zip(piece, piece[1:])}
        rules, moved = [], ""
        for _ in range(2):
            letter, sign = rf"[^\W\d_{moved}]", rf"(?:[\W_{moved}](?<!{BLANK}))"
            rules.append(re.compile(rf"{BLANK}+(?:{letter}+|{sign}+)?|{letter}+|{sign}+|\d"))
            # Letters that pieces join to signs count as signs.
            mixed = {c for pair in inside if len(rules[0].findall(pair)) > 1 for c in pair}
            moved = "".join(c for c in sorted(mixed) if re.match(letter, c))
        for rule in (*rules, re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")):
            if all(len(rule.findall(pair)) == 1 for pair in inside):
                return rule.findall
        return lambda text: [text]

    def _stays(self, pair: int) -> bool:
        """Whether two neighbours, encoded on their own, stay the same two tokens (without a left
        one: whether the right one stays one token). The best pair is merged first, of equal ones
        the leftmost; a merge across the border between the two decides against them."""
        left, right = (self.tokens[k] for k in divmod(pair, len(self.tokens)))
        score = self.scores.get
        symbols, border = list(left + right), len(left)
        scores = [score(a + b, -np.inf) for a, b in zip(symbols, symbols[1:])]
        while scores and (best := max(scores)) > -np.inf:
            at = scores.index(best)
            if at + 1 == border:
                return False
            border -= at < border
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del scores[at]
            for k in (at - 1, at):
                if 0 <= k < len(scores):
                    scores[k] = score(symbols[k] + symbols[k + 1], -np.inf)
        return len(symbols) == 1 + bool(left)

    def _extended(self, word: str, counts: list[int], last: list[int]) -> None:
        """Carry the token counts and last tokens of a word's first prefixes on to all of them."""
        numbers, pairs, lengths, many = self.numbers, self.pairs, self.lengths, len(self.tokens)
        for end in range(len(counts), len(word) + 1):
            sizes = lengths.get(word[end - 2 : end]) or lengths.get(word[end - 1])
            if sizes is None:
                # A letter of no piece stands alone, and nothing merges across it.
                counts.append(counts[-1] + len(word[end - 1].encode()))
                last.append(0)
                continue
            for size in sizes:
                if size <= end and (token := numbers.get(word[end - size : end])):
                    if pairs[last[end - size] * many + token]:
                        counts.append(counts[end - size] + self.costs[token])
                        last.append(token)
                        break

    def _counts(self, word: str) -> list[int]:
        """The token count of each prefix of a word, from the empty one on."""
        counts = [0]
        self._extended(word, counts, [0])
        return counts

    def _steps(self, word: str, counts: list[int] | None = None) -> bytes | None:
        """What each letter adds to the count, in a byte each; None if it does not fit."""
        counts = counts or self._counts(word)
        try:
            return array("b", map(sub, counts[1:], counts)).tobytes()
        except OverflowError:
            return None

    def _learn(self, words: set[str]) -> None:
        """Work out new words in order: each goes on where it departs from the one before."""
        counts, last, before = [0], [0], ""
        for word in sorted(words - self.words.keys() - self.words.old.keys()):
            same = 0
            for x, y in zip(word, before):
                if x != y:
                    break
                same += 1
            del counts[same + 1 :], last[same + 1 :]
            self._extended(word, counts, last)
            self.words.keep(word, self._steps(word, counts))
            before = word

    def packed(self, texts: list[str]) -> list[bytes]:
        """For each text the width of a step in bytes, then the steps: of the blank that is put
        before a text, then of each of its letters."""
        cuts = [self.cut(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        self._learn({w for words in cuts for w in words})
        return [self._joined(words) for words in cuts]

    def _joined(self, words: list[str]) -> bytes:
        try:
            return b"\x01" + b"".join(map(self.words.__getitem__, words))
        except TypeError:
            wide = [np.diff(self._counts(w)).astype("<i4") for w in words]
            return b"\x04" + np.concatenate(wide).tobytes()


def unpacked(packed: bytes) -> np.ndarray:
    """Token counts of all prefixes, from the empty one to the whole text."""
    counts = np.cumsum(np.frombuffer(packed, np.int8 if packed[0] == 1 else "<i4", offset=1), dtype=np.int64)
    # The blank alone is no text: the empty prefix has no token.
    return np.concatenate([[0], counts[1:]])


def _total(packed: bytes) -> int:
    return int(np.frombuffer(packed, np.int8 if packed[0] == 1 else "<i4", offset=1).sum(dtype=np.int64))


def _added(df: DataFrame, new: dict[str, str]) -> tuple[list[str], str]:
    kept = [f for f in df.schema if f.name not in new]
    fields = [(f.name, f.dataType.simpleString()) for f in kept] + list(new.items())
    return [f.name for f in kept], ", ".join(f"`{n}` {k}" for n, k in fields)


def prefix_counts(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` of the whole ``text`` and ``prefix_tokens``, the counts of all its
    prefixes packed (``unpacked`` reads them)."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept, schema = _added(docs, {"n_tokens": "bigint", "prefix_tokens": "binary"})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.held(known.value, PrefixCounts)
        for batch in batches:
            texts, packed = shared.texts_of(batch, text), []
            for first, end, _, _ in shared.chunks(texts):
                packed += counter.packed(texts.slice(first, end - first).to_pylist())
            sizes = pa.array([_total(p) for p in packed], pa.int64())
            found = [*batch.select(kept).columns, sizes, pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(found, [*kept, "n_tokens", "prefix_tokens"])

    return shared.arrow_map(docs, work, schema, holds=True)


def truncations(rows: DataFrame, budget: int, packed: str = "prefix_tokens") -> DataFrame:
    """``rows`` with ``n_fit``: the characters of the longest prefix of at most ``budget`` tokens,
    and ``fit_tokens``, its tokens; read from the stored counts."""
    kept, schema = _added(rows, {"n_fit": "bigint", "fit_tokens": "bigint"})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, tokens = [], []
            for value in batch.column(batch.schema.get_field_index(packed)):
                counts = unpacked(value.as_py() or b"\x01")
                # A longer prefix may take fewer tokens than a shorter one: look from the end.
                at = len(counts) - 1 - int(np.argmax(counts[::-1] <= budget))
                sizes.append(at)
                tokens.append(int(counts[at]))
            found = [*batch.select(kept).columns, pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(found, [*kept, "n_fit", "fit_tokens"])

    return shared.arrow_map(rows, work, schema)


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    """Contract query: the tokens of every document, and how much of it the limit holds."""
    docs = shared.read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = prefix_counts(docs, public_vocabulary())
    sized = counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        "prefix_tokens",
    )
    return truncations(sized, LIMIT).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "n_fit", "fit_tokens"
    )
