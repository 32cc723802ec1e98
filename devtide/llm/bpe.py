"""BPE encoding and decoding with a public byte-level vocabulary.

A text is cut at added tokens, then into pieces by the vocabulary's pattern. Within a piece
the bytes form a doubly linked list of symbols, and a priority queue holds the merges that
are possible, by rank and place; an entry whose symbols have changed since is stale and
skipped. Decoding concatenates the vocabulary's byte strings and reads them as UTF-8.

Defined results: null is the empty text and has no ids; a text of one long piece takes time
in proportion to n log n; repeated rows get equal results; other columns pass through as they
are, and one that is named like a new column is replaced by it.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .shared import buffers

# Ranges that hold letters and numbers which are newer than the vocabulary's
# pre-tokenizer; it takes them for signs.
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
_NEW = "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER)
_IS_NEW = regex.compile(f"[{_NEW}]")


def _pieces(letter: str, number: str, sign: str) -> str:
    """How the vocabulary's pre-tokenizer cuts a text into pieces (a fixed value)."""
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{sign}+"
        r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
    )


PIECES = regex.compile(_pieces(r"\p{L}", r"\p{N}", r"[^\p{White_Space}\p{L}\p{N}]"))
#: The same for texts with new letters or numbers.
PIECES_NEW = regex.compile(
    _pieces(
        rf"[\p{{L}}--[{_NEW}]]",
        rf"[\p{{N}}--[{_NEW}]]",
        rf"(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]|[{_NEW}])",
    ),
    regex.V1,
)


def cut(text: str) -> list[str]:
    """The pieces of a text without added tokens."""
    if not text.isascii() and _IS_NEW.search(text):
        return PIECES_NEW.findall(text)
    return PIECES.findall(text)


#: Pieces (and blocks of pieces) whose ids a worker keeps, in each of two generations.
REMEMBERED = 250_000
#: Bits of an id.
SHIFT = 20
MASK = (1 << SHIFT) - 1


@dataclass
class Vocabulary:
    """Bytes of each id, ids of the 256 bytes, and for a pair of ids its rank and result (two
    numbers of ``SHIFT`` bits and more in one)."""

    strings: list[bytes]
    of_byte: list[int]
    merges: dict[int, int]
    added: dict[str, int] = field(default_factory=dict)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable ones for themselves, the
    others in order from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters = _byte_letters()
    ids = content["model"]["vocab"]
    added = {t["content"]: t["id"] for t in content["added_tokens"]}
    strings = [b""] * (max([*ids.values(), *added.values()]) + 1)
    for token, k in ids.items():
        strings[k] = bytes(letters[c] for c in token)
    for token, k in added.items():
        strings[k] = token.encode()
    merges = {}
    for rank, pair in enumerate(content["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[left] << SHIFT | ids[right]] = rank << SHIFT | ids[left + right]
    of_byte = [0] * 256
    for letter, byte in letters.items():
        of_byte[byte] = ids[letter]
    return Vocabulary(strings, of_byte, merges, added)


def merge(symbols: list[int], merges: dict[int, int]) -> list[int]:
    """Apply the merges, lowest rank first and from the left. ``merges``: for a pair (as one
    number) its rank and result (as one number)."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols, find = list(symbols), merges.get
    queue = [
        (found, at, symbols[at], symbols[at + 1])
        for at in range(n - 1)
        if (found := find(symbols[at] << SHIFT | symbols[at + 1])) is not None
    ]
    if not queue:
        return symbols
    heapq.heapify(queue)
    pop, push = heapq.heappop, heapq.heappush
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    while queue:
        found, at, left, right = pop(queue)
        behind = after[at]
        if symbols[at] != left or behind < 0 or symbols[behind] != right:
            continue
        joined = found & MASK
        symbols[at], symbols[behind] = joined, -1
        after[at] = ahead = after[behind]
        if ahead >= 0:
            before[ahead] = at
            found = find(joined << SHIFT | symbols[ahead])
            if found is not None:
                push(queue, (found, at, joined, symbols[ahead]))
        ahead = before[at]
        if ahead >= 0:
            found = find(symbols[ahead] << SHIFT | joined)
            if found is not None:
                push(queue, (found, ahead, symbols[ahead], joined))
    return [s for s in symbols if s >= 0]


class _Pieces(dict):
    """Ids (as bytes of 32-bit numbers) by piece; what was not asked for of late is forgotten."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary, self.old = vocabulary, {}

    def find(self, piece: str) -> bytes | None:
        of_byte = self.vocabulary.of_byte
        return array("i", merge([of_byte[b] for b in piece.encode()], self.vocabulary.merges)).tobytes()

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.old.get(piece, self)
        if ids is self:
            ids = self.find(piece)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class _Blocks(_Pieces):
    """Ids of a blank and what follows up to the next one, which its neighbours can't change
    as long as it neither starts nor ends with white space; else None."""

    def __init__(self, vocabulary: Vocabulary, pieces: _Pieces) -> None:
        super().__init__(vocabulary)
        self.pieces = pieces

    def find(self, piece: str) -> bytes | None:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        if piece.isascii() and piece.isalpha():
            return self.pieces[" " + piece]
        return b"".join([self.pieces[p] for p in cut(" " + piece)])


class Codec:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pieces = _Pieces(vocabulary)
        self.blocks = _Blocks(vocabulary, self.pieces)
        names = sorted(vocabulary.added, key=len, reverse=True)
        self.names = regex.compile(f"({'|'.join(map(regex.escape, names))})") if names else None
        self.strings = pa.array(vocabulary.strings, pa.large_binary())

    def _plain(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        blocks = [self.blocks[b] for b in rest]
        pieces = self.pieces
        if None in blocks or not first or first[-1].isspace():
            return b"".join([pieces[p] for p in cut(text)])
        return b"".join([*[pieces[p] for p in cut(first)], *blocks])

    def encoded(self, text: str) -> bytes:
        """The ids of a text as bytes of 32-bit numbers."""
        parts = self.names.split(text) if self.names else [text]
        if len(parts) == 1:
            return self._plain(text)
        added = self.vocabulary.added
        return b"".join(
            [
                array("i", [added[p]]).tobytes() if k % 2 else self._plain(p)
                for k, p in enumerate(parts)
            ]
        )

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), np.int32).tolist()

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """Lists of ids."""
        found = [self.encoded(t) for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, found)]) // 4
        ids = pa.array(np.frombuffer(b"".join(found), np.int32))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids)

    def decode_all(self, ids: pa.Array) -> pa.Array:
        """Texts: the strings of each list's ids one behind the other, read as UTF-8; what is no
        UTF-8 becomes the replacement character. No list, no text."""
        lists = pc.fill_null(ids, []) if ids.null_count else ids
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
        strings = self.strings.take(lists.flatten())
        places, data = buffers(strings)[1], strings.buffers()[2] or pa.py_buffer(b"")
        whole = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(places[ends].tobytes()), data]
        )
        try:
            return whole.cast(pa.large_string())
        except pa.ArrowInvalid:
            texts = [x.decode("utf-8", "replace") for x in whole.to_pylist()]
            return pa.array(texts, pa.large_string())

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    if at >= 0:
        return batch.set_column(at, name, values)
    return batch.append_column(name, values)


def _schema(df: DataFrame, name: str, kind: str) -> str:
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema if f.name != name]
    if name in df.columns:
        fields.insert(df.columns.index(name), (name, kind))
    else:
        fields.append((name, kind))
    return ", ".join(f"`{n}` {k}" for n, k in fields)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) of the whole ``text``."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.held(known.value, Codec)
        for batch in batches:
            for part, texts in shared.slices(batch, text):
                yield _with(part, ids, codec.encode_all(texts))

    return shared.arrow_map(docs, work, _schema(docs, ids, "array<int>"), holds=True)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with ``text`` read back from ``ids`` (null: no ids)."""
    known = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.held(known.value, Codec)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            yield _with(batch, text, codec.decode_all(column).cast(pa.string()))

    return shared.arrow_map(rows, work, _schema(rows, text, "string"), holds=True)


def round_trip(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``docs`` with ``ids`` of the whole ``text`` and what they decode to, in one pass: one Python
    worker a task, where ``decode(encode(docs))`` takes two."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    both = docs.withColumns({ids: F.lit(None).cast("array<int>"), decoded: F.lit(None).cast("string")})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.held(known.value, Codec)
        for batch in batches:
            for part, texts in shared.slices(batch, text):
                found = codec.encode_all(texts)
                part = _with(part, ids, found)
                yield _with(part, decoded, codec.decode_all(found).cast(pa.string()))

    return shared.arrow_map(both, work, both.schema, holds=True)


def public_vocabulary(path: str | None = None) -> Vocabulary:
    """The public vocabulary at ``path``, by default the one installed with the tokenizers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return load(path)


def op4_bpe_codec(spark, sf_dir: str) -> DataFrame:
    """Contract query: encode every document, decode the ids, digest both."""
    vocabulary = public_vocabulary()
    docs = shared.read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = round_trip(docs, vocabulary).drop("text")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
