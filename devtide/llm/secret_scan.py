"""Secret scans: fixed patterns, and strings that a tokenizer finds costly.

A tiktoken vocabulary spends few tokens on words and many on random strings. Runs of
``[A-Za-z0-9+/_=-]`` with letters whose characters per token are below ``LOW_RATIO`` are
reported as ``random``, unless they are digests or UUIDs (see ``_is_known``) or lie within a
span of the fixed patterns. In a run that is not costly as a whole, as words are joined to the
secret, its parts between signs are judged (see ``Scanner.parts``).

Defined results: null is the empty text; the same text always has the same spans; a very long
run is one candidate; extra columns, whatever their names, pass through ``redact``.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "random")
#: The patterns of the contract; matches that are too short are dropped.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18

#: Characters of a candidate run, its least length, and the characters per token below which
#: it is random.
RUN_LENGTH = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RUN_LENGTH)
LOW_RATIO = 2.0
#: Lengths of hexadecimal digests (MD5, SHA-1, SHA-2).
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Names and paths: words of letters with short numbers at their ends, joined by one sign. Their
#: signs and short words say nothing; only their parts are judged.
#: One sign begins one word, so that a match can be read in one way only and takes linear time.
_NAME = re.compile(r"[A-Za-z]*[0-9]{0,4}(?:[_/=+-][A-Za-z]*[0-9]{0,4})*")
_LETTER, _SEGMENT = re.compile(r"[A-Za-z]"), re.compile(r"[A-Za-z0-9]+")
#: Mean length of parts that are judged together; shorter ones are abbreviations.
_SEGMENT_LENGTH = 5
#: Characters that are counted at once, so that one endless run is cheap.
_PART = 4096


def _class(pattern: str) -> np.ndarray:
    found = re.compile(pattern)
    return np.array([b < 128 and bool(found.fullmatch(chr(b))) for b in range(256)])


_HEX_BYTE, _UPPER_BYTE = _class("[0-9a-f]"), _class("[A-Z0-9]")
_RUN_BYTE, _ASSIGN_BYTE = _class("[A-Za-z0-9+/_=-]"), _class("[:=]")

SPANS = "array<struct<kind:string,start:int,end:int>>"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}


def _is_known(run: str) -> bool:
    """Digests of known lengths, UUIDs, plain numbers."""
    if _UUID.fullmatch(run) or not _LETTER.search(run):
        return True
    return len(run) in DIGEST_LENGTHS and bool(_HEX_ONLY.fullmatch(run))


def _within(spans: list[tuple[int, int, str]]) -> Callable[[int, int], bool]:
    """Whether a place lies in one of the spans, for places asked for from left to right: of the
    spans that begin before a place only the one that reaches farthest matters."""
    ordered, reach, at = sorted(spans), -1, 0

    def held(start: int, end: int) -> bool:
        nonlocal reach, at
        while at < len(ordered) and ordered[at][0] <= start:
            reach, at = max(reach, ordered[at][1]), at + 1
        return end <= reach

    return held


class Scanner:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.encoding = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )

    def ratio(self, run: str) -> float:
        parts = [run[k : k + _PART] for k in range(0, len(run), _PART)]
        return len(run) / sum(len(self.encoding.encode_ordinary(p)) for p in parts)

    def parts(self, run: str) -> list[tuple[int, int]]:
        """Costly parts of a run: as few neighbouring segments between signs as are long enough
        together. UUIDs, digests and numbers are no part of any."""
        hidden = _UUID.sub(lambda m: "-" * len(m.group()), run)
        segments, found = [], []
        for m in _SEGMENT.finditer(hidden):
            tokens = 0 if _is_known(m.group()) else len(m.group()) / self.ratio(m.group())
            segments.append((*m.span(), tokens))
        for k, (start, _, _) in enumerate(segments):
            letters = tokens = 0
            # Segments are a letter and a sign at least: this ends after a bounded number.
            for n in range(k, len(segments)):
                a, end, cost = segments[n]
                if not cost:
                    break
                letters, tokens = letters + end - a, tokens + cost
                if end - start >= RUN_LENGTH:
                    if letters < LOW_RATIO * tokens and letters >= (n - k + 1) * _SEGMENT_LENGTH:
                        found.append((start, end))
                    break
        joined: list[tuple[int, int]] = []
        for start, end in found:
            if joined and start <= joined[-1][1]:
                start, end = joined[-1][0], max(joined.pop()[1], end)
            joined.append((start, end))
        return joined

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """All spans as (start, end, kind), by start and kind."""
        found = [
            (*m.span(), "assign")
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_VALUE
        ]
        if "AKIA" in text:
            found += [
                (*m.span(), "access")
                for m in ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_LENGTH
            ]
        found += [(*m.span(), "hex") for m in HEX.finditer(text)]
        held = _within(found)
        for m in RUN.finditer(text):
            start, end = m.span()
            if held(start, end) or _is_known(m.group()):
                continue
            by_parts = _NAME.fullmatch(m.group()) or _UUID.search(m.group())
            if not by_parts and self.ratio(m.group()) < LOW_RATIO:
                found.append((start, end, "random"))
                continue
            for a, b in self.parts(m.group()):
                if not held(start + a, start + b):
                    found.append((start + a, start + b, "random"))
        return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def suspects(texts: pa.Array) -> np.ndarray:
    """Whether a text can have any span at all: it holds a sign of assignment, or a run of
    the right characters that is long enough. All others need no further look."""
    out = np.zeros(len(texts), bool)
    for first, end, data, offsets in shared.chunks(texts):
        for kind, least in ((_HEX_BYTE, 16), (_UPPER_BYTE, ACCESS_LENGTH), (_RUN_BYTE, RUN_LENGTH)):
            starts, ends, _ = shared.word_bounds(data, offsets, kind)
            long = ends - starts >= least
            starts = starts[long]
            out[first + np.searchsorted(offsets, starts, "right") - 1] = True
        signs = np.flatnonzero(_ASSIGN_BYTE[data])
        out[first + np.searchsorted(offsets, signs, "right") - 1] = True
    return out


def _all_spans(scanner: Scanner, texts: pa.Array) -> list[list[tuple[int, int, str]]]:
    found: list[list[tuple[int, int, str]]] = [[]] * len(texts)
    for i in np.flatnonzero(suspects(texts)).tolist():
        found[i] = scanner.spans(texts[i].as_py())
    return found


def public_ranks(path: str | None = None) -> tuple[dict[bytes, int], str]:
    """Ranks at ``path`` (by default the installed public ones) and the pattern they go with."""
    import public_tokenizers

    return load_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def _scanner(known) -> Scanner:
    return shared.held(known.value, lambda ranks: Scanner(*ranks))


def scan(docs: DataFrame, ranks: tuple[dict[bytes, int], str]) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, end exclusive) of each text."""
    known = docs.sparkSession.sparkContext.broadcast(ranks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(known)
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for batch in batches:
            spans = [
                [{"kind": k, "start": a, "end": b} for a, b, k in found]
                for found in _all_spans(scanner, shared.texts_of(batch))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"]
            )

    return shared.arrow_map(docs.select("doc_id", "text"), work, f"doc_id long, spans {SPANS}", holds=True)


def redact(docs: DataFrame, ranks: tuple[dict[bytes, int], str], mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` (overlapping ones together) replaced by ``mark``, and
    ``n_chars``, if there is such a column, counted again for changed texts."""
    known = docs.sparkSession.sparkContext.broadcast(ranks)
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(known)
        for batch in batches:
            at = names.index("text")
            texts, changed = shared.texts_of(batch), {}
            for i, spans in enumerate(_all_spans(scanner, texts)):
                if spans:
                    text, out, end = texts[i].as_py(), [], 0
                    for a, b, _ in spans:
                        if a >= end:
                            out += [text[end:a], mark]
                        end = max(end, b)
                    changed[i] = "".join([*out, text[end:]])
            if changed:
                texts = [changed.get(i, t) for i, t in enumerate(batch.column(at).to_pylist())]
                batch = batch.set_column(at, "text", pa.array(texts, batch.schema.types[at]))
                if "n_chars" in names:
                    at = names.index("n_chars")
                    sizes = batch.column(at).to_pylist()
                    sizes = [len(changed[i]) if i in changed else n for i, n in enumerate(sizes)]
                    kind = batch.schema.types[at]
                    batch = batch.set_column(at, "n_chars", pa.array(sizes, kind))
            yield batch

    return shared.arrow_map(docs, work, docs.schema, holds=True)


def _listed(spans) -> F.Column:
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def _of(kind: str) -> F.Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query: the spans of every document."""
    found = scan(shared.read(spark, sf_dir, "documents"), public_ranks())
    return found.select(
        "doc_id",
        _of("assign").alias("n_assign"),
        _of("access").alias("n_access"),
        _of("hex").alias("n_hex"),
        F.sha2(_listed(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        _of("random").alias("n_random"),
    )
