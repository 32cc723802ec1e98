"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose measure lies above a cutoff. Cutoffs are chosen by language
(the stratum) from ``RULES`` on labelled documents: the lowest one at which the exact binomial
bound on the share of good documents rejected stays within the rule's part of ``RISK``. The
bounds hold together with probability ``1 - ERROR``: it is divided by all strata, rules and
cutoffs that are tried (Bonferroni). A stratum with too few good documents for any cutoff has
no such rule.

Defined results: a text that is null or has no word has 0 everywhere and fails the base rule; a
document is good if all its labels say so, and equal texts of a stratum count once; repeated rows
get equal results; an empty label table gives no cutoffs. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Share of a stratum's good documents that all rules together may reject, and the probability
#: that this fails anywhere.
RISK, ERROR = 0.02, 0.05
#: Measures (see ``_MEASURES``) and the cutoffs that are tried, lowest first.
RULES: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (0.1, 0.2, 0.3, 0.5, 1.0),
    "repeated_share": (0.1, 0.2, 0.3, 0.4),
    "duplicate_lines_share": (0.3, 0.4, 0.5, 0.6, 0.8),
    "word_length": (12.0, 15.0, 20.0, 30.0),
}
#: Base rule.
LEAST_WORDS = 50

_NOT_BREAK = np.arange(256) != 10
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80

COUNTS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_lines long,"
    " n_dup_lines long, n_repeat_words long, same_text long"
)
_NAMES = [part.split()[0] for part in COUNTS.split(", ")]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a key is there twice or more, and whether it was there before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, again


def _per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts of each text, by name."""
    parts: list[list[np.ndarray]] = []
    for _, _, data, offsets in shared.chunks(texts):
        words, first, starts, ends = shared.word_hashes(data, offsets, lower=False)
        rows = len(offsets) - 1
        inside = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_FIRST_BYTE[data] & shared.NOT_SPACE[data], out=inside[1:])
        symbols = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_SYMBOL[data], out=symbols[1:])
        # Windows of three words within one text, told apart by the text.
        text = np.repeat(np.arange(rows), np.diff(first))
        last = max(len(words) - 2, 0)
        m = shared.MULTIPLIERS
        keys = words[:last] * m[0] + words[1 : last + 1] * m[1] + words[2 : last + 2] * m[2]
        keys = shared.mix(keys + text[:last].astype(np.uint64) * m[3])
        whole = text[:last] == text[2 : last + 2]
        covered = np.zeros(len(words), bool)
        at = np.flatnonzero(whole)[_repeated(keys[whole])[0]]
        for k in range(3):
            covered[at + k] = True
        lines, line_first, line_starts, line_ends = shared.word_hashes(
            data, offsets, _NOT_BREAK, lower=False
        )
        line_text = np.repeat(np.arange(rows), np.diff(line_first))
        filled = inside[line_ends] > inside[line_starts]
        again = np.zeros(len(lines), bool)
        line_keys = shared.mix(lines + line_text.astype(np.uint64) * m[4])
        again[filled] = _repeated(line_keys[filled])[1]
        bytes_sum = shared.word_hashes(data, offsets, np.ones(256, bool), lower=False)
        same = np.zeros(rows, np.uint64)
        same[np.diff(bytes_sum[1]) > 0] = bytes_sum[0]
        parts.append(
            [
                np.diff(first),
                np.diff(inside[offsets]),
                np.diff(symbols[offsets]),
                _per_text(filled, line_first),
                _per_text(again, line_first),
                _per_text(covered, first),
                same.view(np.int64),
            ]
        )
    joined = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0)] * 7
    return dict(zip(_NAMES[1:], joined, strict=True))


def counts(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """The counts of each document and its stratum."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(shared.texts_of(batch))
            columns = [pa.array(found[n].astype(np.int64)) for n in _NAMES[1:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, batch.column(2)], [*_NAMES, "stratum"]
            )

    rows = docs.select("doc_id", "text", F.coalesce(F.col(stratum), F.lit("")).alias("stratum"))
    return shared.arrow_map(rows, work, f"{COUNTS}, stratum string")


def _share(part: str, whole: str) -> F.Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


_MEASURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "duplicate_lines_share": ("n_dup_lines", "n_lines"),
    "word_length": ("word_chars", "n_words"),
}


def within(rejected: int, total: int, risk: float, error: float) -> bool:
    """Whether the exact (Clopper-Pearson) upper bound at level ``error`` on a share of which
    ``rejected`` of ``total`` were seen is at most ``risk``: P(X <= rejected) <= error for X
    binomial with that share."""
    if total == 0 or rejected >= total:
        return False
    if rejected >= total * risk and error < 0.5:
        # No less than the median was seen: the chance of that many or fewer is a half at least.
        return False
    largest = (
        math.lgamma(total + 1)
        - math.lgamma(rejected + 1)
        - math.lgamma(total - rejected + 1)
        + rejected * math.log(risk)
        + (total - rejected) * math.log1p(-risk)
    )
    # Below the mean each term is a smaller share of the one above it: from the largest one down,
    # until the rest no longer matters. That takes a few standard deviations of steps.
    whole = term = 1.0
    for k in range(rejected, 0, -1):
        term *= k * (1 - risk) / ((total - k + 1) * risk)
        whole += term
        if k < total * risk and term < 1e-17 * whole:
            break
    return largest + math.log(whole) <= math.log(error)


def cutoffs(found: DataFrame, labels: DataFrame) -> dict[str, dict[str, float]]:
    """By stratum and rule, the cutoff; rules without a safe one are left out. ``found``: counts.
    Only documents that pass the base rule count: the others are rejected in any case."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    rows = found.filter(~base_failed()).join(good, "doc_id", "left_semi")
    rows = rows.dropDuplicates(["stratum", "same_text"])
    sums = [
        F.count_if(_share(*_MEASURES[rule]) > cutoff).alias(f"{rule}:{k}")
        for rule, tried in RULES.items()
        for k, cutoff in enumerate(tried)
    ]
    strata = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("total"), *sums).collect()
    tests = len(strata) * sum(map(len, RULES.values()))
    chosen: dict[str, dict[str, float]] = {}
    for row in strata:
        for rule, tried in RULES.items():
            for k, cutoff in enumerate(tried):
                if within(row[f"{rule}:{k}"], row["total"], RISK / len(RULES), ERROR / tests):
                    chosen.setdefault(row["stratum"], {})[rule] = cutoff
                    break
    return chosen


def base_failed() -> F.Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(found: DataFrame, chosen: dict[str, dict[str, float]]) -> DataFrame:
    """``found`` with base_failed, failed_rules and kept."""
    failed = []
    for rule, measures in _MEASURES.items():
        pairs = [F.lit(x) for s, by in chosen.items() if rule in by for x in (s, by[rule])]
        if pairs:
            above = _share(*measures) > F.create_map(*pairs)[F.col("stratum")]
            failed.append(F.when(above, F.lit(rule)))
    rules = F.filter(F.array(*failed), lambda r: r.isNotNull()) if failed else F.array().cast("array<string>")
    return (
        found.withColumn("base_failed", base_failed())
        .withColumn("failed_rules", rules)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of each document."""
    found = shared.stored(counts(docs), "counts")
    return judged(found, cutoffs(found, labels))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts and verdict of each document."""
    docs, labels = (shared.read(spark, sf_dir, t) for t in ("documents", "labels"))
    return keep_good(docs, labels).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )
