"""Data contracts: what a raw record must look like before it is loaded."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import parse_instant
from ..functions.payload import at, json_type, opened
from ..schemas import ENTITIES


class Value(NamedTuple):
    """A payload value with its JSON type, its text and the instant in it, each read once."""

    value: Column
    kind: Column
    text: Column
    instant: Column


Check = Callable[[Value], Column]

# Fixed value: a full lower-case commit hash.
SHA_PATTERN = "^[0-9a-f]{40}$"


class ContractBreach(RuntimeError):
    """The share of invalid records of an entity is above the limit."""


@dataclass(frozen=True)
class Rule:
    path: str
    check: Check
    expected: str


def _is(value: Value, kind: str) -> Column:
    return F.coalesce(value.kind == kind, F.lit(False))


def is_integer(value: Value) -> Column:
    return _is(value, "BIGINT")


def is_filled_text(value: Value) -> Column:
    return _is(value, "STRING") & F.coalesce(value.text != "", F.lit(False))


def is_instant(value: Value) -> Column:
    return _is(value, "STRING") & value.instant.isNotNull()


def is_sha(value: Value) -> Column:
    return _is(value, "STRING") & F.coalesce(value.text.rlike(SHA_PATTERN), F.lit(False))


def is_list(value: Value) -> Column:
    return F.coalesce(value.kind.startswith("ARRAY"), F.lit(False))


def optional(check: Check) -> Check:
    return lambda value: F.coalesce(value.kind == "VOID", F.lit(True)) | check(value)


def one_of(*allowed: str) -> Check:
    return lambda value: _is(value, "STRING") & F.coalesce(
        value.text.isin(*allowed), F.lit(False)
    )


# The paths that are checked and the wording of what is expected.
INTEGER, FILLED, SHA, LIST = "integer", "non-empty string", "40-char hex SHA", "list"
INSTANT, INSTANT_OR_NULL, STATE = "ISO timestamp", "ISO timestamp or null", "open|closed"
PULL_NUMBER_MISSING = "context.pull_number missing"
MALFORMED = "line: malformed JSON"

is_state = one_of("open", "closed")

RULES: dict[str, tuple[Rule, ...]] = {
    "repositories": (
        Rule("id", is_integer, INTEGER),
        Rule("full_name", is_filled_text, FILLED),
        Rule("owner.login", is_filled_text, FILLED),
        Rule("created_at", is_instant, INSTANT),
    ),
    "commits": (
        Rule("sha", is_sha, SHA),
        Rule("commit.author.date", is_instant, INSTANT),
        Rule("commit.committer.date", is_instant, INSTANT),
        Rule("parents", is_list, LIST),
    ),
    "pull_requests": (
        Rule("id", is_integer, INTEGER),
        Rule("number", is_integer, INTEGER),
        Rule("state", is_state, STATE),
        Rule("created_at", is_instant, INSTANT),
        Rule("updated_at", is_instant, INSTANT),
        Rule("merged_at", optional(is_instant), INSTANT_OR_NULL),
        Rule("closed_at", optional(is_instant), INSTANT_OR_NULL),
    ),
    "reviews": (
        Rule("id", is_integer, INTEGER),
        Rule("state", is_filled_text, FILLED),
        Rule("submitted_at", optional(is_instant), INSTANT_OR_NULL),
    ),
    "issues": (
        Rule("id", is_integer, INTEGER),
        Rule("number", is_integer, INTEGER),
        Rule("state", is_state, STATE),
        Rule("created_at", is_instant, INSTANT),
        Rule("updated_at", is_instant, INSTANT),
        Rule("closed_at", optional(is_instant), INSTANT_OR_NULL),
    ),
}


def with_values(
    df: DataFrame, columns: Mapping[str, Column], instants: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, Value]]:
    """Project payload values, then their types and texts, so that none is read twice.

    The values named in ``instants`` are also parsed here; of the others an instant
    is only parsed where a check asks for it.
    """
    number = {name: i for i, name in enumerate(columns)}
    df = df.withColumns({f"_value_{number[c]}": column for c, column in columns.items()})
    derived = {}
    for i in number.values():
        derived[f"_kind_{i}"] = json_type(F.col(f"_value_{i}"))
        derived[f"_text_{i}"] = F.try_variant_get(f"_value_{i}", "$", "string")
    df = df.withColumns(derived)
    parsed = {f"_instant_{number[c]}": parse_instant(F.col(f"_text_{number[c]}")) for c in instants}
    values = {
        name: Value(
            F.col(f"_value_{i}"),
            F.col(f"_kind_{i}"),
            F.col(f"_text_{i}"),
            F.col(f"_instant_{i}") if name in instants else parse_instant(F.col(f"_text_{i}")),
        )
        for name, i in number.items()
    }
    return (df.withColumns(parsed) if parsed else df), values


def check(
    raw: DataFrame, entity: str, rules: Sequence[Rule] | None = None
) -> tuple[DataFrame, dict[str, Value]]:
    """Add the ``problems`` of every envelope; also returns the values by path."""
    rules = RULES[entity] if rules is None else rules
    paths = {rule.path for rule in rules}
    if any(other.startswith(f"{path}.") for path in paths for other in paths):
        wanted = {path: at(F.col("data"), path) for path in sorted(paths)}
    else:
        fields = opened(F.col("data"), {path: "variant" for path in sorted(paths)})
        raw = raw.withColumn("_checked", fields)
        wanted = {path: F.col(f"_checked.{path}") for path in sorted(paths)}
    instants = [rule.path for rule in rules if rule.expected in (INSTANT, INSTANT_OR_NULL)]
    if entity == "reviews":
        wanted[PULL_NUMBER_MISSING] = at(F.col("context"), "pull_number")
    df, values = with_values(raw, wanted, instants)
    found = []
    for rule in rules:
        text = F.concat(
            F.lit(f"{rule.path}: expected {rule.expected}, got "),
            F.coalesce(F.to_json(values[rule.path].value), F.lit("null")),
        )
        found.append(F.when(~rule.check(values[rule.path]), text))
    if entity == "reviews":
        number = values[PULL_NUMBER_MISSING]
        found.append(F.when(~is_integer(number), F.lit(PULL_NUMBER_MISSING)))
    unreadable = F.col("repository").isNull() | F.col("data").isNull()
    listed = F.when(unreadable, F.array(F.lit(MALFORMED))).otherwise(
        F.array_compact(F.array(*found))
    )
    return df.withColumn("problems", listed), values


def classify(raw: DataFrame, entity: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Envelopes with their ``problems``, in rule order; an empty list means valid."""
    return check(raw, entity, rules)[0].select(*raw.columns, "problems")


def valid(classified: DataFrame) -> DataFrame:
    return classified.filter(F.size("problems") == 0).drop("problems")


def invalid(classified: DataFrame) -> DataFrame:
    return classified.filter(F.size("problems") > 0)


def reason(problem: Column) -> Column:
    """What a problem is counted under: the text before the first colon."""
    return F.substring_index(problem, ":", 1)


def contract_report(classified: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """One row per entity: checked, invalid, ratio and a count per reason.

    Valid rows collapse to one count per entity while they are read; only the
    problems of invalid rows are exploded.
    """
    rows = None
    for entity, df in classified.items():
        tagged = df.select(
            F.lit(entity).alias("entity"),
            # A valid row yields one NULL reason; the first element marks the row itself.
            F.explode(
                F.concat(
                    F.array(F.lit(None).cast("string")),
                    F.transform("problems", reason),
                )
            ).alias("reason"),
            (F.size("problems") > 0).alias("bad"),
        )
        rows = tagged if rows is None else rows.unionByName(tagged)
    per_reason = rows.groupBy("entity", "reason").agg(
        F.count("*").alias("n"), F.count_if("bad").alias("bad")
    )
    per_entity = per_reason.groupBy("entity").agg(
        F.sum(F.when(F.col("reason").isNull(), F.col("n"))).alias("checked"),
        F.sum(F.when(F.col("reason").isNull(), F.col("bad"))).alias("invalid"),
        F.array_sort(
            F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("reason", "n")))
        ).alias("counts"),
    )
    names = spark.createDataFrame([(e,) for e in classified], "entity string")
    zero = F.lit(0).cast("bigint")
    no_reasons = F.array().cast("array<struct<reason:string,n:bigint>>")
    return names.join(per_entity, "entity", "left").select(
        "entity",
        F.coalesce("checked", zero).alias("checked"),
        F.coalesce("invalid", zero).alias("invalid"),
        invalid_ratio(F.col("invalid"), F.col("checked")).alias("invalid_ratio"),
        F.map_from_entries(F.coalesce("counts", no_reasons)).alias("reasons"),
    )


def invalid_ratio(bad: Column, checked: Column) -> Column:
    """Share of invalid records to four decimals, ties to even; zero when empty."""
    ratio = F.bround(bad.cast("double") / checked, 4)
    return F.when(F.coalesce(checked, F.lit(0)) > 0, ratio).otherwise(F.lit(0.0))


def gate(report: list[dict], max_invalid_ratio: float) -> None:
    """Raise when the rounded ratio of any entity is above the limit."""
    over = [r for r in report if r["invalid_ratio"] > max_invalid_ratio]
    if over:
        told = "; ".join(
            f"{r['entity']}: {r['invalid']} of {r['checked']} ({json.dumps(r['reasons'], default=str)})"
            for r in over
        )
        raise ContractBreach(f"share of invalid records over {max_invalid_ratio}: {told}")


def report_rows(report: DataFrame) -> list[dict]:
    """The report, at most one row per entity, on the driver in entity order."""
    rows = {r["entity"]: r.asDict(recursive=True) for r in report.collect()}
    return [rows[e] for e in ENTITIES if e in rows]
