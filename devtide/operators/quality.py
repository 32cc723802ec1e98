"""Quality checks on the loaded star: each counts its violations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


class QualityCheckFailed(RuntimeError):
    """A check of severity error found violations."""


@dataclass(frozen=True)
class QualityContext:
    star: Mapping[str, DataFrame]
    staged: Mapping[str, DataFrame]
    now: datetime


@dataclass(frozen=True)
class Check:
    """A named check: either conditions on rows of facts, or a relation of violations.

    Row conditions of all checks on a fact are evaluated in one scan of it.
    """

    name: str
    severity: str
    description: str
    rows: tuple[tuple[str, Callable[[datetime], Column]], ...] = ()
    relation: Callable[[QualityContext], DataFrame] | None = None


def _missing(staged: DataFrame, fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows without a fact row.

    The fact is first reduced to the staged keys, so that the large side is filtered
    where it is scanned instead of being shuffled as a whole.
    """
    found = fact.select(*keys).join(staged.select(*keys), list(keys), "left_semi")
    return staged.join(found, list(keys), "left_anti")


def _keyed(staged: DataFrame, star: Mapping[str, DataFrame]) -> DataFrame:
    names = star["dim_repository"].select(
        F.col("full_name").alias("repository_full_name"), "repository_key"
    )
    return staged.join(names, "repository_full_name")


def _prs_not_loaded(c: QualityContext) -> DataFrame:
    staged = c.staged["pull_requests"].withColumnRenamed("github_pr_id", "pull_request_key")
    return _missing(staged, c.star["fact_pull_request"], ["pull_request_key"])


def _commits_not_loaded(c: QualityContext) -> DataFrame:
    staged = _keyed(c.staged["commits"], c.star)
    return _missing(staged, c.star["fact_commit"], ["repository_key", "commit_sha"])


def _issues_not_loaded(c: QualityContext) -> DataFrame:
    staged = c.staged["issues"].withColumnRenamed("github_issue_id", "issue_key")
    return _missing(staged, c.star["fact_issue"], ["issue_key"])


def _reviews_without_pr(c: QualityContext) -> DataFrame:
    staged = _keyed(c.staged["reviews"], c.star)
    return _missing(staged, c.star["fact_pull_request"], ["repository_key", "pr_number"])


def _after_tomorrow(column: str) -> Callable[[datetime], Column]:
    return lambda now: F.col(column) > F.lit(now) + F.make_dt_interval(days=F.lit(1))


# Names, severities and descriptions of the checks.
CHECKS: tuple[Check, ...] = (
    Check(
        "staged_prs_not_loaded",
        ERROR,
        "every staged pull request reached the fact table",
        relation=_prs_not_loaded,
    ),
    Check(
        "staged_commits_not_loaded",
        ERROR,
        "every staged commit reached the fact table",
        relation=_commits_not_loaded,
    ),
    Check(
        "staged_issues_not_loaded",
        ERROR,
        "every staged issue reached the fact table",
        relation=_issues_not_loaded,
    ),
    Check(
        "pr_merged_before_created",
        ERROR,
        "merge time is never before creation time",
        rows=(("fact_pull_request", lambda now: F.col("merged_at") < F.col("created_at")),),
    ),
    Check(
        "pr_merged_but_open",
        ERROR,
        "a merged pull request is closed",
        rows=(("fact_pull_request", lambda now: F.col("is_merged") & (F.col("state") == "open")),),
    ),
    Check(
        "issue_closed_before_created",
        ERROR,
        "close time is never before creation time",
        rows=(("fact_issue", lambda now: F.col("closed_at") < F.col("created_at")),),
    ),
    Check(
        "closed_issue_without_close_time",
        WARN,
        "closed issues carry a close time",
        rows=(
            ("fact_issue", lambda now: (F.col("state") == "closed") & F.col("closed_at").isNull()),
        ),
    ),
    Check(
        "reviews_without_pull_request",
        WARN,
        "staged reviews belong to a known pull request",
        relation=_reviews_without_pr,
    ),
    Check(
        "commits_without_author",
        WARN,
        "commits can be attributed to a contributor",
        rows=(("fact_commit", lambda now: F.col("author_key").isNull()),),
    ),
    Check(
        "future_dated_activity",
        WARN,
        "no activity dated in the future (clock skew / bad data)",
        rows=(
            ("fact_commit", _after_tomorrow("committed_at")),
            ("fact_pull_request", _after_tomorrow("created_at")),
        ),
    ),
)


def violation_counts(context: QualityContext, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """One row ``(name, violations)`` per check, all checks in one plan."""
    per_fact: dict[str, list[tuple[str, Column]]] = {}
    parts = []
    for check in checks:
        for fact, condition in check.rows:
            per_fact.setdefault(fact, []).append((check.name, condition(context.now)))
        if check.relation:
            parts.append(
                check.relation(context)
                .agg(F.count("*").alias("violations"))
                .select(F.lit(check.name).alias("name"), "violations")
            )
    for fact, conditions in per_fact.items():
        counted = context.star[fact].agg(
            *[F.count_if(condition).alias(f"c{i}") for i, (_, condition) in enumerate(conditions)]
        )
        named = [
            F.struct(F.lit(name).alias("name"), F.col(f"c{i}").alias("violations"))
            for i, (name, _) in enumerate(conditions)
        ]
        parts.append(counted.select(F.inline(F.array(*named))))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("name").agg(F.sum("violations").alias("violations"))


def quality_results(context: QualityContext, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """One row per check with its severity, its violations and whether it passed."""
    spark = next(iter(context.star.values())).sparkSession
    listed = spark.createDataFrame(
        [(c.name, c.severity, c.description) for c in checks],
        "name string, severity string, description string",
    )
    return listed.join(violation_counts(context, checks), "name").select(
        "name",
        "severity",
        "description",
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def run_quality_checks(
    context: QualityContext, checks: Sequence[Check] = CHECKS
) -> list[dict]:
    """Run all checks, then raise if one of severity error found something."""
    if not checks:
        return []
    order = {check.name: place for place, check in enumerate(checks)}
    rows = quality_results(context, checks).collect()
    results = sorted((r.asDict() for r in rows), key=lambda r: order[r["name"]])
    blocking = {r["name"]: r["violations"] for r in results if r["severity"] == ERROR}
    broken = [f"{name} ({count})" for name, count in blocking.items() if count]
    if broken:
        raise QualityCheckFailed("the star breaks these checks: " + "; ".join(broken))
    return results
