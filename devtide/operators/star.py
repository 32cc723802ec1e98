"""Staging tables to dimensions and facts: lookups, generated columns and merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.instants import date_key, hours_between, month_start
from ..functions.people import contributor_key
from ..schemas import STAGED, WAREHOUSE, conform
from .constraints import MERGE_KEYS
from .dedupe import keep_last
from .merge import merge_upsert, take_new

Now = datetime | Column


def repository_key(source_id: Column) -> Column:
    """Surrogate key: a hash of the source id, stable across runs."""
    return F.xxhash64(source_id)


# ------------------------------------------------------------------ dimensions
def merge_dates(target: DataFrame, days: DataFrame) -> DataFrame:
    """Insert the missing days; known days stay as they are."""
    return target.unionByName(days.join(target.select("date_key"), "date_key", "left_anti"))


# The repository attributes whose change counts as a change.
REPOSITORY_TRACKED = (
    "full_name",
    "description",
    "language",
    "is_archived",
    "pushed_at",
    "stargazers_count",
    "forks_count",
    "open_issues_count",
)

REPOSITORY_OVERWRITTEN = tuple(
    c for c in STAGED["repositories"] if c not in ("github_repo_id", "created_at")
)


def repository_dimension_rows(staged: DataFrame, now: Now) -> DataFrame:
    unique = keep_last(staged, ["github_repo_id"], [F.col("pushed_at")])
    stamped = unique.select(
        repository_key(F.col("github_repo_id")).alias("repository_key"),
        "*",
        F.lit(now).alias("first_loaded_at"),
        F.lit(now).alias("last_updated_at"),
    )
    return conform(stamped, WAREHOUSE["dim_repository"])


def merge_repositories(target: DataFrame, staged: DataFrame, now: Now) -> DataFrame:
    """Type 1 update; a change only in untracked attributes is not applied."""

    def changed(old: Column, new: Column) -> Column:
        tracked = [F.struct(*[side[c] for c in REPOSITORY_TRACKED]) for side in (old, new)]
        return ~tracked[0].eqNullSafe(tracked[1])

    return merge_upsert(
        target,
        repository_dimension_rows(staged, now),
        ["github_repo_id"],
        take_new(*REPOSITORY_OVERWRITTEN, "last_updated_at"),
        changed,
    )


def contributor_dimension_rows(staged: DataFrame, now: Now) -> DataFrame:
    named = staged.filter("contributor_nk IS NOT NULL")
    unique = keep_last(named, ["contributor_nk"], [F.col("github_user_id").isNotNull()])
    stamped = unique.select(
        contributor_key(F.col("contributor_nk")).alias("contributor_key"),
        "*",
        F.lit(now).alias("first_loaded_at"),
        F.lit(now).alias("last_updated_at"),
    )
    return conform(stamped, WAREHOUSE["dim_contributor"])


def merge_contributors(target: DataFrame, staged: DataFrame, now: Now) -> DataFrame:
    """Type 1 update that never forgets a known account id or login."""

    def known(column: str):
        return lambda old, new: F.coalesce(new[column], old[column])

    def changed(old: Column, new: Column) -> Column:
        before = F.struct(old.display_name, old.user_type, old.is_bot, old.github_user_id)
        after = F.struct(
            new.display_name, new.user_type, new.is_bot, known("github_user_id")(old, new)
        )
        return ~before.eqNullSafe(after)

    update = take_new("display_name", "user_type", "is_bot", "last_updated_at")
    update |= {c: known(c) for c in ("github_user_id", "login")}
    return merge_upsert(
        target, contributor_dimension_rows(staged, now), ["contributor_nk"], update, changed
    )


# ----------------------------------------------------------------------- facts
def with_generated(df: DataFrame, table: str) -> DataFrame:
    """(Re)compute the columns that are derived from others of the same row."""
    if table == "fact_commit":
        df = df.withColumn("is_merge_commit", F.col("parent_count") > 1)
        moment = "committed_at"
    elif table == "fact_pull_request":
        df = df.withColumns(
            {
                "is_merged": F.col("merged_at").isNotNull(),
                "cycle_time_hours": hours_between(F.col("created_at"), F.col("merged_at")),
            }
        )
        moment = "created_at"
    elif table == "fact_review":
        moment = "submitted_at"
    else:
        df = df.withColumn(
            "time_to_close_hours", hours_between(F.col("created_at"), F.col("closed_at"))
        )
        moment = "created_at"
    return conform(df.withColumn("event_month", month_start(F.col(moment))), WAREHOUSE[table])


def in_known_repository(staged: DataFrame, dim_repository: DataFrame) -> DataFrame:
    """Resolve the repository by name; rows of an unknown name are dropped.

    No broadcast hint: the planner broadcasts the two dimension columns when their
    size allows it and otherwise splits the rows of a hot repository at run time.
    """
    names = dim_repository.select(
        F.col("full_name").alias("repository_full_name"), "repository_key"
    )
    return staged.join(names, "repository_full_name")


def commit_fact_rows(staged: DataFrame, dim_repository: DataFrame, now: Now) -> DataFrame:
    rows = in_known_repository(staged, dim_repository).select(
        "repository_key",
        "commit_sha",
        _person("author_nk").alias("author_key"),
        _person("committer_nk").alias("committer_key"),
        date_key(F.col("authored_at")).alias("authored_date_key"),
        date_key(F.col("committed_at")).alias("committed_date_key"),
        "authored_at",
        "committed_at",
        "message_headline",
        "parent_count",
        "html_url",
        F.lit(now).alias("loaded_at"),
    )
    return with_generated(rows, "fact_commit")


def pull_request_fact_rows(staged: DataFrame, dim_repository: DataFrame, now: Now) -> DataFrame:
    rows = in_known_repository(staged, dim_repository).select(
        F.col("github_pr_id").alias("pull_request_key"),
        "repository_key",
        _person("author_nk").alias("author_key"),
        "pr_number",
        "title",
        "state",
        "is_draft",
        "created_at",
        "updated_at",
        "closed_at",
        "merged_at",
        *[
            date_key(F.col(f"{c}_at")).alias(f"{c}_date_key")
            for c in ("created", "closed", "merged")
        ],
        "base_ref",
        "html_url",
        F.lit(now).alias("loaded_at"),
    )
    return with_generated(rows, "fact_pull_request")


def review_fact_rows(
    staged: DataFrame, dim_repository: DataFrame, pull_requests: DataFrame, now: Now
) -> DataFrame:
    """Reviews of known pull requests, those of earlier runs included.

    ``pull_requests`` is the fact after its own merge.
    """
    known = pull_requests.select("repository_key", "pr_number", "pull_request_key")
    rows = (
        in_known_repository(staged, dim_repository)
        .join(known, ["repository_key", "pr_number"])
        .select(
            F.col("github_review_id").alias("review_key"),
            "pull_request_key",
            "repository_key",
            _person("reviewer_nk").alias("reviewer_key"),
            "review_state",
            "submitted_at",
            date_key(F.col("submitted_at")).alias("submitted_date_key"),
            F.lit(now).alias("loaded_at"),
        )
    )
    return with_generated(rows, "fact_review")


def issue_fact_rows(staged: DataFrame, dim_repository: DataFrame, now: Now) -> DataFrame:
    rows = in_known_repository(staged, dim_repository).select(
        F.col("github_issue_id").alias("issue_key"),
        "repository_key",
        _person("author_nk").alias("author_key"),
        "issue_number",
        "title",
        "state",
        "state_reason",
        "created_at",
        "updated_at",
        "closed_at",
        *[date_key(F.col(f"{c}_at")).alias(f"{c}_date_key") for c in ("created", "closed")],
        F.coalesce("comments_count", F.lit(0)).alias("comments_count"),
        F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
        F.lit(now).alias("loaded_at"),
    )
    return with_generated(rows, "fact_issue")


def _person(nk: str) -> Column:
    # Every staged natural key is staged as a contributor of the same run, so the
    # key needs no lookup; the constraint check proves that each one exists.
    return F.when(F.col(nk).isNotNull(), contributor_key(F.col(nk)))


# The columns a repeated load overwrites; all others keep their first value.
FACT_OVERWRITTEN = {
    "fact_commit": ("author_key", "committer_key", "message_headline", "loaded_at"),
    "fact_pull_request": (
        "title",
        "state",
        "is_draft",
        "updated_at",
        "closed_at",
        "merged_at",
        "closed_date_key",
        "merged_date_key",
        "loaded_at",
    ),
    "fact_review": ("review_state", "loaded_at"),
    "fact_issue": (
        "title",
        "state",
        "state_reason",
        "updated_at",
        "closed_at",
        "closed_date_key",
        "comments_count",
        "labels",
        "loaded_at",
    ),
}

# Facts whose rows are snapshots: an older snapshot must not replace a newer one.
SNAPSHOT_FACTS = ("fact_pull_request", "fact_issue")


def not_older(old: Column, new: Column) -> Column:
    return new.updated_at >= old.updated_at


def merge_fact(table: str, target: DataFrame, rows: DataFrame) -> DataFrame:
    merged = merge_upsert(
        target,
        rows,
        MERGE_KEYS[table],
        take_new(*FACT_OVERWRITTEN[table]),
        not_older if table in SNAPSHOT_FACTS else None,
    )
    return with_generated(merged, table)
