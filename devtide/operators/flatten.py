"""Raw envelopes to typed rows, and typed rows to staging tables.

Flattening is one narrow pass per entity that also carries the people a record
mentions. Everything after it (dedupe, contributors) works on columns and never
parses JSON again.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.instants import parse_instant
from ..functions.payload import at, is_object, items, json_type, long_at, opened, text_at, truthy
from ..functions.people import (
    PERSON_FIELDS,
    account_fields,
    commit_person,
    commit_person_fields,
    linked_account,
)
from ..functions.text import headline, repository_slug
from ..schemas import STAGED, conform
from .dedupe import keep_first, keep_last


# What the columns below read of a payload is opened into this struct first, in one pass.
_OPEN = "_open"


def _at(path: str) -> Column:
    return F.col(f"{_OPEN}.{path}")


_text = _long = _at

TEXT, NUMBER, VALUE = "string", "bigint", "variant"

PERSON = {"login": TEXT, "id": NUMBER, "type": TEXT}
NAMED = {"name": TEXT, "email": TEXT}


def _below(path: str, fields: Mapping[str, str]) -> dict[str, str]:
    return {f"{path}.{name}": kind for name, kind in fields.items()}


# The people of a record, and everything else that is read of it but instants and flags.
PEOPLE_FIELDS = {
    "repositories": {},
    "commits": _below("author", PERSON)
    | _below("committer", PERSON)
    | _below("commit.author", NAMED)
    | _below("commit.committer", NAMED),
    "pull_requests": _below("user", PERSON),
    "reviews": _below("user", PERSON),
    "issues": _below("user", PERSON),
}

FIELDS = {
    "repositories": {"id": NUMBER, "full_name": TEXT, "owner.login": TEXT, "name": TEXT}
    | {path: TEXT for path in ("description", "language", "default_branch", "html_url")}
    | {path: NUMBER for path in ("stargazers_count", "forks_count", "open_issues_count")},
    "commits": {"sha": TEXT, "commit.message": TEXT, "parents": VALUE, "html_url": TEXT},
    "pull_requests": {"id": NUMBER, "number": NUMBER}
    | {path: TEXT for path in ("title", "state", "base.ref", "html_url")},
    "reviews": {"id": NUMBER, "state": TEXT},
    "issues": {"id": NUMBER, "number": NUMBER, "comments": VALUE, "labels": VALUE}
    | {path: TEXT for path in ("title", "state", "state_reason")},
}


def labels(value: Column) -> Column:
    """Names of the label objects; entries that are not objects are skipped."""
    objects = F.filter(items(value), is_object)
    return F.coalesce(
        F.transform(objects, lambda x: text_at(x, "name")), F.array().cast("array<string>")
    )


def parent_count(value: Column) -> Column:
    return F.coalesce(F.size(items(value)), F.lit(0))


def repository_columns() -> dict[str, Column]:
    return {
        "github_repo_id": _long("id"),
        "full_name": _text("full_name"),
        "owner_login": _text("owner.login"),
        "name": _text("name"),
        "description": _text("description"),
        "language": _text("language"),
        "default_branch": _text("default_branch"),
        "stargazers_count": _long("stargazers_count"),
        "forks_count": _long("forks_count"),
        "open_issues_count": _long("open_issues_count"),
        "html_url": _text("html_url"),
    }


def commit_columns() -> dict[str, Column]:
    return {
        "repository_full_name": F.col("repository"),
        "commit_sha": _text("sha"),
        "author_nk": F.col("people")[0]["contributor_nk"],
        "committer_nk": F.col("people")[1]["contributor_nk"],
        "message_headline": headline(_text("commit.message")),
        "parent_count": parent_count(_at("parents")),
        "html_url": _text("html_url"),
    }


def pull_request_columns() -> dict[str, Column]:
    return {
        "github_pr_id": _long("id"),
        "repository_full_name": F.col("repository"),
        "pr_number": _long("number"),
        "author_nk": F.col("people")[0]["contributor_nk"],
        "title": _text("title"),
        "state": _text("state"),
        "base_ref": _text("base.ref"),
        "html_url": _text("html_url"),
    }


def review_columns() -> dict[str, Column]:
    return {
        "github_review_id": _long("id"),
        "repository_full_name": F.col("repository"),
        "pr_number": long_at(F.col("context"), "pull_number"),
        "reviewer_nk": F.col("people")[0]["contributor_nk"],
        "review_state": _text("state"),
    }


def issue_columns() -> dict[str, Column]:
    # Absent counts as zero, an explicit null stays unknown.
    comments = _at("comments")
    no_comments = json_type(comments).isNull()
    return {
        "github_issue_id": _long("id"),
        "repository_full_name": F.col("repository"),
        "issue_number": _long("number"),
        "author_nk": F.col("people")[0]["contributor_nk"],
        "title": _text("title"),
        "state": _text("state"),
        "state_reason": _text("state_reason"),
        "comments_count": F.when(no_comments, F.lit(0)).otherwise(
            F.try_variant_get(comments, "$", "bigint")
        ),
        "labels": labels(_at("labels")),
    }


COLUMNS = {
    "repositories": repository_columns,
    "commits": commit_columns,
    "pull_requests": pull_request_columns,
    "reviews": review_columns,
    "issues": issue_columns,
}

# The instants of every entity and where they are found.
INSTANTS = {
    "repositories": {"created_at": "created_at", "pushed_at": "pushed_at"},
    "commits": {
        "authored_at": "commit.author.date",
        "committed_at": "commit.committer.date",
    },
    "pull_requests": {c: c for c in ("created_at", "updated_at", "closed_at", "merged_at")},
    "reviews": {"submitted_at": "submitted_at"},
    "issues": {c: c for c in ("created_at", "updated_at", "closed_at")},
}

# Flags follow the truth value of whatever JSON value is there.
FLAGS = {
    "repositories": {"is_private": "private", "is_fork": "fork", "is_archived": "archived"},
    "pull_requests": {"is_draft": "draft"},
}

# How a key seen twice is resolved, by position in the landing zone.
SURVIVOR = {
    "repositories": (keep_last, ["github_repo_id"]),
    "commits": (keep_first, ["repository_full_name", "commit_sha"]),
    "pull_requests": (keep_last, ["github_pr_id"]),
    "reviews": (keep_last, ["github_review_id"]),
    "issues": (keep_last, ["github_issue_id"]),
}


# What is read from a payload first because several columns are derived from it.
READ_FIRST = {
    "repositories": dict,
    "commits": lambda: commit_person_fields("author", _text, _long)
    | commit_person_fields("committer", _text, _long),
    "pull_requests": lambda: account_fields("user", "_user", _text, _long),
    "reviews": lambda: account_fields("user", "_user", _text, _long),
    "issues": lambda: account_fields("user", "_user", _text, _long),
}


def people_of(entity: str) -> Column:
    """The contributors a record mentions, by role; NULL where a role has none."""
    if entity == "commits":
        return F.array(commit_person("author"), commit_person("committer"))
    return F.array(linked_account("_user"))


def with_people(raw: DataFrame, entity: str, more: Mapping[str, str] | None = None) -> DataFrame:
    """Records with their people; the values at the paths in ``more`` are opened besides."""
    wanted = PEOPLE_FIELDS[entity] | dict(more or {})
    read = raw.withColumn(_OPEN, opened(F.col("data"), wanted)).withColumns(READ_FIRST[entity]())
    return read if entity == "repositories" else read.withColumn("people", people_of(entity))


def flat_rows(
    raw: DataFrame, entity: str, *keep: str, parsed: Mapping[str, Column] | None = None
) -> DataFrame:
    """Typed rows of one entity, with their position, their people and ``keep`` columns.

    ``parsed`` holds instants by path that a check has already read.
    """
    parsed = parsed or {}
    unread = {n: path for n, path in INSTANTS[entity].items() if path not in parsed}
    flags = FLAGS.get(entity, {})
    more = FIELDS[entity] | {path: TEXT for path in unread.values()}
    more |= {path: VALUE for path in flags.values()}
    columns = COLUMNS[entity]()
    for name, path in INSTANTS[entity].items():
        columns[name] = parsed.get(path, parse_instant(_text(path)))
    columns |= {name: truthy(_at(path)) for name, path in flags.items()}
    return (
        with_people(raw, entity, more)
        .select(
            *keep,
            # Landing order: repositories by slug, then as landed.
            repository_slug(F.col("repository")).alias("_slug"),
            F.col("ingest_seq").alias("_seq"),
            *([] if entity == "repositories" else ["people"]),
            *[columns[name].cast(kind).alias(name) for name, kind in STAGED[entity].items()],
        )
    )


def submitted(rows: DataFrame) -> DataFrame:
    """Reviews that were submitted: a pending draft carries no time."""
    return rows.filter("submitted_at IS NOT NULL")


def stage(rows: DataFrame, entity: str) -> DataFrame:
    """One row per key of an entity."""
    if entity == "reviews":
        rows = submitted(rows)
    survivor, keys = SURVIVOR[entity]
    positioned = rows.select("_slug", "_seq", *STAGED[entity])
    return conform(survivor(positioned, keys, [F.col("_slug"), F.col("_seq")]), STAGED[entity])


def actors(rows: Mapping[str, DataFrame]) -> DataFrame:
    """Every person seen as commit author or committer, PR author, reviewer, issue author."""
    sources = (
        rows["commits"],
        rows["pull_requests"],
        submitted(rows["reviews"]),
        rows["issues"],
    )
    parts = [
        df.select(
            F.lit(i).alias("_entity"),
            "_slug",
            "_seq",
            F.posexplode("people").alias("_role", "person"),
        ).filter("person IS NOT NULL")
        for i, df in enumerate(sources)
    ]
    return reduce(DataFrame.unionByName, parts).select(
        "_entity", "_slug", "_seq", "_role", *[f"person.{c}" for c in PERSON_FIELDS]
    )


def one_per_contributor(people: DataFrame) -> DataFrame:
    """One row per contributor: a row with an account id wins, then the last one seen."""
    order = [F.col("github_user_id").isNotNull()]
    order += [F.col(c) for c in ("_entity", "_slug", "_seq", "_role")]
    return conform(keep_last(people, ["contributor_nk"], order), STAGED["contributors"])


def stage_all(rows: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All six staging tables from the typed rows of every entity."""
    staged = {entity: stage(rows[entity], entity) for entity in COLUMNS}
    return staged | {"contributors": one_per_contributor(actors(rows))}
