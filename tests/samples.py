"""Small payloads with known results, and helpers to turn them into listings.

A payload is a flat list of ``path: value`` pairs that ``grow`` turns into an object. What the
tests do not set comes from ``PLAIN``; who did something is named by a word of ``PEOPLE``.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import functions as F

REPO = "harbor/lantern"
STARS = 58

PEOPLE = {
    "mira": {"id": 501, "login": "mira", "type": "User"},
    "joren": {"id": 502, "login": "joren", "type": "User"},
    "sweeper": {"id": 7300, "login": "sweeper[bot]", "type": "Bot"},
}

PLAIN: dict[str, dict[str, Any]] = {
    "repositories": {
        "created_at": "2019-03-14T08:00:00Z",
        "default_branch": "trunk",
        "description": "Lights for small boats",
        "forks_count": 4,
        "language": "Python",
        "open_issues_count": 1,
        "pushed_at": "2024-06-11T06:45:00Z",
        "stargazers_count": STARS,
        **dict.fromkeys(("archived", "fork", "private"), False),
    },
    "commits": {"commit.message": "Trim the wick\n\nIt smoked."},
    "pull_requests": {"base.ref": "trunk", "draft": False, "closed_at": None, "merged_at": None},
    "issues": {"closed_at": None, "comments": 2, "labels": [{"name": "bug"}], "state_reason": None},
}


def grow(pairs: Mapping[str, Any]) -> dict:
    """``{"a.b": 1}`` as ``{"a": {"b": 1}}``."""
    out: dict = {}
    for path, value in pairs.items():
        *parents, last = path.split(".")
        node = out
        for part in parents:
            node = node.setdefault(part, {})
        node[last] = copy.deepcopy(value)
    return out


def account(who: str | dict | None) -> dict | None:
    return PEOPLE[who] if isinstance(who, str) else who


def repo(full_name: str = REPO, number: int = 61, **more: Any) -> dict:
    owner, name = full_name.split("/")
    named = {"id": number, "full_name": full_name, "name": name, "owner.login": owner}
    return grow(PLAIN["repositories"] | named | more)


def revision(
    seed: int,
    at: str,
    by: str | None = None,
    name: str | None = "Ines",
    mail: str | None = "ines@harbor.example",
    ancestors: int = 1,
) -> dict:
    """A commit whose author and committer are one person, with an account or without."""
    pairs: dict[str, Any] = dict(PLAIN["commits"])
    pairs["sha"] = format(seed, "x").rjust(40, "0")
    pairs["parents"] = [{"sha": "f" * 39 + format(k, "x")} for k in range(ancestors)]
    for role in ("author", "committer"):
        pairs[role] = account(by)
        pairs |= {f"commit.{role}.{k}": v for k, v in (("date", at), ("email", mail), ("name", name))}
    return grow(pairs)


def pull(number: int, opened: str, touched: str, by: Any, merged: str | None = None, **more: Any) -> dict:
    """An open pull request, or a merged one; its id is 200 more than its number."""
    pairs = PLAIN["pull_requests"] | {
        "id": 200 + number,
        "number": number,
        "created_at": opened,
        "updated_at": touched,
        "user": account(by),
        "state": "open",
        "title": f"Change {number}",
    }
    if merged:
        pairs |= {"state": "closed", "closed_at": merged, "merged_at": merged}
    return grow(pairs | more)


def verdict(key: int, by: str, state: str, at: str | None, pull_number: int = 1) -> tuple[dict, dict]:
    """A review and the context that says of which pull request."""
    return {"id": key, "state": state, "submitted_at": at, "user": account(by)}, {
        "pull_number": pull_number
    }


def ticket(number: int, opened: str, touched: str, by: Any, done: str | None = None, **more: Any) -> dict:
    """An open issue, or a completed one; its id is 800 more than its number."""
    pairs = PLAIN["issues"] | {
        "id": 800 + number,
        "number": number,
        "created_at": opened,
        "updated_at": touched,
        "user": account(by),
        "state": "open",
        "title": f"Report {number}",
    }
    if done:
        pairs |= {"state": "closed", "closed_at": done, "state_reason": "completed"}
    return grow(pairs | more)


# The instants below are those of the known results.
PULLS = [
    pull(2, "2024-06-03T09:00:00Z", "2024-06-05T09:00:00Z", "joren"),
    pull(1, "2024-06-01T09:00:00Z", "2024-06-02T21:00:00Z", "mira", "2024-06-02T21:00:00Z"),
]
REVIEWS = [
    verdict(9001, "joren", "CHANGES_REQUESTED", "2024-06-01T15:00:00Z"),
    verdict(9002, "joren", "APPROVED", "2024-06-02T20:00:00Z"),
]
ISSUES = [
    ticket(10, "2024-06-01T00:00:00Z", "2024-06-04T00:00:00Z", "mira", "2024-06-04T00:00:00Z"),
    ticket(11, "2024-06-02T00:00:00Z", "2024-06-02T00:00:00Z", "sweeper"),
]
COMMITS = [
    revision(1, "2024-06-02T20:30:00Z", "mira"),
    revision(2, "2024-06-03T08:00:00Z"),
    revision(3, "2024-06-10T08:00:00Z", "joren", ancestors=2),
]


def changed(payload: dict, path: str, value: Any) -> dict:
    """A copy of a payload with the value at a dotted path replaced."""
    out = copy.deepcopy(payload)
    *parents, last = path.split(".")
    node = out
    for part in parents:
        node = node[part]
    node[last] = value
    return out


def without(payload: dict, key: str) -> dict:
    return {k: v for k, v in payload.items() if k != key}


def listing(spark, payloads: Iterable, repository: str = REPO):
    """Payloads, or (payload, context) pairs, as raw envelopes."""
    pairs = [p if isinstance(p, tuple) else (p, {}) for p in payloads]
    rows = [(repository, json.dumps(c), json.dumps(d), k) for k, (d, c) in enumerate(pairs)]
    text = spark.createDataFrame(rows, "repository string, c string, d string, ingest_seq bigint")
    parsed = {name: F.parse_json(column) for name, column in (("context", "c"), ("data", "d"))}
    return text.withColumns(parsed).select("repository", "context", "data", "ingest_seq")


def listings(spark, pulls=PULLS, reviews=REVIEWS, issues=ISSUES, commits=COMMITS, repos=None):
    every = {
        "repositories": repos or [repo()],
        "commits": commits,
        "pull_requests": pulls,
        "reviews": reviews,
        "issues": issues,
    }
    return {entity: listing(spark, payloads) for entity, payloads in every.items()}
