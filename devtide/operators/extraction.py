"""Incremental extraction rules over landed API listings.

A listing is a DataFrame ``(repository, data, context, ingest_seq)`` per entity.
Windows, high-water marks and restrictions are joins and aggregations over it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.instants import parse_instant
from ..functions.payload import at, has_key, long_at, text_at, truthy
from ..schemas import ENTITIES, WATERMARKED
from .merge import merge_upsert

LOOKBACK_DAYS = 30
OVERLAP_MINUTES = 60

# The instant that places a record of a watermarked entity in time.
CHANGED_AT = {
    "commits": "commit.committer.date",
    "pull_requests": "updated_at",
    "issues": "updated_at",
}


def changed_at(entity: str) -> Column:
    return parse_instant(text_at(F.col("data"), CHANGED_AT[entity]))


def discover(listing: DataFrame, include_forks: bool = False) -> DataFrame:
    """Repository names of an owner's listing, without forks unless asked for."""
    data = F.col("data")
    keep = F.lit(include_forks) | ~truthy(at(data, "fork"))
    return listing.filter(keep).select(text_at(data, "full_name").alias("repository"))


def windows(
    repositories: DataFrame,
    watermarks: DataFrame,
    now: datetime | Column,
    lookback_days: int = LOOKBACK_DAYS,
    overlap_minutes: int = OVERLAP_MINUTES,
    entities: Iterable[str] = WATERMARKED,
) -> DataFrame:
    """Start of the extraction window per repository and entity."""
    now = F.lit(now)
    marks = watermarks.select(
        F.col("repository_full_name").alias("repository"),
        "entity",
        F.col("watermark_at").alias("previous"),
    )
    wanted = repositories.select(
        "repository", F.explode(F.array(*[F.lit(e) for e in entities])).alias("entity")
    )
    return wanted.join(marks, ["repository", "entity"], "left").select(
        "repository",
        "entity",
        "previous",
        F.coalesce(
            F.col("previous") - F.make_dt_interval(mins=F.lit(overlap_minutes)),
            now - F.make_dt_interval(days=F.lit(lookback_days)),
        ).alias("since"),
    )


def drop_pull_requests(listing: DataFrame) -> DataFrame:
    """The issue listing without the pull requests it also carries."""
    return listing.filter(~has_key(F.col("data"), "pull_request"))


def in_window(listing: DataFrame, entity: str, window: DataFrame) -> DataFrame:
    """Records that changed since the window start of their repository.

    A record without a readable instant is kept: the contract check decides on it.
    """
    since = F.col("since")
    if entity != "pull_requests":
        # The source filters these itself, at a resolution of one second.
        since = F.date_trunc("second", since)
    starts = window.filter(F.col("entity") == entity).select("repository", "since")
    # Columns of their own below the join: a condition would read the payload and parse the
    # instant anew wherever it names them.
    text = listing.withColumn("_text", text_at(F.col("data"), CHANGED_AT[entity]))
    placed = text.withColumn("_seen", parse_instant(F.col("_text"))).drop("_text")
    seen = F.col("_seen")
    kept = placed.join(starts, "repository").filter(seen.isNull() | (seen >= since))
    return kept.select(*listing.columns)


def reviews_of(reviews: DataFrame, pulls: DataFrame) -> DataFrame:
    """Reviews of the pull requests that are in the window."""
    numbers = pulls.select("repository", long_at(F.col("data"), "number").alias("_number"))
    keyed = reviews.withColumn("_number", long_at(F.col("context"), "pull_number")).alias("r")
    known = numbers.filter("_number IS NOT NULL").alias("p")
    # Equal or both NULL, which the filter rules out: a plain equality would have every context
    # read once more, below all joins that the reviews are made by, to leave out NULLs there.
    same = (F.col("r.repository") == F.col("p.repository")) & F.col("r._number").eqNullSafe(
        F.col("p._number")
    )
    return keyed.join(known, same, "left_semi").select(*[f"r.{c}" for c in reviews.columns])


def extract_increment(
    listings: dict[str, DataFrame],
    repositories: DataFrame,
    window: DataFrame,
) -> dict[str, DataFrame]:
    """The records of one run per entity."""
    pulls = in_window(listings["pull_requests"], "pull_requests", window)
    return {
        "repositories": listings["repositories"].join(
            repositories.select("repository"), "repository", "left_semi"
        ),
        "commits": in_window(listings["commits"], "commits", window),
        "pull_requests": pulls,
        "reviews": reviews_of(listings["reviews"], pulls),
        "issues": in_window(drop_pull_requests(listings["issues"]), "issues", window),
    }


# The same instant in the typed rows of an entity.
TYPED_CHANGED_AT = {
    "commits": "committed_at",
    "pull_requests": "updated_at",
    "issues": "updated_at",
}


def raw_changes(increment: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``(repository, changed)`` of raw records."""
    never = F.lit(None).cast("timestamp")
    return {
        entity: df.select(
            "repository", (changed_at(entity) if entity in CHANGED_AT else never).alias("changed")
        )
        for entity, df in increment.items()
    }


def typed_changes(rows: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``(repository, changed)`` of classified records, invalid ones included."""
    never = F.lit(None).cast("timestamp")
    return {
        entity: df.select(
            "repository",
            (
                F.col(TYPED_CHANGED_AT[entity]) if entity in TYPED_CHANGED_AT else never
            ).alias("changed"),
        )
        for entity, df in rows.items()
    }


def seen_per_repository(changes: Mapping[str, DataFrame]) -> DataFrame:
    """Record count and latest change per repository and entity, in one shuffle."""
    tagged = [df.withColumn("entity", F.lit(entity)) for entity, df in changes.items()]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("repository", "entity")
        .agg(F.count("*").alias("records"), F.max("changed").alias("max_seen"))
    )


def new_watermark(previous: Column, max_seen: Column, truncated: Column) -> Column:
    """High-water mark in whole seconds; a truncated listing keeps the previous one."""
    mark = F.when(truncated, previous).otherwise(F.greatest(previous, max_seen))
    return F.date_trunc("second", mark)


def extraction_plan(
    repositories: DataFrame, window: DataFrame, truncated: DataFrame
) -> DataFrame:
    """One row per repository and entity: the window, and whether the listing was cut.

    ``truncated`` holds ``(repository, entity, truncated)`` for the listings that
    were cut short by the page cap.
    """
    wanted = repositories.select(
        "repository", F.explode(F.array(*[F.lit(e) for e in ENTITIES])).alias("entity")
    )
    keys = ["repository", "entity"]
    cut = truncated.groupBy(*keys).agg(F.bool_or("truncated").alias("truncated"))
    return (
        wanted.join(window, keys, "left")
        .join(cut, keys, "left")
        .select(
            "entity",
            "repository",
            "previous",
            "since",
            F.coalesce("truncated", F.lit(False)).alias("truncated"),
        )
    )


def extraction_results(plan: DataFrame, changes: Mapping[str, DataFrame]) -> DataFrame:
    """What every planned listing brought, empty listings included, and its new mark."""
    marked = F.col("entity").isin(*WATERMARKED)
    mark = new_watermark(F.col("previous"), F.col("max_seen"), F.col("truncated"))
    return plan.join(seen_per_repository(changes), ["repository", "entity"], "left").select(
        "entity",
        "repository",
        F.coalesce("records", F.lit(0).cast("bigint")).alias("records"),
        F.date_trunc("second", "since").alias("since"),
        F.when(marked, mark).alias("new_watermark"),
        "truncated",
    )


def record_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("entity").agg(F.sum("records").alias("records"))


def merge_watermarks(
    watermarks: DataFrame, results: DataFrame, run_id: str, now: datetime | Column
) -> DataFrame:
    """Advance the stored marks; a mark never moves back, a missing one is skipped."""
    incoming = results.filter("new_watermark IS NOT NULL").select(
        F.col("repository").alias("repository_full_name"),
        "entity",
        F.col("new_watermark").alias("watermark_at"),
        F.lit(run_id).alias("updated_by_run"),
        F.lit(now).cast("timestamp").alias("updated_at"),
    )
    return merge_upsert(
        watermarks,
        incoming,
        ["repository_full_name", "entity"],
        update={
            "watermark_at": lambda old, new: F.greatest(old.watermark_at, new.watermark_at),
            "updated_by_run": lambda old, new: new.updated_by_run,
            "updated_at": lambda old, new: new.updated_at,
        },
    )
