"""The ten named analytics queries over the star schema.

Each query is a function from a star (a mapping of table name to DataFrame) to a
DataFrame. Facts are always aggregated before they meet a dimension, and windows
without a partition only ever see one row per week.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.instants import MICROS_PER_HOUR, micros_between, week_start
from ..operators.percentiles import exact_percentiles, value_counts

Star = Mapping[str, DataFrame]
Query = Callable[[Star, date], DataFrame]

QUERIES: dict[str, Query] = {}

TOP_CONTRIBUTORS = 25


def named(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _zero(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0))


def _rounded(value: Column) -> Column:
    """One decimal, half away from zero. Doubles go through a decimal first."""
    return F.round(value.cast("decimal(38,12)"), 1).cast("double")


def _by_week() -> Window:
    return Window.orderBy("week_start_date")


def _repository_names(star: Star) -> DataFrame:
    return star["dim_repository"].select("repository_key", F.col("full_name").alias("repository"))


@named
def weekly_commit_volume(star: Star, as_of: date) -> DataFrame:
    """Commits per week with distinct authors and the change to the previous listed week."""
    weekly = (
        star["fact_commit"]
        .select(
            week_start(F.col("committed_at")).alias("week_start_date"),
            "author_key",
            "is_merge_commit",
        )
        .groupBy("week_start_date")
        .agg(
            F.count("*").alias("commits"),
            F.count_distinct("author_key").alias("active_authors"),
            F.count_if("is_merge_commit").alias("merge_commits"),
        )
    )
    change = F.col("commits") - F.lag("commits").over(_by_week())
    return weekly.withColumn("change_vs_prev_week", change).orderBy("week_start_date")


@named
def weekly_pr_volume(star: Star, as_of: date) -> DataFrame:
    """Pull requests opened and merged per week, from one pass over the fact."""
    marks = F.array(
        *[
            F.struct(
                week_start(F.col(moment)).alias("week_start_date"),
                F.lit(opened).alias("opened"),
                F.lit(merged).alias("merged"),
            )
            for moment, opened, merged in (("created_at", 1, 0), ("merged_at", 0, 1))
        ]
    )
    return (
        star["fact_pull_request"]
        .select(F.inline(marks))
        .filter("week_start_date IS NOT NULL")
        .groupBy("week_start_date")
        .agg(F.sum("opened").alias("prs_opened"), F.sum("merged").alias("prs_merged"))
        .orderBy("week_start_date")
    )


@named
def pr_cycle_time_by_repository(star: Star, as_of: date) -> DataFrame:
    """Distribution of the open-to-merge time per repository.

    Cycle times are whole hundredths of an hour, so counting equal values first
    loses nothing and serves the mean and the percentiles alike.
    """
    hundredths = (F.col("cycle_time_hours") * 100).cast("bigint")
    merged = star["fact_pull_request"].filter("is_merged").select(
        "repository_key", hundredths.alias("value")
    )
    counts = value_counts(merged, ["repository_key"], "value", (12,))
    weighted = F.col("value").cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)")
    totals = counts.groupBy("repository_key").agg(
        F.sum("n").alias("merged_prs"), F.sum(weighted).alias("hundredths")
    )
    spread = exact_percentiles(counts, ["repository_key"], "value", {"p50": 0.5, "p90": 0.9})
    mean = F.col("hundredths").cast("decimal(28,10)") / (F.col("merged_prs") * 100).cast(
        "decimal(20,0)"
    )
    return (
        totals.join(spread, "repository_key")
        .join(_repository_names(star), "repository_key")
        .select(
            "repository",
            "merged_prs",
            _rounded(mean).alias("avg_hours_to_merge"),
            _rounded(F.col("p50") / 100).alias("median_hours_to_merge"),
            _rounded(F.col("p90") / 100).alias("p90_hours_to_merge"),
        )
        .orderBy(F.desc("merged_prs"), "repository")
    )


@named
def avg_time_to_merge_trend(star: Star, as_of: date) -> DataFrame:
    """Weekly mean of hours to merge and the mean of the last four listed weeks."""
    weekly = (
        star["fact_pull_request"]
        .filter("is_merged")
        .groupBy(week_start(F.col("merged_at")).alias("week_start_date"))
        .agg(
            F.count("*").alias("merged_prs"),
            F.avg(F.col("cycle_time_hours").cast("decimal(28,14)")).alias("avg_hours"),
        )
    )
    moving = F.avg("avg_hours").over(_by_week().rowsBetween(-3, Window.currentRow))
    return weekly.select(
        "week_start_date",
        "merged_prs",
        _rounded(F.col("avg_hours")).alias("avg_hours_to_merge"),
        _rounded(moving).alias("moving_avg_4w"),
    ).orderBy("week_start_date")


@named
def review_activity(star: Star, as_of: date) -> DataFrame:
    """Review coverage, mix and time to the first review per repository.

    Each fact is read once: reviews are reduced to one row a pull request, which is joined to
    its pull request, unique on both sides, and counted by (repository, delay). The sums of a
    repository and its median come from these counts. The repository of a review is that of its
    pull request.
    """
    state = F.col("review_state")
    reviews = (
        star["fact_review"]
        .groupBy("pull_request_key")
        .agg(
            F.count("*").alias("total_reviews"),
            F.count_if(state == "APPROVED").alias("approvals"),
            F.count_if(state == "CHANGES_REQUESTED").alias("change_requests"),
            F.min("submitted_at").alias("first_review_at"),
        )
    )
    mix = ["total_reviews", "approvals", "change_requests"]
    delay = micros_between(F.col("created_at"), F.col("first_review_at"))
    waited = (
        star["fact_pull_request"]
        .select("pull_request_key", "repository_key", "created_at")
        .join(reviews, "pull_request_key", "left")
        .select("repository_key", *mix, delay.alias("value"))
    )
    counts = value_counts(waited, ["repository_key"], "value", (34, 17), mix)
    totals = counts.groupBy("repository_key").agg(
        F.sum("n").alias("prs"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("prs_reviewed"),
        *[F.sum(c).alias(c) for c in mix],
    )
    median = exact_percentiles(counts, ["repository_key"], "value", {"p50": 0.5})
    percent = (_zero("prs_reviewed") * 100).cast("decimal(28,10)") / F.col("prs").cast(
        "decimal(20,0)"
    )
    return (
        totals.join(median, "repository_key", "left")
        .join(_repository_names(star), "repository_key")
        .select(
            "repository",
            "prs",
            _zero("prs_reviewed").alias("prs_reviewed"),
            _rounded(percent).alias("pct_reviewed"),
            _zero("total_reviews").alias("total_reviews"),
            _zero("approvals").alias("approvals"),
            _zero("change_requests").alias("change_requests"),
            _rounded(F.col("p50") / MICROS_PER_HOUR).alias("median_hours_to_first_review"),
        )
        .orderBy(F.desc("prs"), "repository")
    )


@named
def contributor_activity(star: Star, as_of: date) -> DataFrame:
    """The most active people, bots excluded, densely ranked by total activity.

    The three facts are counted per person in a single shuffle behind partial
    aggregation. The ranking sees only the rows of the report: a dense rank depends
    on earlier rows alone, and the report is a prefix of the ranked order.
    """
    nothing = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")

    def marked(table: str, person: str, **marks: Column) -> DataFrame:
        counted = ("commits", "prs_opened", "prs_merged", "reviews_given")
        return (
            star[table]
            .filter(F.col(person).isNotNull())
            .select(
                F.col(person).alias("contributor_key"),
                *[marks.get(c, nothing).alias(c) for c in counted],
            )
        )

    merged = F.when(F.col("is_merged"), one).otherwise(nothing)
    activity = (
        marked("fact_commit", "author_key", commits=one)
        .unionByName(marked("fact_pull_request", "author_key", prs_opened=one, prs_merged=merged))
        .unionByName(marked("fact_review", "reviewer_key", reviews_given=one))
        .groupBy("contributor_key")
        .agg(
            *[
                F.sum(c).alias(c)
                for c in ("commits", "prs_opened", "prs_merged", "reviews_given")
            ]
        )
    )
    people = (
        star["dim_contributor"]
        .filter("NOT is_bot")
        .select("contributor_key", F.coalesce("login", "display_name").alias("contributor"))
    )
    score = F.col("commits") + F.col("prs_opened") + F.col("reviews_given")
    top = (
        activity.join(people, "contributor_key")
        .withColumn("score", score)
        .orderBy(F.desc("score"), F.asc_nulls_last("contributor"), "contributor_key")
        .limit(TOP_CONTRIBUTORS)
    )
    rank = F.dense_rank().over(Window.orderBy(F.desc("score"))).cast("bigint")
    return (
        top.withColumn("activity_rank", rank)
        .orderBy("activity_rank", F.asc_nulls_last("contributor"), "contributor_key")
        .select(
            "activity_rank", "contributor", "commits", "prs_opened", "prs_merged", "reviews_given"
        )
    )


@named
def repository_activity(star: Star, as_of: date) -> DataFrame:
    """Scorecard of every repository, those without activity included."""
    commits = (
        star["fact_commit"]
        .groupBy("repository_key")
        .agg(
            F.count("*").alias("commits"),
            F.count_distinct("author_key").alias("commit_authors"),
            F.max("committed_at").alias("last_commit_at"),
        )
    )
    pulls = star["fact_pull_request"].groupBy("repository_key").agg(
        F.count("*").alias("pull_requests")
    )
    issues = star["fact_issue"].groupBy("repository_key").agg(F.count("*").alias("issues"))
    return (
        star["dim_repository"]
        .select(
            "repository_key",
            F.col("full_name").alias("repository"),
            "language",
            F.col("stargazers_count").alias("stars"),
        )
        .join(commits, "repository_key", "left")
        .join(pulls, "repository_key", "left")
        .join(issues, "repository_key", "left")
        .select(
            "repository",
            "language",
            "stars",
            *[
                _zero(c).alias(c)
                for c in ("commits", "commit_authors", "pull_requests", "issues")
            ],
            "last_commit_at",
        )
        .orderBy(F.desc("commits"), "repository")
    )


@named
def issues_open_vs_closed(star: Star, as_of: date) -> DataFrame:
    """Issues opened and closed per week with the running net change."""
    marks = F.array(
        *[
            F.struct(
                week_start(F.col(moment)).alias("week_start_date"),
                F.lit(opened).alias("opened"),
                F.lit(closed).alias("closed"),
            )
            for moment, opened, closed in (("created_at", 1, 0), ("closed_at", 0, 1))
        ]
    )
    weekly = (
        star["fact_issue"]
        .select(F.inline(marks))
        .filter("week_start_date IS NOT NULL")
        .groupBy("week_start_date")
        .agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"))
    )
    running = F.sum(F.col("opened") - F.col("closed")).over(_by_week())
    return weekly.withColumn("net_open_change_cumulative", running).orderBy("week_start_date")


@named
def issue_resolution_by_repository(star: Star, as_of: date) -> DataFrame:
    """Open and closed issues and the mean time to close per repository."""
    closed = F.col("state") == "closed"
    per_repository = (
        star["fact_issue"]
        .groupBy("repository_key")
        .agg(
            F.count_if(F.col("state") == "open").alias("open_issues"),
            F.count_if(closed).alias("closed_issues"),
            F.sum(F.when(closed, F.col("time_to_close_hours"))).alias("hours"),
            F.count(F.when(closed, F.col("time_to_close_hours"))).alias("timed"),
            F.count_if(F.col("state_reason") == "not_planned").alias("closed_not_planned"),
        )
    )
    days = F.when(
        F.col("timed") > 0,
        F.col("hours").cast("decimal(28,10)") / (F.col("timed") * 24).cast("decimal(20,0)"),
    )
    return (
        per_repository.join(_repository_names(star), "repository_key")
        .select(
            "repository",
            "open_issues",
            "closed_issues",
            _rounded(days).alias("avg_days_to_close"),
            "closed_not_planned",
        )
        .orderBy(F.desc("open_issues"), "repository")
    )


@named
def engineering_activity_trends(star: Star, as_of: date) -> DataFrame:
    """All activity per week from the first pull request on, with a running total.

    Weeks before the first pull request are left out together with their commits;
    without any pull request there is no row.
    """
    kinds = {
        "commits": ("fact_commit", "committed_at"),
        "prs_opened": ("fact_pull_request", "created_at"),
        "reviews": ("fact_review", "submitted_at"),
        "issues_opened": ("fact_issue", "created_at"),
    }
    marks = [
        star[table].select(
            week_start(F.col(moment)).alias("week_start_date"),
            *[F.lit(int(k == kind)).cast("bigint").alias(k) for k in kinds],
        )
        for kind, (table, moment) in kinds.items()
    ]
    summed = (
        reduce(DataFrame.unionByName, marks)
        .groupBy("week_start_date")
        .agg(*[F.sum(k).alias(k) for k in kinds])
    )
    # One row per week from here on, so the unpartitioned windows stay small.
    first_pr = F.min(F.when(F.col("prs_opened") > 0, F.col("week_start_date"))).over(
        Window.orderBy(F.lit(0)).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
    )
    return (
        summed.withColumn("first_pr", first_pr)
        .filter(F.col("week_start_date") >= F.col("first_pr"))
        .filter(F.col("week_start_date") <= F.trunc(F.lit(as_of).cast("date"), "week"))
        .select(
            "week_start_date",
            *kinds,
            F.sum("commits").over(_by_week()).alias("cumulative_commits"),
        )
        .orderBy("week_start_date")
    )


def run_queries(star: Star, as_of: date | datetime) -> dict[str, DataFrame]:
    """Every named query as a lazy DataFrame."""
    return {name: query(star, as_of) for name, query in QUERIES.items()}


PREVIEW_ROWS = 15


def preview(result: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a report, in report order."""
    return result.limit(rows)
