"""The activity model bound to a TPC-H-like data set.

``nation`` plays the repositories, ``customer`` the contributors, ``orders`` the
pull requests and (the urgent ones) the issues, ``lineitem`` the reviews and
``events`` the commits. Besides the star itself the binding renders the same rows
as raw JSON envelopes, with records broken on purpose where the data says so.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import date_key
from ..operators.dedupe import keep_last
from ..operators.star import with_generated
from ..session import configure
from ..sources.calendar import calendar_days

CALENDAR = (date(1995, 1, 1), date(2024, 12, 31))
AS_OF = date(2024, 12, 31)
NOW = datetime(2024, 12, 31)

REPOSITORIES = 25
MAX_LINES = 8


# The layout of the given tables; naming it saves a footer read per scan.
LAYOUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with its zone-less timestamps read as UTC instants."""
    df = configure(spark).read.schema(LAYOUT[name]).parquet(f"{sf_dir}/{name}.parquet")
    columns = dict(part.split(" ", 1) for part in LAYOUT[name].split(", "))
    return df.select(
        *[
            F.col(c).cast("timestamp").alias(c) if kind == "timestamp_ntz" else F.col(c)
            for c, kind in columns.items()
        ]
    )


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


# ------------------------------------------------------------------ dimensions
def dim_date(spark: SparkSession) -> DataFrame:
    return calendar_days(spark, *CALENDAR)


def dim_repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (table(spark, sf_dir, t) for t in ("nation", "region"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("repository_key"),
        F.col("n_nationkey").cast("bigint").alias("github_repo_id"),
        F.col("n_name").alias("full_name"),
        F.col("r_name").alias("language"),
        F.lit(0).cast("bigint").alias("stargazers_count"),
    )


def dim_contributor(spark: SparkSession, sf_dir: str) -> DataFrame:
    bot = F.col("c_mktsegment") == "MACHINERY"
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("contributor_key"),
        F.concat(F.lit("gh:"), F.lower("c_name")).alias("contributor_nk"),
        F.col("c_custkey").alias("github_user_id"),
        F.col("c_name").alias("login"),
        F.col("c_name").alias("display_name"),
        F.when(bot, "Bot").otherwise("User").alias("user_type"),
        bot.alias("is_bot"),
    )


# ----------------------------------------------------------------------- facts
def shipped_orders(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Orders with their repository and the first shipment on or after the order date.

    One shuffle per side: the aggregation groups by the join key (and columns that
    depend on it), so it runs on the partitions of the join. Never as a correlated
    subquery, which Spark would run as a nested loop.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderdate",
        "o_orderpriority",
        *extra,
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("nation")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    later = (F.col("l_orderkey") == F.col("o_orderkey")) & (
        F.col("l_shipdate") >= F.col("o_orderdate")
    )
    return (
        orders.join(lines, later, "left")
        .groupBy(*orders.columns)
        .agg(F.min("l_shipdate").alias("shipped_at"))
        .join(customer, "o_custkey")
    )


def _state() -> Column:
    return F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed")


def fact_pull_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    closed_at = F.when(status != "O", F.col("shipped_at"))
    rows = (
        shipped_orders(spark, sf_dir)
        .withColumns(
            {
                "closed_at": closed_at,
                "merged_at": F.when(status == "F", F.col("shipped_at")),
                "created_at": F.col("o_orderdate"),
                "updated_at": F.coalesce(closed_at, F.col("o_orderdate")),
            }
        )
        .select(
            F.col("o_orderkey").alias("pull_request_key"),
            F.col("nation").alias("repository_key"),
            F.col("o_custkey").alias("author_key"),
            F.col("o_orderkey").alias("pr_number"),
            F.col("o_orderpriority").alias("title"),
            _state().alias("state"),
            F.lit(False).alias("is_draft"),
            "created_at",
            "updated_at",
            "closed_at",
            "merged_at",
            *[
                date_key(F.col(f"{c}_at")).alias(f"{c}_date_key")
                for c in ("created", "closed", "merged")
            ],
            F.lit("main").alias("base_ref"),
            _null("string").alias("html_url"),
            F.lit(NOW).alias("loaded_at"),
        )
    )
    return with_generated(rows, "fact_pull_request")


def unchecked_pull_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pull request fact as it would look without a sane merge time.

    Every pull request counts as merged at its earliest shipment, which for many
    orders lies before the order date: input for the quality checks.
    """
    first = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("pull_request_key"))
        .agg(F.min("l_shipdate").alias("merged_at"))
    )
    base = fact_pull_request(spark, sf_dir).drop("merged_at")
    return with_generated(base.join(first, "pull_request_key", "left"), "fact_pull_request")


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items on or after the order date, several of them per review id."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("nation")
    )
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .filter(F.col("l_shipdate") >= F.col("o_orderdate"))
        .join(customer, "o_custkey")
        .withColumn("review_id", F.col("l_orderkey") * MAX_LINES + F.col("l_linenumber"))
    )


LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def review_state() -> Column:
    flag = F.col("l_returnflag")
    return (
        F.when(flag == "A", "APPROVED")
        .when(flag == "R", "CHANGES_REQUESTED")
        .otherwise("COMMENTED")
    )


def fact_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = review_lines(spark, sf_dir).select(
        "review_id", "l_orderkey", "nation", "l_suppkey", "l_returnflag", *LINE_ORDER[:2],
        LINE_ORDER[3],
    )
    unique = keep_last(lines, ["review_id"], [F.col(c) for c in LINE_ORDER])
    rows = unique.select(
        F.col("review_id").alias("review_key"),
        F.col("l_orderkey").alias("pull_request_key"),
        F.col("nation").alias("repository_key"),
        F.col("l_suppkey").alias("reviewer_key"),
        review_state().alias("review_state"),
        F.col("l_shipdate").alias("submitted_at"),
        date_key(F.col("l_shipdate")).alias("submitted_date_key"),
        F.lit(NOW).alias("loaded_at"),
    )
    return with_generated(rows, "fact_review")


def is_issue() -> Column:
    return F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")


def fact_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    closed_at = F.when(status != "O", F.col("shipped_at"))
    rows = (
        shipped_orders(spark, sf_dir)
        .filter(is_issue())
        .withColumn("closed_at", closed_at)
        .select(
            F.col("o_orderkey").alias("issue_key"),
            F.col("nation").alias("repository_key"),
            F.col("o_custkey").alias("author_key"),
            F.col("o_orderkey").alias("issue_number"),
            F.col("o_orderpriority").alias("title"),
            _state().alias("state"),
            F.when(status == "P", "not_planned").alias("state_reason"),
            F.col("o_orderdate").alias("created_at"),
            F.coalesce("closed_at", "o_orderdate").alias("updated_at"),
            "closed_at",
            date_key(F.col("o_orderdate")).alias("created_date_key"),
            date_key(F.col("closed_at")).alias("closed_date_key"),
            F.lit(0).cast("bigint").alias("comments_count"),
            F.array("o_orderpriority").alias("labels"),
            F.lit(NOW).alias("loaded_at"),
        )
    )
    return with_generated(rows, "fact_issue")


def sha() -> Column:
    return F.lpad(F.lower(F.hex("event_id")), 40, "0")


def parents() -> Column:
    return F.get_json_object("props", "$.k").cast("int") % 3


def fact_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        (F.col("user_id") % REPOSITORIES).alias("repository_key"),
        sha().alias("commit_sha"),
        F.col("user_id").alias("author_key"),
        F.col("user_id").alias("committer_key"),
        date_key(F.col("ts")).alias("authored_date_key"),
        date_key(F.col("ts")).alias("committed_date_key"),
        F.col("ts").alias("authored_at"),
        F.col("ts").alias("committed_at"),
        F.col("event_type").alias("message_headline"),
        parents().alias("parent_count"),
        _null("string").alias("html_url"),
        F.lit(NOW).alias("loaded_at"),
    )
    return with_generated(rows, "fact_commit")


class BoundStar(Mapping):
    """The star over the given tables; a table is only built when it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._builders = {
            "dim_date": lambda: dim_date(spark),
            "dim_repository": lambda: dim_repository(spark, sf_dir),
            "dim_contributor": lambda: dim_contributor(spark, sf_dir),
            "fact_commit": lambda: fact_commit(spark, sf_dir),
            "fact_pull_request": lambda: fact_pull_request(spark, sf_dir),
            "fact_review": lambda: fact_review(spark, sf_dir),
            "fact_issue": lambda: fact_issue(spark, sf_dir),
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


