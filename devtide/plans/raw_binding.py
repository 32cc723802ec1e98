"""The given tables rendered as raw API payloads.

The payloads carry what real ones do: several snapshots of a record, copies, accounts
without an id, drafts, missing keys and JSON nulls. Where a property of the data says
so, a record breaks its contract. ``raw_oracle`` states the same in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .binding import (
    REPOSITORIES,
    is_issue,
    review_lines,
    review_state,
    sha,
    shipped_orders,
    table,
)

EXTRACTED_AT = datetime(2024, 12, 31)

# A second copy of a record lands after all first copies.
LATER = 1_000_000_000_000_000

def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _json(text: Column) -> Column:
    """A payload value of varying JSON type, given as JSON text."""
    return F.parse_json(F.coalesce(text, F.lit("null")))


def _payload(fields: Column) -> Column:
    """A struct as a JSON value, nulls kept as JSON nulls: what its JSON text reads as, without
    writing that text and parsing it."""
    return F.to_variant_object(fields)


def account(number: Column, login: Column, uid: Column | None = None) -> Column:
    kind = F.when(number % 10 == 0, "Bot").otherwise("User")
    uid = number if uid is None else uid
    return F.struct(login.alias("login"), uid.alias("id"), kind.alias("type"))


def login_of(number: Column) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(number.cast("string"), 9, "0"))


def _envelope(rows: DataFrame, payload: Column, seq: Column, context: Column | None = None):
    return rows.select(
        F.col("n_name").alias("repository"),
        F.lit(EXTRACTED_AT).alias("extracted_at"),
        F.parse_json(F.lit("{}") if context is None else context).alias("context"),
        _payload(payload).alias("data"),
        seq.cast("bigint").alias("ingest_seq"),
    )


def _named(rows: DataFrame, spark: SparkSession, sf_dir: str, nation: Column) -> DataFrame:
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return rows.join(names, nation == names.n_nationkey)


def raw_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (table(spark, sf_dir, t) for t in ("nation", "region"))
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey)
    region_name = F.col("r_name")
    payload = F.struct(
        F.col("n_nationkey").alias("id"),
        F.lower("n_name").alias("name"),
        F.col("n_name").alias("full_name"),
        F.struct(
            F.when(region_name == "AFRICA", "").otherwise(region_name).alias("login")
        ).alias("owner"),
        F.lit(None).cast("string").alias("description"),
        F.lit(False).alias("private"),
        (region_name == "EUROPE").alias("fork"),
        region_name.alias("language"),
        F.lit("main").alias("default_branch"),
        F.lit("2020-01-01T00:00:00Z").alias("created_at"),
        F.lit("2024-06-10 12:00:00,5+02:00").alias("pushed_at"),
        (F.col("n_nationkey") * 2).alias("stargazers_count"),
    )
    return _envelope(rows, payload, F.col("n_nationkey"))


def raw_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    views = events.filter("event_type = 'view'")
    rows = events.withColumns(
        {"seq": F.col("event_id"), "copy": F.lit(False)}
    ).unionByName(
        views.withColumns({"seq": F.col("event_id") + LATER, "copy": F.lit(True)})
    )
    # A file of few row groups is read by few tasks; the payloads are built and checked by many.
    rows = rows.repartition("seq")
    rows = _named(rows, spark, sf_dir, F.col("user_id") % REPOSITORIES)
    rows = rows.withColumns({"k": k, "at": iso(F.col("ts")), "sha": sha()})
    kind, number = F.col("event_type"), F.col("user_id")
    k = F.col("k")
    person = F.struct(
        F.when(F.col("value") >= 1, F.concat(F.lit("Dev "), number.cast("string"))).alias("name"),
        F.when(
            F.col("value") >= 10,
            F.concat(F.lit(" User"), number.cast("string"), F.lit("@Example.org\t")),
        ).alias("email"),
        F.col("at").alias("date"),
    )
    committer_date = F.when(k == 17, "not-a-date").otherwise(F.col("at"))
    message = (
        F.when(F.col("copy"), "again")
        .when(k == 0, "")
        .when(k == 1, F.concat(F.lit("\n"), kind))
        .otherwise(F.concat(kind, F.lit("\r\n"), F.col("props")))
    )
    linked = F.when(kind != "error", account(number, login_of(number)))
    payload = F.struct(
        F.when(k == 13, F.substring("sha", 2, 39)).otherwise(F.col("sha")).alias("sha"),
        F.struct(
            person.alias("author"),
            person.withField("date", committer_date).alias("committer"),
            message.alias("message"),
        ).alias("commit"),
        linked.alias("author"),
        linked.alias("committer"),
        F.when(k == 42, _payload(F.struct(F.lit(2).alias("count"))))
        .otherwise(_payload(F.array_repeat(F.struct(F.lit("x").alias("sha")), k % 3)))
        .alias("parents"),
    )
    return _envelope(rows, payload, F.col("seq"))


def raw_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots per order: as opened, and as it stands at the end."""
    rows = shipped_orders(spark, sf_dir, "o_totalprice").withColumn(
        "final", F.explode(F.array(F.lit(False), F.lit(True)))
    )
    rows = _named(rows, spark, sf_dir, F.col("nation"))
    status, final, price = F.col("o_orderstatus"), F.col("final"), F.col("o_totalprice")
    closed_at = F.when(final & (status != "O"), F.col("shipped_at"))
    state = (
        F.when(~final | (status == "O"), "open")
        .when((status == "P") & (F.col("o_orderpriority") == "5-LOW"), "merged")
        .otherwise("closed")
    )
    updated = F.when(final & (price < 5000), "not-a-date").otherwise(
        iso(F.coalesce(closed_at, F.col("o_orderdate")))
    )
    number = F.col("o_custkey")
    key = F.col("o_orderkey")
    payload = F.struct(
        F.when(price > 495000, key.cast("string").cast("variant"))
        .otherwise(key.cast("variant"))
        .alias("id"),
        key.alias("number"),
        F.when(
            ~price.between(5000, 10000), account(number, login_of(number))
        ).alias("user"),
        F.col("o_orderpriority").alias("title"),
        state.alias("state"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(True)).alias("draft"),
        iso(F.col("o_orderdate")).alias("created_at"),
        updated.alias("updated_at"),
        iso(closed_at).alias("closed_at"),
        F.when(status == "F", iso(closed_at)).alias("merged_at"),
        F.struct(F.lit("main").alias("ref")).alias("base"),
    )
    return _envelope(rows, payload, key * 2 + final.cast("int"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _named(review_lines(spark, sf_dir), spark, sf_dir, F.col("nation"))
    number = F.col("l_suppkey")
    uid = F.when(F.col("l_returnflag") != "N", number)
    pending = (F.col("l_linestatus") == "O") & (F.col("l_discount") == 0)
    payload = F.struct(
        F.col("review_id").alias("id"),
        account(number, login_of(number), uid).alias("user"),
        F.when(F.col("l_quantity") == 1, "").otherwise(review_state()).alias("state"),
        F.when(~pending, iso(F.col("l_shipdate"))).alias("submitted_at"),
    )
    without_number = (F.col("l_tax") == 0) & (F.col("l_discount") == 0.1)
    context = F.when(without_number, "{}").otherwise(
        F.concat(F.lit('{"pull_number":'), F.col("l_orderkey").cast("string"), F.lit("}"))
    )
    seq = F.unix_date(F.to_date("l_shipdate")).cast("bigint") * 100_000_000_000 + F.col("l_partkey")
    return _envelope(rows, payload, seq, context)


def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issue listing; the merged urgent ones are pull requests in disguise."""
    rows = shipped_orders(spark, sf_dir, "o_totalprice").filter(is_issue())
    rows = _named(rows, spark, sf_dir, F.col("nation"))
    status, price, number = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_custkey")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    closed_at = F.when(status != "O", F.col("shipped_at"))
    state = (
        F.when(price < 5000, "reopened").when(status == "O", "open").otherwise("closed")
    )
    marks = F.when(~urgent & (status == "O"), "null").otherwise(
        F.concat(
            F.lit('[{"name": "'),
            F.col("o_orderpriority"),
            F.lit('"}, "text", {"name": "'),
            status,
            F.lit('"}]'),
        )
    )
    key = F.col("o_orderkey")
    base = F.struct(
        key.alias("id"),
        F.when(price <= 495000, key).alias("number"),
        F.col("o_orderpriority").alias("title"),
        account(number, F.lower(login_of(number))).alias("user"),
        state.alias("state"),
        F.when(status == "P", "not_planned").alias("state_reason"),
        iso(F.col("o_orderdate")).alias("created_at"),
        iso(F.coalesce(closed_at, F.col("o_orderdate"))).alias("updated_at"),
        iso(closed_at).alias("closed_at"),
        _json(marks).alias("labels"),
    )
    # The keys present differ by record: open ones carry no comment count, and a key
    # with a null value marks a pull request.
    with_comments = base.withField(
        "comments", F.when(status == "P", F.lit(3)).otherwise(F.lit(None).cast("int"))
    )
    marked = with_comments.withField("pull_request", F.lit(None).cast("string"))
    data = (
        F.when(status == "O", _payload(base))
        .when(urgent & (status == "F"), _payload(marked))
        .otherwise(_payload(with_comments))
    )
    return rows.select(
        F.col("n_name").alias("repository"),
        F.lit(EXTRACTED_AT).alias("extracted_at"),
        F.parse_json(F.lit("{}")).alias("context"),
        data.alias("data"),
        key.alias("ingest_seq"),
    )


class RawRecords(Mapping):
    """Raw envelopes per entity over the given tables, built when they are used."""

    BUILDERS = {
        "repositories": raw_repositories,
        "commits": raw_commits,
        "pull_requests": raw_pull_requests,
        "reviews": raw_reviews,
        "issues": raw_issues,
    }

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._at = (spark, sf_dir)

    def __getitem__(self, entity: str) -> DataFrame:
        return self.BUILDERS[entity](*self._at)

    def __iter__(self):
        return iter(self.BUILDERS)

    def __len__(self) -> int:
        return len(self.BUILDERS)
