from datetime import datetime

import pytest
from pyspark.sql import functions as F

from devtide.functions.payload import opened
from devtide.sources.staging import read_classified, write_classified
from devtide.functions.text import headline
from devtide.operators import flatten
from devtide.schemas import ENTITIES

from . import samples as s


def staged(spark, entity, records):
    return flatten.stage(flatten.flat_rows(s.listing(spark, records), entity), entity)


def one(spark, entity, record):
    return staged(spark, entity, [record]).first()


def test_commit_of_a_linked_account(spark):
    row = one(spark, "commits", s.COMMITS[0])
    assert (row.author_nk, row.committer_nk) == ("gh:mira", "gh:mira")
    assert row.message_headline == "Trim the wick"
    assert row.parent_count == 1
    assert row.committed_at == datetime(2024, 6, 2, 20, 30)


def test_unlinked_key_ignores_case_and_blanks(spark):
    emails = ["Ines@Harbor.example", " ines@harbor.example ", "\tINES@HARBOR.EXAMPLE\n"]
    rows = staged(
        spark, "commits",
        [s.revision(i, "2024-06-02T20:30:00Z", None, "Ines", e) for i, e in enumerate(emails)],
    )
    keys = {r.author_nk for r in rows.collect()}
    assert len(keys) == 1 and keys.pop().startswith("git:")
    people = flatten.flat_rows(s.listing(spark, [s.COMMITS[1]]), "commits").first().people
    assert people[0].display_name == "Ines" and people[0].user_type == "Unlinked"
    assert "ines@" not in str(people)


def test_nobody_and_name_only(spark):
    nobody = s.revision(1, "2024-06-02T20:30:00Z", None, None, None)
    named = s.revision(2, "2024-06-02T20:30:00Z", None, "build[bot]", "")
    rows = flatten.flat_rows(s.listing(spark, [nobody, named]), "commits").orderBy("_seq").collect()
    assert rows[0].author_nk is None and rows[0].people == [None, None]
    assert rows[1].people[0].is_bot is True


def test_bots(spark):
    prs = [
        s.pull(i, "2024-06-01T00:00:00Z", "2024-06-01T00:00:00Z", who)
        for i, who in enumerate(["sweeper", {"login": "x[bot]", "id": 1}, "mira"])
    ]
    rows = flatten.flat_rows(s.listing(spark, prs), "pull_requests").orderBy("_seq").collect()
    assert [r.people[0].is_bot for r in rows] == [True, True, False]
    assert rows[1].people[0].user_type == "User"


def test_pull_request_mapping(spark):
    row = one(spark, "pull_requests", s.PULLS[1])
    assert (row.github_pr_id, row.pr_number, row.state, row.base_ref) == (201, 1, "closed", "trunk")
    assert row.is_draft is False and row.merged_at == datetime(2024, 6, 2, 21)
    bare = one(spark, "pull_requests", s.without(s.without(s.PULLS[1], "base"), "draft"))
    assert bare.base_ref is None and bare.is_draft is False
    ghost = one(spark, "pull_requests", s.changed(s.PULLS[1], "user", None))
    assert ghost.author_nk is None


@pytest.mark.parametrize(
    ("value", "flag"),
    [(True, True), (False, False), (None, False), (0, False), (0.0, False), (2, True),
     ("", False), ("0", True), ("false", True), ([], False), ([0], True), ({}, False)],
)
def test_truthiness(spark, value, flag):
    assert one(spark, "repositories", s.repo(private=value)).is_private is flag


def test_pending_reviews_are_dropped(spark):
    rows = staged(
        spark, "reviews",
        [s.verdict(1, "joren", "PENDING", None, 1), s.REVIEWS[0]],
    )
    assert [r.github_review_id for r in rows.collect()] == [9001]


def test_last_copy_wins_but_first_commit(spark):
    first = s.ticket(1, "2024-06-01T00:00:00Z", "2024-06-01T00:00:00Z", "mira")
    second = s.changed(first, "state", "closed")
    rows = staged(spark, "issues", [first, second]).collect()
    assert [r.state for r in rows] == ["closed"]
    again = s.changed(s.COMMITS[0], "commit.message", "other")
    rows = staged(spark, "commits", [s.COMMITS[0], again]).collect()
    assert [r.message_headline for r in rows] == ["Trim the wick"]


def test_labels(spark):
    def labels(value):
        return one(spark, "issues", s.changed(s.ISSUES[0], "labels", value)).labels

    assert labels([{"name": "a"}, "b", None, {"name": "c"}]) == ["a", "c"]
    assert labels([]) == [] and labels(None) == []
    assert one(spark, "issues", s.without(s.ISSUES[0], "labels")).labels == []


def test_comments(spark):
    assert one(spark, "issues", s.ISSUES[0]).comments_count == 2
    assert one(spark, "issues", s.without(s.ISSUES[0], "comments")).comments_count == 0
    assert one(spark, "issues", s.changed(s.ISSUES[0], "comments", None)).comments_count is None


def test_empty_input_keeps_the_types(spark):
    nothing = s.listing(spark, [s.ISSUES[0]]).limit(0)
    rows = {e: flatten.flat_rows(nothing, e) for e in ENTITIES}
    tables = flatten.stage_all(rows)
    assert tables["pull_requests"].schema["created_at"].dataType.simpleString() == "timestamp"
    assert all(df.count() == 0 for df in tables.values())


def test_contributor_with_an_id_wins_then_the_last_seen(spark):
    users = [{"login": "Al", "id": 7}, {"login": "al"}, {"login": "AL", "id": 7, "type": "Bot"}]
    prs = [s.pull(i, "2024-06-01T00:00:00Z", "2024-06-01T00:00:00Z", u) for i, u in enumerate(users)]
    data = s.listings(spark, pulls=prs, reviews=[s.REVIEWS[0]], issues=[s.ISSUES[0]], commits=[s.COMMITS[0]])
    people = flatten.stage_all({e: flatten.flat_rows(data[e], e) for e in ENTITIES})["contributors"]
    al = people.filter("contributor_nk = 'gh:al'").collect()
    assert [(r.login, r.github_user_id, r.is_bot) for r in al] == [("AL", 7, True)]
    assert people.count() == 3


HEADLINES = [
    ("one\ntwo", "one"), ("one\r\ntwo", "one"), ("one\x0btwo", "one"), ("one two", "one"),
    ("\nlate", ""), ("", None), (None, None), ("é" * 300, "é" * 250), ("😀" * 251, "😀" * 250),
    ("tab\tkept", "tab\tkept"),
]


@pytest.mark.parametrize(("text", "expected"), HEADLINES)
def test_headline(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string").select(headline(F.col("t"))).first()
    assert row[0] == expected
    if text:
        assert expected == text.splitlines()[0][:250]


def test_a_payload_is_opened_as_path_by_path(spark):
    payloads = [
        '{"a": 1, "b": {"c": "x", "d": null}, "e": "7"}',
        '{"a": "1", "b": null}',
        '{"b": [1], "a": 1.0, "e": {"f": 1}}',
        "[]",
        "null",
    ]
    rows = spark.createDataFrame([(p,) for p in payloads], "text string").select(
        F.parse_json("text").alias("data")
    )
    wanted = {"a": "bigint", "b.c": "string", "b.d": "variant", "e": "string"}
    for paths in (wanted, wanted | {"x.y.z": "string"}):
        got = rows.withColumn("o", opened(F.col("data"), paths)).select(
            *[
                F.try_variant_get("data", f"$.{p}", kind).cast("string").eqNullSafe(
                    F.col(f"o.{p}").cast("string")
                )
                & F.try_variant_get("data", f"$.{p}", kind).isNull().eqNullSafe(F.col(f"o.{p}").isNull())
                for p, kind in paths.items()
            ]
        )
        assert all(all(row) for row in got.collect())


def test_valid_and_invalid_records_share_their_files(spark, tmp_path):
    root = str(tmp_path)
    write_classified(s.listing(spark, [*s.COMMITS, {}]).coalesce(1), root, "r", "commits")
    assert len(list(tmp_path.rglob("*.parquet"))) == 1
    rows = read_classified(spark, root, "r", "commits").select("ok", "problems").collect()
    assert [r.ok for r in rows] == [True] * len(s.COMMITS) + [False]
    assert all(r.ok == (not r.problems) for r in rows)
