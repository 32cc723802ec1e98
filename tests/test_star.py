"""Merges, constraints, run log and quality checks."""

from datetime import date, datetime
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devtide.operators import constraints, flatten, quality, runlog, star
from devtide.operators.merge import merge_upsert, take_new
from devtide.schemas import ENTITIES, STAGED, WAREHOUSE, empty
from devtide.sources.calendar import calendar_days

from . import samples as s

FIRST, SECOND = datetime(2024, 7, 1), datetime(2024, 7, 2)


def staged(spark, **listings):
    data = s.listings(spark, **listings)
    return flatten.stage_all({e: flatten.flat_rows(data[e], e) for e in ENTITIES})


def build(spark, tables, now=FIRST, base=None):
    """A star in memory from staging tables, on top of ``base``."""
    base = base or {t: empty(spark, layout) for t, layout in WAREHOUSE.items()}
    repos = star.merge_repositories(base["dim_repository"], tables["repositories"], now)
    out = {
        "dim_repository": repos,
        "dim_contributor": star.merge_contributors(
            base["dim_contributor"], tables["contributors"], now
        ),
    }
    rows = {
        "fact_commit": star.commit_fact_rows(tables["commits"], repos, now),
        "fact_pull_request": star.pull_request_fact_rows(tables["pull_requests"], repos, now),
        "fact_issue": star.issue_fact_rows(tables["issues"], repos, now),
    }
    for table, new in rows.items():
        out[table] = star.merge_fact(table, base[table], new)
    reviews = star.review_fact_rows(tables["reviews"], repos, out["fact_pull_request"], now)
    out["fact_review"] = star.merge_fact("fact_review", base["fact_review"], reviews)
    return out


def content(df, drop=("loaded_at", "last_updated_at", "first_loaded_at")):
    return sorted(map(str, df.drop(*drop).collect()))


def test_merge_is_idempotent(spark):
    tables = staged(spark)
    once = build(spark, tables)
    twice = build(spark, tables, SECOND, once)
    for name, df in once.items():
        assert content(df) == content(twice[name]), name


def test_snapshots_merge_in_any_order(spark):
    older, newer = staged(spark), staged(
        spark,
        pulls=[s.pull(2, "2024-06-03T09:00:00Z", "2024-06-06T09:00:00Z", "joren",
                      merged="2024-06-06T09:00:00Z", title="new")],
        issues=[s.ticket(10, "2024-06-01T00:00:00Z", "2024-06-05T00:00:00Z", "mira")],
    )
    forward = build(spark, newer, SECOND, build(spark, older))
    backward = build(spark, older, SECOND, build(spark, newer))
    for name in ("fact_pull_request", "fact_issue"):
        assert content(forward[name]) == content(backward[name])
    pr = forward["fact_pull_request"].filter("pr_number = 2").first()
    assert (pr.title, pr.is_merged, pr.cycle_time_hours) == ("new", True, Decimal("72.00"))
    assert forward["fact_issue"].filter("issue_number = 10").first().closed_at is None


def test_columns_that_never_change(spark):
    base = build(spark, staged(spark))
    changed = [
        s.pull(2, "2024-06-04T09:00:00Z", "2024-06-07T09:00:00Z", "mira", base={"ref": "x"})
    ]
    pr = build(spark, staged(spark, pulls=changed), SECOND, base)["fact_pull_request"]
    old = base["fact_pull_request"].filter("pr_number = 2").first()
    new = pr.filter("pr_number = 2").first()
    for column in ("author_key", "base_ref", "html_url", "created_at", "created_date_key"):
        assert new[column] == old[column]
    assert new.updated_at == datetime(2024, 6, 7, 9)


def test_repository_guard_looks_at_tracked_columns_only(spark):
    base = build(spark, staged(spark))["dim_repository"]
    untracked = staged(spark, repos=[s.repo(default_branch="x", private=True)])["repositories"]
    same = star.merge_repositories(base, untracked, SECOND).first()
    assert (same.default_branch, same.is_private, same.last_updated_at) == ("trunk", False, FIRST)
    tracked = staged(
        spark, repos=[s.repo(default_branch="x", stargazers_count=43, created_at="2021-01-01")]
    )["repositories"]
    new = star.merge_repositories(base, tracked, SECOND).first()
    assert (new.default_branch, new.stargazers_count, new.last_updated_at) == ("x", 43, SECOND)
    assert new.created_at == same.created_at == datetime(2019, 3, 14, 8) and new.first_loaded_at == FIRST


def people(spark, *rows):
    schema = ", ".join(f"{c} {t}" for c, t in STAGED["contributors"].items())
    return spark.createDataFrame(rows, schema)


def test_contributor_keeps_its_id(spark):
    first = people(spark, ("gh:al", 7, "al", "al", "User", False))
    base = star.merge_contributors(empty(spark, WAREHOUSE["dim_contributor"]), first, FIRST)
    same = star.merge_contributors(base, people(spark, ("gh:al", None, "AL", "al", "User", False)), SECOND)
    assert (same.first().github_user_id, same.first().login) == (7, "al")
    assert same.first().last_updated_at == FIRST
    bot = star.merge_contributors(base, people(spark, ("gh:al", None, None, "Al", "Bot", True)), SECOND)
    row = bot.first()
    assert (row.github_user_id, row.login, row.display_name, row.is_bot) == (7, "al", "Al", True)
    nameless = star.merge_contributors(base, people(spark, (None, 1, "x", "x", "User", False)), SECOND)
    assert nameless.count() == 1


def test_unknown_repository_and_pull_request(spark):
    tables = staged(spark, repos=[s.repo("harbor/renamed")])
    out = build(spark, tables)
    assert out["fact_commit"].count() == 0 and out["fact_review"].count() == 0
    stray = s.verdict(9003, "joren", "APPROVED", "2024-06-02T20:00:00Z", 99)
    out = build(spark, staged(spark, reviews=[*s.REVIEWS, stray]))
    assert out["fact_review"].count() == 2


def test_review_of_an_earlier_pull_request_and_dismissal(spark):
    base = build(spark, staged(spark))
    later = [
        s.verdict(9002, "joren", "DISMISSED", "2024-06-09T20:00:00Z", 1),
        s.verdict(9004, "mira", "APPROVED", "2024-06-09T20:00:00Z", 2),
    ]
    out = build(spark, staged(spark, pulls=[s.PULLS[1]], reviews=later), SECOND, base)["fact_review"]
    rows = {r.review_key: r for r in out.collect()}
    assert set(rows) == {9001, 9002, 9004}
    assert rows[9002].review_state == "DISMISSED"
    assert rows[9002].submitted_at == datetime(2024, 6, 2, 20)


def test_generic_merge(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, n int")
    source = spark.createDataFrame([(2, "B", 1), (3, "C", 3), (1, None, 9)], "k int, v string, n int")
    merged = merge_upsert(target, source, ["k"], take_new("v"), lambda old, new: new.n >= old.n)
    assert sorted(map(tuple, merged.collect())) == [(1, None, 1), (2, "b", 2), (3, "C", 3)]


def test_durations_round_half_up(spark):
    times = [("2024-06-01 00:00:00", "2024-06-01 00:00:18", "0.01"),
             ("2024-06-01 00:00:00", "2024-06-01 00:00:17.999999", "0.00"),
             ("2024-06-01 01:00:00", "2024-06-01 00:00:00", "-1.00")]
    from devtide.functions.instants import hours_between

    df = spark.createDataFrame(times, "a string, b string, h string")
    rows = df.select(hours_between(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")), "h")
    assert all(str(r[0]) == r[1] for r in rows.collect())


def test_calendar(spark):
    days = calendar_days(spark)
    assert days.count() == 10_227
    row = days.filter("full_date = '2024-12-30'").first()
    assert tuple(row) == (
        20241230, date(2024, 12, 30), 2024, 4, 12, "December", 2025, 1, date(2024, 12, 30), 1,
        "Monday", False,
    )
    half = calendar_days(spark, date(2024, 1, 1), date(2024, 1, 31))
    assert star.merge_dates(half, calendar_days(spark, date(2024, 1, 15), date(2024, 2, 3))).count() == 34


# --------------------------------------------------------------------- constraints
CALENDAR = (date(2024, 1, 1), date(2024, 12, 31))


def broken(tables, calendar=CALENDAR):
    found = constraints.constraint_violations(tables, calendar).filter("violations > 0")
    return {(r["table"], r["rule"]): r["violations"] for r in found.collect()}


def test_a_good_star_has_no_violations(spark):
    assert broken(build(spark, staged(spark))) == {}


def test_violations_are_found(spark):
    tables = build(spark, staged(spark))
    pr = tables["fact_pull_request"]
    tables["fact_pull_request"] = pr.withColumns(
        {"state": F.lit("merged"), "pr_number": F.lit(1).cast("bigint"),
         "author_key": F.lit(5).cast("bigint"), "updated_at": F.lit(None).cast("timestamp")}
    )
    found = broken(tables, (date(2024, 6, 2), date(2024, 12, 31)))
    assert found[("fact_pull_request", "state is open or closed")] == 2
    assert found[("fact_pull_request", "updated_at is required")] == 2
    assert found[("fact_pull_request", "(repository_key, pr_number) is unique")] == 1
    assert found[("fact_pull_request", "author_key is in dim_contributor")] == 1
    assert found[("fact_pull_request", "created_date_key is in the calendar")] == 1
    with pytest.raises(constraints.ConstraintViolation, match="state is open or closed"):
        constraints.enforce(constraints.constraint_violations(tables, CALENDAR))


# ------------------------------------------------------------------------- run log
def test_run_log(spark):
    """A run's line is reduced from its statuses, whatever their order in the files."""
    written = []

    def write(status, now, **fields):
        entry = runlog.run_entry(spark, "r", status, now, **fields)
        written.append(entry.withColumn("logged_at", F.lit(len(written))))
        return runlog.reduce_runs(reduce(DataFrame.unionByName, reversed(written))).first()

    write("running", FIRST, repositories=["a/b"], extracted={"commits": 1})
    row = write("failed", SECOND, error_message="boom")
    assert (row.status, row.finished_at, row.error_message) == ("failed", SECOND, "boom")
    row = write("running", SECOND, loaded={"x": 1})
    assert (row.started_at, row.finished_at, row.error_message) == (FIRST, None, None)
    assert (row.repositories, row.extracted, row.loaded) == (["a/b"], '{"commits": 1}', '{"x": 1}')
    with pytest.raises(ValueError, match="unknown run status"):
        runlog.run_entry(spark, "r", "done", FIRST)


# ------------------------------------------------------------------------- quality
def test_quality_checks(spark):
    tables = staged(spark)
    good = build(spark, tables)
    context = quality.QualityContext(good, tables, FIRST)
    results = quality.run_quality_checks(context)
    assert [r["name"] for r in results] == [c.name for c in quality.CHECKS]
    assert all(r["passed"] for r in results)

    odd = dict(good)
    odd["fact_pull_request"] = good["fact_pull_request"].filter("pr_number = 1").withColumns(
        {"state": F.lit("open"), "merged_at": F.col("created_at") - F.expr("interval 1 hour")}
    )
    odd["fact_issue"] = good["fact_issue"].withColumns(
        {"state": F.lit("closed"),
         "closed_at": F.when(F.col("issue_number") == 10, F.lit(datetime(2024, 1, 1)))}
    )
    odd["fact_commit"] = good["fact_commit"].filter("NOT is_merge_commit").withColumn(
        "author_key", F.lit(None).cast("bigint")
    )
    context = quality.QualityContext(odd, tables, datetime(2024, 6, 1))
    counts = {r.name: r.violations for r in quality.violation_counts(context).collect()}
    assert counts == {
        "staged_prs_not_loaded": 1,
        "staged_commits_not_loaded": 1,
        "staged_issues_not_loaded": 0,
        "pr_merged_before_created": 1,
        "pr_merged_but_open": 1,
        "issue_closed_before_created": 1,
        "closed_issue_without_close_time": 1,
        "reviews_without_pull_request": 0,
        "commits_without_author": 2,
        "future_dated_activity": 2,
    }
    with pytest.raises(quality.QualityCheckFailed, match="pr_merged_but_open"):
        quality.run_quality_checks(context)


def test_warnings_do_not_stop(spark):
    tables = staged(spark)
    late = quality.QualityContext(build(spark, tables), tables, datetime(2024, 5, 1))
    results = {r["name"]: r for r in quality.run_quality_checks(late)}
    assert results["future_dated_activity"]["violations"] == 5
    assert not results["future_dated_activity"]["passed"]
