"""Query semantics the small golden fixture does not reach, and skewed groups."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from devtide.functions.instants import date_key, week_start
from devtide.operators.dedupe import keep_first, keep_last
from devtide.operators.percentiles import exact_percentiles, value_counts
from devtide.plans.analytics import QUERIES, preview
from devtide.sources.calendar import calendar_days

AS_OF = date(2024, 12, 31)
REPOS = "repository_key bigint, full_name string, language string, stargazers_count bigint"


def pulls(spark, rows):
    """(key, repository, author, created, merged or None) as a pull request fact."""
    full = [
        (k, r, a, c, m, m is not None,
         None if m is None else Decimal(round((m - c).total_seconds() / 36) / 100).quantize(Decimal("0.01")))
        for k, r, a, c, m in rows
    ]
    return spark.createDataFrame(
        full,
        "pull_request_key bigint, repository_key bigint, author_key bigint, created_at timestamp, "
        "merged_at timestamp, is_merged boolean, cycle_time_hours decimal(12,2)",
    )


def repos(spark, n):
    return spark.createDataFrame([(i, f"r{i}", "Go", 1) for i in range(n)], REPOS)


def run(name, **tables):
    return [tuple(r) for r in QUERIES[name](tables, AS_OF).collect()]


def test_moving_average_is_over_unrounded_listed_weeks(spark):
    start = datetime(2024, 1, 1)
    hours = [12.25, 3.35, 6.0, 1.0, 2.0]
    rows = [
        (i, 0, 0, start + timedelta(weeks=3 * i), start + timedelta(weeks=3 * i, hours=h))
        for i, h in enumerate(hours)
    ]
    got = run("avg_time_to_merge_trend", fact_pull_request=pulls(spark, rows))
    assert [r[2] for r in got] == [12.3, 3.4, 6.0, 1.0, 2.0]
    means = [sum(hours[max(0, i - 3): i + 1]) / len(hours[max(0, i - 3): i + 1]) for i in range(5)]
    assert [r[3] for r in got] == [12.3, 7.8, 7.2, 5.7, 3.1] == [
        float(Decimal(str(round(m, 9))).quantize(Decimal("0.1"), "ROUND_HALF_UP")) for m in means
    ]


def commits(spark, rows):
    return spark.createDataFrame(
        [(r, a, t, False) for r, a, t in rows],
        "repository_key bigint, author_key bigint, committed_at timestamp, is_merge_commit boolean",
    )


def no_reviews(spark):
    return spark.createDataFrame(
        [],
        "pull_request_key bigint, repository_key bigint, reviewer_key bigint, review_state string, "
        "submitted_at timestamp",
    )


def test_ranks_are_dense_and_match_the_literal_form(spark):
    scores = {f"p{i:02}": 40 - i // 3 for i in range(60)} | {"bot": 99, "idle": 0}
    people = spark.createDataFrame(
        [(i, None if n == "p05" else n, n, n == "bot") for i, n in enumerate(scores)],
        "contributor_key bigint, login string, display_name string, is_bot boolean",
    )
    when = datetime(2024, 1, 1)
    made = [(0, i, when) for i, n in enumerate(scores) for _ in range(scores[n])]
    facts = {
        "fact_commit": commits(spark, [*made, (0, None, when)]),
        "fact_pull_request": pulls(spark, []),
        "fact_review": no_reviews(spark),
        "dim_contributor": people,
    }
    got = run("contributor_activity", **facts)
    literal = spark.createDataFrame(
        [(n, c) for n, c in scores.items() if n != "bot" and c > 0], "n string, c bigint"
    )
    rank = F.dense_rank().over(Window.orderBy(F.desc("c")))
    expected = literal.select(rank.alias("r"), "n", "c").orderBy("r", "n").limit(25).collect()
    assert [(r[0], r[1], r[2]) for r in got] == [tuple(r) for r in expected]


def test_null_authors_are_not_counted_as_people(spark):
    rows = [(0, 1, datetime(2024, 1, 1)), (0, None, datetime(2024, 1, 2))]
    assert run("weekly_commit_volume", fact_commit=commits(spark, rows)) == [
        (date(2024, 1, 1), 2, 1, 0, None)
    ]


def test_repository_without_activity_is_listed(spark):
    issues = spark.createDataFrame([], "repository_key bigint")
    got = run(
        "repository_activity",
        dim_repository=repos(spark, 1),
        fact_commit=commits(spark, []),
        fact_pull_request=pulls(spark, []),
        fact_issue=issues,
    )
    assert got == [("r0", "Go", 1, 0, 0, 0, 0, None)]


def test_trend_starts_with_the_first_pull_request(spark):
    def trend(prs, as_of=AS_OF):
        reviews, issues = no_reviews(spark), spark.createDataFrame([], "created_at timestamp")
        made = [(0, 1, datetime(2024, 1, d)) for d in (2, 9, 16, 23)]
        tables = {
            "fact_commit": commits(spark, made),
            "fact_pull_request": pulls(spark, prs),
            "fact_review": reviews,
            "fact_issue": issues,
        }
        return [tuple(r) for r in QUERIES["engineering_activity_trends"](tables, as_of).collect()]

    assert trend([]) == []
    first = [(1, 0, 0, datetime(2024, 1, 12), None)]
    assert trend(first, date(2024, 1, 17)) == [
        (date(2024, 1, 8), 1, 1, 0, 0, 1), (date(2024, 1, 15), 1, 0, 0, 0, 2),
    ]


def test_reopened_issue_counts_as_opened_only(spark):
    issues = spark.createDataFrame(
        [(datetime(2024, 1, 1), None), (datetime(2024, 1, 2), datetime(2024, 1, 9))],
        "created_at timestamp, closed_at timestamp",
    )
    assert run("issues_open_vs_closed", fact_issue=issues) == [
        (date(2024, 1, 1), 2, 0, 2), (date(2024, 1, 8), 0, 1, 1),
    ]


def test_not_planned_counts_in_any_state(spark):
    issues = spark.createDataFrame(
        [(0, "open", "not_planned", None), (0, "open", None, Decimal("5.00"))],
        "repository_key bigint, state string, state_reason string, time_to_close_hours decimal(12,2)",
    )
    got = run("issue_resolution_by_repository", fact_issue=issues, dim_repository=repos(spark, 1))
    assert got == [("r0", 2, 0, None, 1)]


def test_week_arithmetic_equals_the_calendar_join(spark):
    days = calendar_days(spark, date(2008, 1, 1), date(2035, 12, 31))
    ts = F.col("full_date").cast("timestamp") + F.expr("interval 23 hours 59 minutes")
    rows = days.select("week_start_date", "date_key", week_start(ts).alias("w"), date_key(ts).alias("k"))
    assert rows.filter("week_start_date <> w OR date_key <> k").count() == 0


def test_preview_keeps_the_report_order(spark):
    df = spark.range(100).select(F.col("id")).orderBy(F.desc("id"))
    assert [r.id for r in preview(df).collect()] == list(range(99, 84, -1))


# ---------------------------------------------------------------------- percentiles
@pytest.mark.parametrize("shifts", [(12,), (34, 17), (3,), (6, 3)])
def test_percentiles_equal_the_definition(spark, shifts):
    rng = random.Random(7)
    groups = {
        "one": [5],
        "two": [-3, 10],
        "same": [42] * 50,
        "small": [rng.randint(-50, 50) for _ in range(101)],
        "wide": [rng.randint(-(10**14), 10**14) for _ in range(300)],
        "hot": [rng.choice([1, 2, 2, 2, 9000]) for _ in range(4000)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("small", None), (None, 1)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    wanted = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = exact_percentiles(value_counts(df, ["g"], "v", shifts), ["g"], "v", wanted).collect()
    assert {r.g for r in got} == set(groups)
    for row in got:
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.percentile(groups[row.g], 100 * p), rel=1e-12)
    builtin = df.filter("g IS NOT NULL").groupBy("g").agg(F.percentile("v", F.lit(0.9)).alias("p"))
    for row in builtin.collect():
        mine = next(r for r in got if r.g == row.g)
        assert mine.p90 == pytest.approx(row.p, rel=1e-12)


# ----------------------------------------------------------------------------- skew
def test_a_third_of_all_rows_in_one_repository(spark):
    rng = random.Random(3)
    rows, start = [], datetime(2024, 1, 1)
    for key in range(6000):
        repo = 0 if key % 3 == 0 else rng.randrange(1, 200)
        merged = start + timedelta(minutes=rng.randrange(1, 50_000))
        rows.append((key, repo, 0, start, merged))
    got = run(
        "pr_cycle_time_by_repository",
        fact_pull_request=pulls(spark, rows),
        dim_repository=repos(spark, 200),
    )
    assert got[0][:2] == ("r0", 2000) and sum(r[1] for r in got) == 6000
    hours = [round((m - c).total_seconds() / 36) / 100 for _, r, _, c, m in rows if r == 0]
    assert got[0][3] == pytest.approx(np.percentile(hours, 50), abs=0.051)
    assert got[0][4] == pytest.approx(np.percentile(hours, 90), abs=0.051)


def test_dedupe_reduces_copies_before_the_shuffle(spark):
    copies = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"),
        F.concat(F.lit("v"), F.col("id")).alias("v"),
    )
    last = keep_last(copies, ["k"], [F.col("seq")])
    first = keep_first(copies, ["k"], [F.col("seq")])
    assert last.count() == 20_001
    assert last.filter("k = 0").first().v == "v9999"
    assert first.filter("k = 0").first().v == "v0"
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_ties_resolve_the_same_way_in_any_order(spark):
    rows = [(1, 5, x) for x in "cab"]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, seq int, v string")
        assert keep_last(df, ["k"], [F.col("seq")]).first().v == "c"
        assert keep_first(df, ["k"], [F.col("seq")]).first().v == "a"
