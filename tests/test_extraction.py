from datetime import datetime

from pyspark.sql import functions as F

from devtide.operators import extraction as x

from . import samples as s
from .test_raw_payloads import plan_of

NOW = datetime(2024, 6, 15)
MARKS = "repository_full_name string, entity string, watermark_at timestamp, updated_by_run string, updated_at timestamp"


def repos(spark):
    return spark.createDataFrame([(s.REPO,)], "repository string")


def marks(spark, **at):
    rows = [(s.REPO, e, t, "r0", NOW) for e, t in at.items()]
    return spark.createDataFrame(rows, MARKS)


def run(spark, listings, stored, cut=()):
    window = x.windows(repos(spark), stored, NOW)
    truncated = spark.createDataFrame(
        [(s.REPO, e, True) for e in cut], "repository string, entity string, truncated boolean"
    )
    increment = x.extract_increment(listings, repos(spark), window)
    results = x.extraction_results(
        x.extraction_plan(repos(spark), window, truncated), x.raw_changes(increment)
    )
    return increment, {r.entity: r for r in results.collect()}, results


def test_first_run_looks_back(spark):
    got = {r.entity: r.since for r in x.windows(repos(spark), marks(spark), NOW).collect()}
    assert got == dict.fromkeys(("commits", "pull_requests", "issues"), datetime(2024, 5, 16))


def test_window_overlaps_the_mark(spark):
    stored = marks(spark, commits=datetime(2024, 6, 12, 8))
    got = {r.entity: r.since for r in x.windows(repos(spark), stored, NOW).collect()}
    assert got["commits"] == datetime(2024, 6, 12, 7)


def test_mark_stays_without_news(spark):
    stored = marks(spark, commits=datetime(2024, 6, 12, 8))
    _, results, _ = run(spark, s.listings(spark, commits=[s.COMMITS[0]]), stored)
    assert results["commits"].records == 0
    assert results["commits"].new_watermark == datetime(2024, 6, 12, 8)


def test_pull_requests_in_window_and_their_reviews(spark):
    old = s.pull(3, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "mira")
    late = s.verdict(1, "joren", "APPROVED", "2024-06-01T00:00:00Z", 3)
    listing = s.listings(spark, pulls=[*s.PULLS, old], reviews=[*s.REVIEWS, late])
    increment, results, _ = run(spark, listing, marks(spark))
    assert increment["pull_requests"].count() == 2
    assert increment["reviews"].count() == 2
    assert results["pull_requests"].new_watermark == datetime(2024, 6, 5, 9)


def test_unreadable_time_is_kept_and_does_not_move_the_mark(spark):
    odd = s.changed(s.PULLS[0], "updated_at", "soon")
    increment, results, _ = run(spark, s.listings(spark, pulls=[odd]), marks(spark))
    assert increment["pull_requests"].count() == 1
    assert results["pull_requests"].new_watermark is None


def test_truncated_listing_keeps_the_mark(spark):
    stored = marks(spark, commits=datetime(2024, 6, 1))
    _, results, _ = run(spark, s.listings(spark), stored, cut=["commits", "issues"])
    assert results["commits"].truncated and results["commits"].new_watermark == datetime(2024, 6, 1)
    assert results["issues"].new_watermark is None


def test_pull_requests_are_not_issues(spark):
    disguised = {**s.ISSUES[1], "updated_at": "2024-06-09T00:00:00Z", "pull_request": None}
    plain = s.ticket(12, "2024-06-01T00:00:00Z", "2024-06-02T00:00:00Z", "mira")
    increment, results, _ = run(spark, s.listings(spark, issues=[disguised, plain]), marks(spark))
    assert increment["issues"].count() == 1
    assert results["issues"].new_watermark == datetime(2024, 6, 2)


def test_empty_repository_keeps_its_row(spark):
    listing = s.listings(spark)
    listing["commits"] = listing["commits"].limit(0)
    _, results, frame = run(spark, listing, marks(spark))
    assert results["commits"].records == 0 and results["commits"].new_watermark is None
    counts = {r.entity: r.records for r in x.record_counts(frame).collect()}
    assert counts == {"repositories": 1, "commits": 0, "pull_requests": 2, "reviews": 2, "issues": 2}


def test_forks_are_left_out_unless_wanted(spark):
    listing = s.listing(
        spark, [s.repo(), s.repo("harbor/fork", 2, fork=True), s.without(s.repo("harbor/old", 3), "fork")]
    )
    names = lambda df: sorted(r.repository for r in df.collect())
    assert names(x.discover(listing)) == sorted(["harbor/old", s.REPO])
    assert len(names(x.discover(listing, include_forks=True))) == 3


def test_marks_never_move_back(spark):
    stored = marks(spark, commits=datetime(2024, 6, 12), issues=datetime(2024, 6, 1))
    results = spark.createDataFrame(
        [(s.REPO, "commits", datetime(2024, 6, 1)), (s.REPO, "pull_requests", datetime(2024, 6, 2)),
         (s.REPO, "issues", None)],
        "repository string, entity string, new_watermark timestamp",
    )
    merged = x.merge_watermarks(stored, results, "r1", F.lit(NOW))
    got = {r.entity: (r.watermark_at, r.updated_by_run) for r in merged.collect()}
    assert got == {
        "commits": (datetime(2024, 6, 12), "r1"),
        "pull_requests": (datetime(2024, 6, 2), "r1"),
        "issues": (datetime(2024, 6, 1), "r0"),
    }


def test_a_window_parses_each_instant_once(spark):
    listing = s.listings(spark)["pull_requests"]
    window = x.windows(repos(spark), marks(spark), NOW)
    assert plan_of(x.in_window(listing, "pull_requests", window)).count("RLIKE") == 1


def test_a_review_without_a_number_is_of_no_pull_request(spark):
    nameless = s.changed(s.PULLS[0], "number", None)
    loose = (s.REVIEWS[0][0], {})
    reviews, pulls = s.listing(spark, [*s.REVIEWS, loose]), s.listing(spark, [nameless, s.PULLS[1]])
    found = x.reviews_of(reviews, pulls)
    assert found.columns == reviews.columns and found.count() == 2
    # The number is read for the join only, not a second time to leave out reviews without one.
    assert plan_of(found).count("$.pull_number") == 1
