from datetime import datetime

import pytest
from pyspark.sql import functions as F

from devtide.operators import contracts as c
from devtide.sources import landing, staging

from . import samples as s

NOW = datetime(2024, 6, 15)

GOOD = {
    "repositories": s.repo(),
    "commits": s.COMMITS[0],
    "pull_requests": s.PULLS[0],
    "reviews": s.REVIEWS[0],
    "issues": s.ISSUES[0],
}


def problems(spark, entity, record):
    return c.classify(s.listing(spark, [record]), entity).first().problems


@pytest.mark.parametrize("entity", sorted(GOOD))
def test_good_records_pass(spark, entity):
    assert problems(spark, entity, GOOD[entity]) == []


BAD = [
    ("commits", "sha", "xyz"),
    ("commits", "sha", "A" * 40),
    ("commits", "sha", None),
    ("commits", "commit.author.date", "2024-06-1"),
    ("commits", "commit.committer.date", 5),
    ("commits", "parents", {"sha": "x"}),
    ("commits", "parents", None),
    ("pull_requests", "state", "merged"),
    ("pull_requests", "number", True),
    ("pull_requests", "merged_at", "yesterday"),
    ("pull_requests", "updated_at", None),
    ("issues", "created_at", "not-a-date"),
    ("issues", "id", 1.0),
    ("issues", "id", None),
    ("issues", "closed_at", ""),
    ("repositories", "id", "1001"),
    ("repositories", "owner.login", ""),
    ("repositories", "owner", "harbor"),
    ("repositories", "full_name", 3),
]


@pytest.mark.parametrize(("entity", "path", "value"), BAD)
def test_broken_field_is_named(spark, entity, path, value):
    found = problems(spark, entity, s.changed(GOOD[entity], path, value))
    prefix = "owner.login" if path == "owner" else path
    assert len(found) == 1 and found[0].startswith(f"{prefix}: expected ")


def test_missing_key_is_a_problem(spark):
    found = problems(spark, "issues", s.without(GOOD["issues"], "state"))
    assert found == ["state: expected open|closed, got null"]


def test_optional_values_may_be_absent_or_null(spark):
    pr = s.without(s.changed(GOOD["pull_requests"], "merged_at", None), "closed_at")
    assert problems(spark, "pull_requests", pr) == []


def test_review_needs_its_pull_number(spark):
    review = s.REVIEWS[0][0]
    for context in ({}, {"pull_number": "1"}, {"pull_number": True}):
        assert problems(spark, "reviews", (review, context)) == ["context.pull_number missing"]


def test_pending_review_is_valid(spark):
    pending = s.verdict(1, "joren", "PENDING", None)
    assert problems(spark, "reviews", pending) == []


def test_problems_come_in_rule_order(spark):
    pr = s.changed(s.changed(GOOD["pull_requests"], "state", "x"), "id", "1")
    assert [p.split(":")[0] for p in problems(spark, "pull_requests", pr)] == ["id", "state"]


INSTANTS = [
    ("2024-06-01", True),
    ("2024-06-01T10", True),
    ("2024-06-01T10:30Z", True),
    ("2024-06-01 10:30:05,25+0200", True),
    ("2024-06-01T10:30:05.123456789-05:30", True),
    ("2024-06", False),
    ("2024-6-1", False),
    (" 2024-06-01", False),
    ("2024-02-30T00:00:00Z", False),
    ("2024-06-01T25:00:00Z", False),
    ("10:30:00", False),
]


@pytest.mark.parametrize(("text", "ok"), INSTANTS)
def test_instants(spark, text, ok):
    found = problems(spark, "issues", s.changed(GOOD["issues"], "created_at", text))
    assert (found == []) is ok


def report(spark, records, entity="issues"):
    frame = c.classify(s.listing(spark, records), entity)
    return c.report_rows(c.contract_report({entity: frame}, spark))


def test_report_and_gate(spark):
    good = [s.ticket(i, "2024-06-01T00:00:00Z", "2024-06-01T00:00:00Z", "mira") for i in range(19)]
    rows = report(spark, [*good, s.changed(good[0], "id", None)])
    assert rows == [
        {"entity": "issues", "checked": 20, "invalid": 1, "invalid_ratio": 0.05, "reasons": {"id": 1}}
    ]
    c.gate(rows, 0.10)
    c.gate(rows, 0.05)
    with pytest.raises(c.ContractBreach, match="issues"):
        c.gate(rows, 0.01)


def test_ratio_is_rounded_half_even_and_empty_is_zero(spark):
    rows = spark.createDataFrame([(1, 32), (0, 0), (5004, 100000)], "bad bigint, n bigint")
    got = [r[0] for r in rows.select(c.invalid_ratio(F.col("bad"), F.col("n"))).collect()]
    assert got == [0.0312, 0.0, 0.05]


def test_empty_entity_is_reported(spark):
    frame = c.classify(s.listing(spark, [s.ISSUES[0]]).limit(0), "issues")
    assert c.report_rows(c.contract_report({"issues": frame}, spark)) == [
        {"entity": "issues", "checked": 0, "invalid": 0, "invalid_ratio": 0.0, "reasons": {}}
    ]


def test_malformed_and_blank_lines(spark, tmp_path):
    folder = tmp_path / "landing" / "run_id=r" / "entity=issues"
    folder.mkdir(parents=True)
    landing.write_landing(s.listing(spark, [s.ISSUES[0]]), str(tmp_path / "x"), "r", "issues", NOW)
    written = tmp_path / "x" / "landing" / "run_id=r" / "entity=issues"
    line = "".join(f.read_text() for f in written.glob("*.json"))
    assert line.count("\n") == 1
    (folder / "a.json").write_text(line + "\n   \n{broken\n")
    raw = landing.read_landing(spark, str(tmp_path), "r", "issues")
    staging.write_classified(raw, str(tmp_path), "r", "issues")
    rows = staging.read_classified(spark, str(tmp_path), "r", "issues")
    assert rows.filter("ok").count() == 1
    bad = staging.quarantine_rows(rows).collect()
    assert [(r.problems, r.line) for r in bad] == [([c.MALFORMED], "{broken")]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        landing.read_landing(spark, str(tmp_path), "r", "issues", fail_fast=True).collect()


def test_nothing_landed_is_empty(spark, tmp_path):
    assert landing.read_landing(spark, str(tmp_path), "r", "commits").count() == 0
