"""Table layouts of the landing zone, the staging area and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ENTITIES = ("repositories", "commits", "pull_requests", "reviews", "issues")
WATERMARKED = ("commits", "pull_requests", "issues")

Layout = dict[str, str]


def _columns(ddl: str) -> Layout:
    """Column name to type, in order."""
    return dict(part.split(" ", 1) for part in ddl.split(", "))


ENVELOPE = (
    "repository string, extracted_at timestamp, context variant, data variant, "
    "ingest_seq bigint, _corrupt_record string"
)

STAGED = {
    name: _columns(ddl)
    for name, ddl in {
        "repositories": (
            "github_repo_id bigint, full_name string, owner_login string, name string, "
            "description string, language string, is_private boolean, is_fork boolean, "
            "is_archived boolean, default_branch string, created_at timestamp, "
            "pushed_at timestamp, stargazers_count bigint, forks_count bigint, "
            "open_issues_count bigint, html_url string"
        ),
        "contributors": (
            "contributor_nk string, github_user_id bigint, login string, "
            "display_name string, user_type string, is_bot boolean"
        ),
        "commits": (
            "repository_full_name string, commit_sha string, author_nk string, "
            "committer_nk string, authored_at timestamp, committed_at timestamp, "
            "message_headline string, parent_count int, html_url string"
        ),
        "pull_requests": (
            "github_pr_id bigint, repository_full_name string, pr_number bigint, "
            "author_nk string, title string, state string, is_draft boolean, "
            "created_at timestamp, updated_at timestamp, closed_at timestamp, "
            "merged_at timestamp, base_ref string, html_url string"
        ),
        "reviews": (
            "github_review_id bigint, repository_full_name string, pr_number bigint, "
            "reviewer_nk string, review_state string, submitted_at timestamp"
        ),
        "issues": (
            "github_issue_id bigint, repository_full_name string, issue_number bigint, "
            "author_nk string, title string, state string, state_reason string, "
            "created_at timestamp, updated_at timestamp, closed_at timestamp, "
            "comments_count bigint, labels array<string>"
        ),
    }.items()
}

WAREHOUSE = {
    name: _columns(ddl)
    for name, ddl in {
        "dim_date": (
            "date_key int, full_date date, year int, quarter int, month int, "
            "month_name string, iso_year int, iso_week int, week_start_date date, "
            "day_of_week int, day_name string, is_weekend boolean"
        ),
        "dim_repository": (
            "repository_key bigint, github_repo_id bigint, full_name string, "
            "owner_login string, name string, description string, language string, "
            "is_private boolean, is_fork boolean, is_archived boolean, "
            "default_branch string, created_at timestamp, pushed_at timestamp, "
            "stargazers_count bigint, forks_count bigint, open_issues_count bigint, "
            "html_url string, first_loaded_at timestamp, last_updated_at timestamp"
        ),
        "dim_contributor": (
            "contributor_key bigint, contributor_nk string, github_user_id bigint, "
            "login string, display_name string, user_type string, is_bot boolean, "
            "first_loaded_at timestamp, last_updated_at timestamp"
        ),
        "fact_commit": (
            "repository_key bigint, commit_sha string, author_key bigint, "
            "committer_key bigint, authored_date_key int, committed_date_key int, "
            "authored_at timestamp, committed_at timestamp, message_headline string, "
            "parent_count int, is_merge_commit boolean, html_url string, "
            "loaded_at timestamp, event_month date"
        ),
        "fact_pull_request": (
            "pull_request_key bigint, repository_key bigint, author_key bigint, "
            "pr_number bigint, title string, state string, is_draft boolean, "
            "is_merged boolean, created_at timestamp, updated_at timestamp, "
            "closed_at timestamp, merged_at timestamp, created_date_key int, "
            "closed_date_key int, merged_date_key int, cycle_time_hours decimal(12,2), "
            "base_ref string, html_url string, loaded_at timestamp, event_month date"
        ),
        "fact_review": (
            "review_key bigint, pull_request_key bigint, repository_key bigint, "
            "reviewer_key bigint, review_state string, submitted_at timestamp, "
            "submitted_date_key int, loaded_at timestamp, event_month date"
        ),
        "fact_issue": (
            "issue_key bigint, repository_key bigint, author_key bigint, "
            "issue_number bigint, title string, state string, state_reason string, "
            "created_at timestamp, updated_at timestamp, closed_at timestamp, "
            "created_date_key int, closed_date_key int, comments_count bigint, "
            "labels array<string>, time_to_close_hours decimal(12,2), "
            "loaded_at timestamp, event_month date"
        ),
        "extraction_watermarks": (
            "repository_full_name string, entity string, watermark_at timestamp, "
            "updated_by_run string, updated_at timestamp"
        ),
        "pipeline_runs": (
            "run_id string, status string, started_at timestamp, finished_at timestamp, "
            "repositories array<string>, extracted string, loaded string, "
            "quality_checks string, error_message string"
        ),
    }.items()
}

# Fact tables are laid out by the month of an instant that never changes for a key.
PARTITION_COLUMN = {
    "fact_commit": "event_month",
    "fact_pull_request": "event_month",
    "fact_review": "event_month",
    "fact_issue": "event_month",
}

# Keys that lead to the month, and the merge key, of a fact's row.
INDEXES = {
    "fact_commit": {"key": ("repository_key", "commit_sha")},
    "fact_pull_request": {"key": ("pull_request_key",), "number": ("repository_key", "pr_number")},
    "fact_review": {"key": ("review_key",)},
    "fact_issue": {"key": ("issue_key",), "number": ("repository_key", "issue_number")},
}

# Dimensions that are kept in hash buckets of their natural key.
BUCKETED = {"dim_contributor": ("contributor_nk",)}

# What an extraction asked for, per repository and entity.
EXTRACTION_PLAN = _columns(
    "entity string, repository string, previous timestamp, since timestamp, truncated boolean"
)

# What it brought, and the mark that follows from it.
EXTRACTION_RESULTS = _columns(
    "run_id string, entity string, repository string, records bigint, "
    "since timestamp, new_watermark timestamp, truncated boolean"
)


def index_layout(table: str, name: str) -> Layout:
    keys = [*INDEXES[table][name], *INDEXES[table]["key"], PARTITION_COLUMN[table]]
    return {column: WAREHOUSE[table][column] for column in keys}


def ddl(layout: Layout) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in layout.items())


def conform(df: DataFrame, layout: Layout) -> DataFrame:
    """Select exactly the columns of ``layout``, in order and with its types."""
    return df.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in layout.items()])


def empty(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.createDataFrame([], ddl(layout))
