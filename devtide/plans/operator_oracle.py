"""SQL over the given tables for the operator queries."""

from __future__ import annotations

from .oracle import ANALYTICS, CTES, round1, sql

LOGIN = "'Customer#' || lpad({0}::VARCHAR, 9, '0')"


def _login(number: str) -> str:
    return LOGIN.format(number)


CTES |= {
    "n": (
        (),
        """SELECT n_nationkey, n_name, r_name, n_regionkey
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    # Raw commits: events, and the views among them a second time.
    "rc": (
        ("n",),
        f"""SELECT n_name AS repository, *,
        CASE WHEN event_type <> 'error' THEN 'gh:' || lower({_login("user_id")})
          WHEN value >= 10 THEN 'git:' || substr(sha256('user' || user_id || '@example.org'), 1, 16)
          WHEN value >= 1 THEN 'git:' || substr(sha256('name:Dev ' || user_id), 1, 16) END AS nk,
        CASE WHEN event_type <> 'error' THEN CASE WHEN user_id % 10 = 0 THEN 'Bot' ELSE 'User' END
          WHEN value >= 1 THEN 'Unlinked' END AS kind,
        CASE WHEN copied THEN 'again' WHEN k = 0 THEN '' WHEN k = 1 THEN chr(10) || event_type
          ELSE event_type || chr(13) || chr(10) || props END AS message,
        CASE WHEN copied THEN 'again' WHEN k = 0 THEN NULL WHEN k = 1 THEN ''
          ELSE event_type END AS headline,
        CASE WHEN k = 13 THEN substr(full_sha, 2) ELSE full_sha END AS sha,
        CASE WHEN k <> 17 THEN ts END AS committed_at,
        CASE WHEN k = 13 THEN 'sha: expected 40-char hex SHA, got "' || substr(full_sha, 2) || '"'
          WHEN k = 17 THEN 'commit.committer.date: expected ISO timestamp, got "not-a-date"'
          WHEN k = 42 THEN 'parents: expected list, got {{"count":2}}' END AS problem
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
            lpad(lower(to_hex(event_id)), 40, '0') AS full_sha
          FROM (SELECT *, event_id AS seq, false AS copied FROM events
            UNION ALL SELECT *, event_id + 1000000000000000, true FROM events
            WHERE event_type = 'view') a) b
        JOIN n ON n_nationkey = user_id % 25""",
    ),
    # Raw pull requests: every order as opened and as it ended.
    "rp": (
        ("shipped", "n"),
        """SELECT *,
        CASE WHEN o_totalprice > 495000
            THEN 'id: expected integer, got "' || o_orderkey || '"' END AS bad_id,
        CASE WHEN state = 'merged'
            THEN 'state: expected open|closed, got "merged"' END AS bad_state,
        CASE WHEN updated_at IS NULL
            THEN 'updated_at: expected ISO timestamp, got "not-a-date"' END AS bad_time
        FROM (SELECT n_name AS repository, s.*, final, o_orderkey * 2 + final::INTEGER AS seq,
          CASE WHEN final AND o_orderstatus <> 'O' THEN shipped_at END AS closed_at,
          CASE WHEN final AND o_orderstatus = 'F' THEN shipped_at END AS merged_at,
          CASE WHEN NOT final OR o_orderstatus = 'O' THEN 'open'
            WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'merged'
            ELSE 'closed' END AS state,
          CASE WHEN final AND o_totalprice < 5000 THEN NULL
            ELSE coalesce(CASE WHEN final AND o_orderstatus <> 'O' THEN shipped_at END, o_orderdate)
            END AS updated_at
          FROM shipped s JOIN n ON n_nationkey = nation, (VALUES (false), (true)) f(final)) x""",
    ),
    "sp": (
        ("rp",),
        f"""SELECT o_orderkey AS github_pr_id, repository AS repository_full_name,
        o_orderkey AS pr_number,
        CASE WHEN o_totalprice NOT BETWEEN 5000 AND 10000
          THEN 'gh:' || lower({_login("o_custkey")}) END AS author_nk,
        o_orderpriority AS title, state, o_orderpriority = '4-NOT SPECIFIED' AS is_draft,
        o_orderdate AS created_at, updated_at, closed_at, merged_at, 'main' AS base_ref,
        CAST(NULL AS VARCHAR) AS html_url
        FROM rp WHERE bad_id IS NULL AND bad_state IS NULL AND bad_time IS NULL
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1""",
    ),
    "lines": (
        ("n",),
        """SELECT *, l_orderkey * 8 + l_linenumber AS review_id,
        (l_linestatus = 'O' AND l_discount = 0) AS pending,
        (CAST(l_shipdate AS DATE) - DATE '1970-01-01') * 100000000000 + l_partkey AS seq,
        CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'CHANGES_REQUESTED'
          ELSE 'COMMENTED' END AS review_state
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN n ON n_nationkey = c_nationkey WHERE l_shipdate >= o_orderdate""",
    ),
    "rv": (
        ("lines",),
        """SELECT *, n_name AS repository,
        CASE WHEN l_quantity = 1 THEN 'state: expected non-empty string, got ""' END AS bad_state,
        CASE WHEN l_tax = 0 AND l_discount = 0.1 THEN 'context.pull_number missing' END
          AS bad_number FROM lines""",
    ),
    "sv": (
        ("rv",),
        f"""SELECT review_id AS github_review_id, repository AS repository_full_name,
        l_orderkey AS pr_number, 'gh:' || lower({_login("l_suppkey")}) AS reviewer_nk, review_state,
        l_shipdate AS submitted_at
        FROM rv WHERE bad_state IS NULL AND bad_number IS NULL AND NOT pending
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY seq DESC,
          reviewer_nk DESC, review_state DESC) = 1""",
    ),
    # Raw issues, the pull requests among them marked.
    "ri": (
        ("shipped", "n"),
        """SELECT n_name AS repository, *, CASE WHEN o_orderstatus <> 'O' THEN shipped_at END
          AS closed_at, (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS is_pull,
        CASE WHEN o_totalprice > 495000 THEN 'number: expected integer, got null' END AS bad_number,
        CASE WHEN o_totalprice < 5000 THEN 'state: expected open|closed, got "reopened"' END
          AS bad_state
        FROM shipped JOIN n ON n_nationkey = nation
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    ),
    "si": (
        ("ri",),
        f"""SELECT o_orderkey AS github_issue_id, repository AS repository_full_name,
        o_orderkey AS issue_number, 'gh:' || lower({_login("o_custkey")}) AS author_nk,
        o_orderpriority AS title,
        CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
        CASE WHEN o_orderstatus = 'P' THEN 'not_planned' END AS state_reason,
        o_orderdate AS created_at, coalesce(closed_at, o_orderdate) AS updated_at, closed_at,
        CASE o_orderstatus WHEN 'O' THEN 0::BIGINT WHEN 'P' THEN 3::BIGINT END AS comments_count,
        CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN ''
          ELSE o_orderpriority || ',' || o_orderstatus END AS labels
        FROM ri WHERE NOT is_pull AND bad_number IS NULL AND bad_state IS NULL""",
    ),
    # Extraction windows.
    "win": (
        ("n",),
        """SELECT n_name AS repository, entity, r_name,
        CASE WHEN r_name <> 'EUROPE' THEN make_timestamp(1998, 1, 1 + n_nationkey, 10, 30, 15.25)
          END AS previous,
        CASE WHEN r_name <> 'EUROPE'
          THEN make_timestamp(1998, 1, 1 + n_nationkey, 10, 30, 15.25) - INTERVAL 60 MINUTE
          ELSE TIMESTAMP '2001-06-01' - INTERVAL 365 DAY END AS since
        FROM n, (VALUES ('commits'), ('pull_requests'), ('issues')) e(entity)""",
    ),
    "wc": (
        ("rc", "win"),
        """SELECT rc.*, since FROM rc JOIN win ON win.repository = rc.repository
        AND entity = 'commits' WHERE committed_at IS NULL
        OR committed_at >= date_trunc('second', since)""",
    ),
    "wp": (
        ("rp", "win"),
        """SELECT rp.* FROM rp JOIN win ON win.repository = rp.repository
        AND entity = 'pull_requests' WHERE updated_at IS NULL OR updated_at >= since""",
    ),
    "wi": (
        ("ri", "win"),
        """SELECT ri.* FROM ri JOIN win ON win.repository = ri.repository AND entity = 'issues'
        WHERE NOT is_pull AND coalesce(closed_at, o_orderdate) >= date_trunc('second', since)""",
    ),
    "wv": (
        ("rv", "wp"),
        """SELECT rv.* FROM rv WHERE bad_number IS NULL AND EXISTS (SELECT 1 FROM wp
        WHERE wp.repository = rv.repository AND wp.o_orderkey = rv.l_orderkey)""",
    ),
    "res": (
        ("win", "wc", "wp", "wi", "wv", "n"),
        """SELECT repository, entity, coalesce(records, 0) AS records,
        date_trunc('second', since) AS since,
        date_trunc('second', CASE WHEN truncated THEN previous
          WHEN entity IN ('commits', 'pull_requests', 'issues') THEN greatest(previous, seen) END)
          AS new_watermark, truncated
        FROM (SELECT n_name AS repository, e.entity, win.since, win.previous, s.records, s.seen,
            (n.r_name = 'ASIA' AND e.entity = 'pull_requests') AS truncated
          FROM n CROSS JOIN (VALUES ('repositories'), ('commits'), ('pull_requests'), ('reviews'),
            ('issues')) e(entity)
          LEFT JOIN win ON win.repository = n_name AND win.entity = e.entity
          LEFT JOIN (
            SELECT repository, 'commits' AS entity, count(*) AS records, max(committed_at) AS seen
              FROM wc GROUP BY 1
            UNION ALL SELECT repository, 'pull_requests', count(*), max(updated_at) FROM wp GROUP BY 1
            UNION ALL SELECT repository, 'issues', count(*), max(coalesce(closed_at, o_orderdate))
              FROM wi GROUP BY 1
            UNION ALL SELECT repository, 'reviews', count(*), NULL FROM wv GROUP BY 1
            UNION ALL SELECT n_name, 'repositories', 1, NULL FROM n) s
          ON s.repository = n_name AND s.entity = e.entity) x""",
    ),
    # Contract problems of all entities, one row per problem; and all records.
    "probs": (
        ("rc", "rp", "rv", "ri", "n"),
        """SELECT 'repositories' AS entity, n_name AS repository, n_nationkey::BIGINT AS seq, 1 AS ord,
          'owner.login: expected non-empty string, got ""' AS problem FROM n WHERE r_name = 'AFRICA'
        UNION ALL SELECT 'commits', repository, seq, 1, problem FROM rc WHERE problem IS NOT NULL
        UNION ALL SELECT 'pull_requests', repository, seq, 1, bad_id FROM rp WHERE bad_id IS NOT NULL
        UNION ALL SELECT 'pull_requests', repository, seq, 2, bad_state FROM rp
          WHERE bad_state IS NOT NULL
        UNION ALL SELECT 'pull_requests', repository, seq, 3, bad_time FROM rp
          WHERE bad_time IS NOT NULL
        UNION ALL SELECT 'issues', repository, o_orderkey, 1, bad_number FROM ri
          WHERE bad_number IS NOT NULL
        UNION ALL SELECT 'issues', repository, o_orderkey, 2, bad_state FROM ri
          WHERE bad_state IS NOT NULL""",
    ),
    "badrv": (
        ("rv",),
        """SELECT repository, seq, concat_ws(' | ', bad_state, bad_number) AS problems
        FROM rv WHERE bad_state IS NOT NULL OR bad_number IS NOT NULL""",
    ),
    "rep": (
        ("probs", "rv", "n", "rc", "rp", "ri"),
        """SELECT entity, checked, invalid, round_even(invalid / checked::DOUBLE, 4) AS invalid_ratio,
          reasons
        FROM (SELECT 'repositories' AS entity, (SELECT count(*) FROM n) AS checked
          UNION ALL SELECT 'commits', (SELECT count(*) FROM rc)
          UNION ALL SELECT 'pull_requests', (SELECT count(*) FROM rp)
          UNION ALL SELECT 'reviews', (SELECT count(*) FROM rv)
          UNION ALL SELECT 'issues', (SELECT count(*) FROM ri)) t
        JOIN (SELECT entity, CAST(sum(bad) AS BIGINT) AS invalid FROM (
            SELECT entity, count(DISTINCT seq) AS bad FROM probs GROUP BY 1
            UNION ALL SELECT 'reviews', count(*) FROM rv
              WHERE bad_state IS NOT NULL OR bad_number IS NOT NULL) z GROUP BY 1) b USING (entity)
        JOIN (SELECT entity, string_agg(reason || '=' || c, ', ' ORDER BY reason) AS reasons FROM (
            SELECT entity, split_part(problem, ':', 1) AS reason, count(*) AS c FROM probs GROUP BY 1, 2
            UNION ALL SELECT 'reviews', 'state', count(*) FROM rv WHERE bad_state IS NOT NULL
            UNION ALL SELECT 'reviews', bad_number, count(*) FROM rv WHERE bad_number IS NOT NULL
              GROUP BY 1, 2) y GROUP BY 1) r USING (entity)""",
    ),
    # People of valid records, with what decides between them.
    "act": (
        ("rc", "rp", "rv", "ri"),
        f"""SELECT 0 AS ent, repository, seq, nk, CASE WHEN event_type <> 'error' THEN user_id END AS uid,
          CASE WHEN event_type <> 'error' THEN {_login("user_id")} END AS login,
          CASE WHEN event_type <> 'error' THEN {_login("user_id")} ELSE 'Dev ' || user_id END AS name,
          kind FROM rc, (VALUES (0), (1)) r(role) WHERE problem IS NULL AND nk IS NOT NULL
        UNION ALL SELECT 1, repository, seq, 'gh:' || lower({_login("o_custkey")}), o_custkey,
          {_login("o_custkey")}, {_login("o_custkey")},
          CASE WHEN o_custkey % 10 = 0 THEN 'Bot' ELSE 'User' END FROM rp
          WHERE bad_id IS NULL AND bad_state IS NULL AND bad_time IS NULL
          AND o_totalprice NOT BETWEEN 5000 AND 10000
        UNION ALL SELECT 2, repository, seq, 'gh:' || lower({_login("l_suppkey")}),
          CASE WHEN l_returnflag <> 'N' THEN l_suppkey END, {_login("l_suppkey")},
          {_login("l_suppkey")}, CASE WHEN l_suppkey % 10 = 0 THEN 'Bot' ELSE 'User' END
          FROM rv WHERE bad_state IS NULL AND bad_number IS NULL AND NOT pending
        UNION ALL SELECT 3, repository, o_orderkey, 'gh:' || lower({_login("o_custkey")}), o_custkey,
          lower({_login("o_custkey")}), lower({_login("o_custkey")}),
          CASE WHEN o_custkey % 10 = 0 THEN 'Bot' ELSE 'User' END FROM ri
          WHERE NOT is_pull AND bad_number IS NULL AND bad_state IS NULL""",
    ),
    # The star the quality checks look at.
    "first_ship": ((), "SELECT l_orderkey, min(l_shipdate) AS f FROM lineitem GROUP BY 1"),
    "qpr": (
        ("pr", "first_ship"),
        """SELECT pull_request_key, repository_key, state, created_at, f AS merged_at FROM pr
        LEFT JOIN first_ship ON l_orderkey = pull_request_key WHERE title <> '5-LOW'""",
    ),
    "qissue": (
        ("issue", "first_ship"),
        """SELECT issue_key, state, created_at, CASE WHEN closed_at IS NOT NULL THEN f END AS closed_at
        FROM issue LEFT JOIN first_ship ON l_orderkey = issue_key
        WHERE state_reason IS NULL OR title <> '2-HIGH'""",
    ),
    "qcmt": (("cmt",), "SELECT * FROM cmt WHERE message_headline <> 'view'"),
}

CHECK_SQL = {
    "staged_prs_not_loaded": (
        "SELECT count(*) FROM pr WHERE pull_request_key NOT IN (SELECT pull_request_key FROM qpr)"
    ),
    "staged_commits_not_loaded": (
        "SELECT count(*) FROM cmt JOIN repo USING (repository_key) WHERE language <> 'EUROPE' "
        "AND commit_sha NOT IN (SELECT commit_sha FROM qcmt)"
    ),
    "staged_issues_not_loaded": (
        "SELECT count(*) FROM issue WHERE issue_key NOT IN (SELECT issue_key FROM qissue)"
    ),
    "pr_merged_before_created": "SELECT count(*) FROM qpr WHERE merged_at < created_at",
    "pr_merged_but_open": (
        "SELECT count(*) FROM qpr WHERE merged_at IS NOT NULL AND state = 'open'"
    ),
    "issue_closed_before_created": "SELECT count(*) FROM qissue WHERE closed_at < created_at",
    "closed_issue_without_close_time": (
        "SELECT count(*) FROM qissue WHERE state = 'closed' AND closed_at IS NULL"
    ),
    "reviews_without_pull_request": (
        "SELECT count(*) FROM review JOIN repo USING (repository_key) WHERE language <> 'EUROPE' "
        "AND pull_request_key NOT IN (SELECT pull_request_key FROM qpr)"
    ),
    "commits_without_author": "SELECT count(*) FROM qcmt WHERE message_headline = 'error'",
    "future_dated_activity": (
        "SELECT (SELECT count(*) FROM qcmt WHERE committed_at > TIMESTAMP '2001-01-02') + "
        "(SELECT count(*) FROM qpr WHERE created_at > TIMESTAMP '2001-01-02')"
    ),
}
CHECK_TABLES = ("pr", "qpr", "cmt", "qcmt", "issue", "qissue", "review", "repo")

ERRORS = (
    "staged_prs_not_loaded",
    "staged_commits_not_loaded",
    "staged_issues_not_loaded",
    "pr_merged_before_created",
    "pr_merged_but_open",
    "issue_closed_before_created",
)

DESCRIPTIONS = {
    "staged_prs_not_loaded": "every staged pull request reached the fact table",
    "staged_commits_not_loaded": "every staged commit reached the fact table",
    "staged_issues_not_loaded": "every staged issue reached the fact table",
    "pr_merged_before_created": "merge time is never before creation time",
    "pr_merged_but_open": "a merged pull request is closed",
    "issue_closed_before_created": "close time is never before creation time",
    "closed_issue_without_close_time": "closed issues carry a close time",
    "reviews_without_pull_request": "staged reviews belong to a known pull request",
    "commits_without_author": "commits can be attributed to a contributor",
    "future_dated_activity": "no activity dated in the future (clock skew / bad data)",
}


def _problems(entity: str) -> str:
    return sql(
        f"""SELECT repository, seq AS ingest_seq, string_agg(problem, ' | ' ORDER BY ord) AS problems
        FROM probs WHERE entity = '{entity}' GROUP BY 1, 2""",
        "probs",
    )


def _date_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"


def _hours(start: str, end: str) -> str:
    return (
        f"CAST(round(CAST((epoch_us({end}) - epoch_us({start})) / 3.6e9::DOUBLE "
        f"AS DECIMAL(38,12)), 2) AS DOUBLE)"
    )


CALENDAR_COLUMNS = """d::DATE AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
    year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month,
    monthname(d) AS month_name, isoyear(d)::INTEGER AS iso_year, week(d)::INTEGER AS iso_week,
    date_trunc('week', d)::DATE AS week_start_date, isodow(d)::INTEGER AS day_of_week,
    dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend"""

FIRST, SECOND = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-02-01'"

OPERATORS: dict[str, str] = {
    "raw_landing_scan": sql(
        f"SELECT repository, seq AS ingest_seq, {SECOND} AS extracted_at, sha, message FROM rc", "rc"
    ),
    "extraction_manifest": sql(
        """SELECT 'r1' AS run_id, entity, repository, records, since, new_watermark, truncated
        FROM res""",
        "res",
    ),
    "staged_tables": sql(
        """SELECT repository_full_name, state, count(*) AS pull_requests, count(merged_at) AS merged
        FROM sp GROUP BY 1, 2""",
        "sp",
    ),
    "load_row_counts": sql(
        """SELECT 'repositories' AS "table", (SELECT count(*) FROM n WHERE r_name <> 'AFRICA') AS rows
        UNION ALL SELECT 'commits', (SELECT count(DISTINCT full_sha) FROM rc WHERE problem IS NULL)
        UNION ALL SELECT 'pull_requests', (SELECT count(*) FROM sp)
        UNION ALL SELECT 'reviews', (SELECT count(*) FROM sv)
        UNION ALL SELECT 'issues', (SELECT count(*) FROM si)
        UNION ALL SELECT 'contributors', (SELECT count(DISTINCT nk) FROM act)""",
        "n", "rc", "sp", "sv", "si", "act",
    ),
    "report_csv": ANALYTICS["weekly_pr_volume"],
    "quarantine": sql(
        """SELECT repository, concat_ws(' | ', bad_number, bad_state) AS problems,
        o_orderkey AS issue_id FROM ri
        WHERE NOT is_pull AND (bad_number IS NOT NULL OR bad_state IS NOT NULL)""",
        "ri",
    ),
    "calendar": f"SELECT {CALENDAR_COLUMNS} FROM (SELECT DISTINCT o_orderdate AS d FROM orders) o",
    "discovered_repositories": sql(
        "SELECT n_name AS repository FROM n WHERE r_name <> 'EUROPE'", "n"
    ),
    "extraction_windows": sql("SELECT repository, entity, since FROM win", "win"),
    "windowed_commits": sql("SELECT repository, seq AS ingest_seq FROM wc", "wc"),
    "windowed_pull_requests": sql("SELECT repository, seq AS ingest_seq FROM wp", "wp"),
    "windowed_issues": sql("SELECT repository, o_orderkey AS ingest_seq FROM wi", "wi"),
    "windowed_reviews": sql("SELECT repository, seq AS ingest_seq FROM wv", "wv"),
    "issues_without_pull_requests": sql(
        "SELECT repository, o_orderkey AS ingest_seq FROM ri WHERE NOT is_pull", "ri"
    ),
    "high_water_marks": sql("SELECT * FROM res", "res"),
    "merged_watermarks": sql(
        f"""SELECT repository AS repository_full_name, entity,
        greatest(previous, new_watermark) AS watermark_at,
        CASE WHEN new_watermark IS NULL THEN 'r0' ELSE 'r1' END AS updated_by_run,
        CASE WHEN new_watermark IS NULL THEN {FIRST} ELSE {SECOND} END AS updated_at
        FROM win JOIN res USING (repository, entity)
        WHERE previous IS NOT NULL OR new_watermark IS NOT NULL""",
        "win", "res",
    ),
    "empty_repositories": sql(
        """SELECT n_name AS repository, e.entity, CAST(CASE WHEN e.entity = 'repositories'
          THEN 1 ELSE 0 END AS BIGINT) AS records,
        date_trunc('second', previous) AS new_watermark
        FROM n CROSS JOIN (VALUES ('repositories'), ('commits'), ('pull_requests'), ('reviews'),
          ('issues')) e(entity)
        LEFT JOIN win ON win.repository = n_name AND win.entity = e.entity
        WHERE n.r_name = 'AMERICA'""",
        "win", "n",
    ),
    "extraction_record_counts": sql(
        "SELECT entity, CAST(sum(records) AS BIGINT) AS records FROM res GROUP BY 1", "res"
    ),
    "contract_problems_repositories": _problems("repositories"),
    "contract_problems_commits": _problems("commits"),
    "contract_problems_pull_requests": _problems("pull_requests"),
    "contract_problems_issues": _problems("issues"),
    "contract_problems_reviews": sql(
        "SELECT repository, seq AS ingest_seq, problems FROM badrv", "badrv"
    ),
    "contract_checks": """SELECT event_id, true AS integer_of_integer, false AS integer_of_decimal,
        false AS integer_below_text, length(event_type) > 0 AS text_of_text,
        false AS text_of_blank, false AS text_of_integer, ts IS NOT NULL AS instant_of_instant,
        ts IS NOT NULL AS instant_of_day,
        try_cast(event_type AS TIMESTAMP) IS NOT NULL AS instant_of_text,
        true AS optional_of_null, true AS optional_of_absent, false AS optional_of_text,
        event_type IN ('view', 'click') AS one_of_kind, true AS sha_of_sha,
        regexp_full_match(upper(to_hex(event_id)), '[0-9]*') AS sha_of_upper, true AS list_of_list,
        false AS list_of_object FROM events""",
    "contract_report": sql("SELECT * FROM rep", "rep"),
    "contract_gate": sql(
        "SELECT entity, invalid_ratio, invalid_ratio > 0.05 AS breached FROM rep", "rep"
    ),
    "staged_repositories": sql(
        """SELECT n_nationkey::BIGINT AS github_repo_id, n_name AS full_name, r_name AS owner_login,
        lower(n_name) AS name, CAST(NULL AS VARCHAR) AS description, r_name AS language,
        false AS is_private, r_name = 'EUROPE' AS is_fork, false AS is_archived,
        'main' AS default_branch, TIMESTAMP '2020-01-01' AS created_at,
        TIMESTAMP '2024-06-10 10:00:00.5' AS pushed_at, n_nationkey::BIGINT * 2 AS stargazers_count,
        CAST(NULL AS BIGINT) AS forks_count, CAST(NULL AS BIGINT) AS open_issues_count,
        CAST(NULL AS VARCHAR) AS html_url FROM n WHERE r_name <> 'AFRICA'""",
        "n",
    ),
    "staged_commits": sql(
        """SELECT repository AS repository_full_name, full_sha AS commit_sha, nk AS author_nk,
        nk AS committer_nk, ts AS authored_at, ts AS committed_at, headline AS message_headline,
        k % 3 AS parent_count, CAST(NULL AS VARCHAR) AS html_url FROM rc WHERE problem IS NULL
        QUALIFY row_number() OVER (PARTITION BY repository, full_sha ORDER BY seq) = 1""",
        "rc",
    ),
    "staged_pull_requests": sql("SELECT * FROM sp", "sp"),
    "staged_reviews": sql("SELECT * FROM sv", "sv"),
    "staged_issues": sql("SELECT * FROM si", "si"),
    "message_headlines": """SELECT doc_id, CASE WHEN text <> '' THEN substr(regexp_extract(text,
        '^[^\\n\\x{0b}\\f\\r\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]*'), 1, 250) END AS headline
        FROM documents""",
    "text_rules": """SELECT o_orderkey,
        replace(replace(o_orderpriority || '_' || o_orderstatus, ' ', '_'), '+', '_') AS run_id,
        o_orderstatus || '__' || o_orderpriority AS slug FROM orders""",
    "linked_accounts": """SELECT 'gh:' || lower(c_name) AS contributor_nk,
        CASE WHEN c_acctbal < 5000 THEN c_custkey END AS github_user_id, c_name AS login,
        c_name AS display_name,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Bot' ELSE 'User' END AS user_type,
        c_mktsegment = 'MACHINERY' AS is_bot FROM customer WHERE NOT c_acctbal < 0""",
    "git_identities": """SELECT event_id, 'git:' || substr(sha256(
          CASE WHEN value >= 10 THEN 'user' || user_id || '@example.org' ELSE 'name:' || name END),
          1, 16) AS contributor_nk, name AS display_name, 'Unlinked' AS user_type,
        event_type = 'signup' AS is_bot
        FROM (SELECT *, 'Dev ' || user_id || CASE WHEN event_type = 'signup' THEN '[bot]' ELSE '' END
          AS name FROM events WHERE value >= 1) e""",
    "commit_people": sql(
        "SELECT seq AS ingest_seq, nk AS author_nk, kind AS committer_type FROM rc", "rc"
    ),
    "actor_mentions": sql(
        "SELECT nk AS contributor_nk, count(*) AS mentions FROM act GROUP BY 1", "act"
    ),
    "staged_contributors": sql(
        """SELECT nk AS contributor_nk, uid AS github_user_id, login, name AS display_name,
        kind AS user_type, kind = 'Bot' AS is_bot FROM act
        QUALIFY row_number() OVER (PARTITION BY nk ORDER BY uid IS NOT NULL DESC, ent DESC,
          repository DESC, seq DESC) = 1""",
        "act",
    ),
    "dedupe_keep_first": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, l_partkey, l_suppkey) = 1""",
    "dedupe_keep_last": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "distinct_weeks": sql(
        """SELECT DISTINCT week_start_date FROM cal
        WHERE full_date >= (SELECT min(o_orderdate)::DATE FROM orders)""",
        "cal",
    ),
    "merge_dim_date": sql(
        """SELECT date_key, full_date, week_start_date, isoyear(full_date)::INTEGER AS iso_year,
        week(full_date)::INTEGER AS iso_week FROM cal
        WHERE full_date <= (SELECT max(o_orderdate)::DATE FROM orders)""",
        "cal",
    ),
    "merge_dim_repository": sql(
        f"""SELECT n_nationkey::BIGINT AS github_repo_id, n_name AS full_name,
        lower(r_name) AS owner_login, lower(n_name) AS name, CAST(NULL AS VARCHAR) AS description,
        r_name AS language, false AS is_private, false AS is_fork, false AS is_archived,
        'main' AS default_branch,
        CASE WHEN r_name = 'AFRICA' THEN {SECOND} ELSE {FIRST} END AS created_at,
        {FIRST} AS pushed_at,
        n_nationkey::BIGINT + CASE WHEN r_name = 'ASIA' THEN 1 ELSE 0 END AS stargazers_count,
        0::BIGINT AS forks_count, 0::BIGINT AS open_issues_count,
        CASE WHEN r_name IN ('ASIA', 'AFRICA') THEN 'new' ELSE 'old' END AS html_url,
        CASE WHEN r_name = 'AFRICA' THEN {SECOND} ELSE {FIRST} END AS first_loaded_at,
        CASE WHEN r_name IN ('ASIA', 'AFRICA') THEN {SECOND} ELSE {FIRST} END AS last_updated_at
        FROM n""",
        "n",
    ),
    "merge_dim_contributor": f"""SELECT 'gh:' || lower(c_name) AS contributor_nk,
        CASE WHEN fresh THEN new_id WHEN changed THEN coalesce(new_id, old_id) ELSE old_id END
          AS github_user_id,
        CASE WHEN fresh AND c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_name END AS login,
        CASE WHEN c_mktsegment = 'FURNITURE' THEN upper(c_name) ELSE c_name END AS display_name,
        'User' AS user_type, false AS is_bot,
        CASE WHEN fresh THEN {SECOND} ELSE {FIRST} END AS first_loaded_at,
        CASE WHEN fresh OR changed THEN {SECOND} ELSE {FIRST} END AS last_updated_at
        FROM (SELECT *, c_mktsegment = 'AUTOMOBILE' AS fresh,
          CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS new_id,
          CASE WHEN c_acctbal >= 0 THEN c_custkey END AS old_id,
          (c_mktsegment = 'FURNITURE' OR coalesce(CASE WHEN c_mktsegment <> 'BUILDING'
            THEN c_custkey END, CASE WHEN c_acctbal >= 0 THEN c_custkey END)
            IS DISTINCT FROM CASE WHEN c_acctbal >= 0 THEN c_custkey END) AS changed
          FROM customer) c""",
    "merge_fact_pull_request": sql(
        f"""SELECT pull_request_key, title, state, is_merged, updated_at,
        {_date_key("closed_at")} AS closed_date_key, {_date_key("merged_at")} AS merged_date_key,
        {_hours("created_at", "merged_at")} AS cycle_time_hours,
        CASE WHEN created_at < TIMESTAMP '2000-01-01' THEN 'dev' ELSE 'main' END AS base_ref,
        {SECOND} AS loaded_at FROM pr""",
        "pr",
    ),
    "merge_fact_issue": sql(
        f"""SELECT issue_key, issue_key AS issue_number, title, state, state_reason,
        {_date_key("closed_at")} AS closed_date_key, 0::BIGINT AS comments_count,
        title || ',' || state AS labels, {_hours("created_at", "closed_at")} AS time_to_close_hours,
        {SECOND} AS loaded_at FROM issue""",
        "issue",
    ),
    "merge_fact_commit": sql(
        f"""SELECT commit_sha, message_headline = 'error' AS author_unknown, message_headline,
        {_date_key("committed_at")} AS committed_date_key,
        CASE WHEN message_headline = 'signup' THEN parent_count ELSE 1 END AS parent_count,
        message_headline = 'signup' AND parent_count > 1 AS is_merge_commit,
        {SECOND} AS loaded_at FROM cmt""",
        "cmt",
    ),
    "merge_fact_review": sql(
        f"""SELECT review_key, pull_request_key,
        CASE WHEN review_state = 'APPROVED' THEN 'DISMISSED' ELSE review_state END AS review_state,
        submitted_at, {_date_key("submitted_at")} AS submitted_date_key,
        CASE WHEN review_state = 'APPROVED' THEN {SECOND} ELSE {FIRST} END AS loaded_at
        FROM review JOIN pr USING (pull_request_key) WHERE state = 'closed'""",
        "review", "pr",
    ),
    "surrogate_keys": """SELECT 'contributor' AS dimension, count(*) AS rows,
        count(DISTINCT c_custkey) AS keys FROM customer
        UNION ALL SELECT 'repository', count(*), count(DISTINCT n_nationkey) FROM nation""",
    "date_keys": sql(
        f"""SELECT pull_request_key, {_date_key("created_at")} AS created_date_key,
        {_date_key("closed_at")} AS closed_date_key, {_date_key("merged_at")} AS merged_date_key
        FROM pr""",
        "pr",
    ),
    "generated_columns": sql(
        f"""SELECT pull_request_key, f IS NOT NULL AS is_merged,
        {_hours("created_at", "f")} AS cycle_time_hours
        FROM pr LEFT JOIN first_ship ON l_orderkey = pull_request_key""",
        "pr", "first_ship",
    ),
    "generated_merge_commits": sql(
        "SELECT commit_sha, parent_count > 1 AS is_merge_commit FROM cmt", "cmt"
    ),
    "versioned_load": sql(
        """SELECT pull_request_key, title, state, is_merged,
        date_trunc('month', created_at)::DATE AS event_month FROM pr""",
        "pr",
    ),
    "run_log": sql(
        f"""SELECT r_name AS run_id,
        CASE WHEN r_name = 'ASIA' THEN 'failed' ELSE 'succeeded' END AS status,
        {FIRST} AS started_at, {SECOND} AS finished_at, '{{"n":' || count(*) || '}}' AS extracted,
        CASE WHEN r_name = 'ASIA' THEN 'boom' END AS error_message FROM n GROUP BY r_name""",
        "n",
    ),
    "constraint_check": sql(
        """WITH d AS (
          SELECT 'fact_pull_request' AS t, 'created_date_key' AS k, created_at AS ts FROM pr
          UNION ALL SELECT 'fact_pull_request', 'closed_date_key', closed_at FROM pr
          UNION ALL SELECT 'fact_pull_request', 'merged_date_key', merged_at FROM pr
          UNION ALL SELECT 'fact_issue', 'created_date_key', created_at FROM issue
          UNION ALL SELECT 'fact_issue', 'closed_date_key', closed_at FROM issue
          UNION ALL SELECT 'fact_review', 'submitted_date_key', submitted_at FROM review)
        SELECT t AS "table", k || ' is in the calendar' AS rule, count(*) AS violations
        FROM d WHERE ts < TIMESTAMP '2000-01-01' GROUP BY 1, 2""",
        "pr", "issue", "review",
    ),
    "load_constraints": sql(
        """WITH odd AS (SELECT * FROM pr WHERE pull_request_key % 8 = 1)
        SELECT 'fact_pull_request' AS "table", rule, violations FROM (
          SELECT 'updated_at is required' AS rule, count(*) FILTER (title = '5-LOW') AS violations FROM odd
          UNION ALL SELECT 'state is open or closed', count(*) FILTER (title = '1-URGENT') FROM odd
          UNION ALL SELECT 'created_date_key is in the calendar',
            count(*) FILTER (created_at < TIMESTAMP '1995-01-01') FROM odd
          UNION ALL SELECT 'closed_date_key is in the calendar',
            count(*) FILTER (closed_at < TIMESTAMP '1995-01-01') FROM odd
          UNION ALL SELECT 'merged_date_key is in the calendar',
            count(*) FILTER (merged_at < TIMESTAMP '1995-01-01') FROM odd
          UNION ALL SELECT '(repository_key, pr_number) is unique', count(*) FROM odd
          UNION ALL SELECT 'repository_key is in dim_repository', count(DISTINCT repository_key) FROM odd
          UNION ALL SELECT 'author_key is in dim_contributor',
            count(DISTINCT author_key) FILTER (author_key NOT IN (
              SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)) FROM odd)
        WHERE violations > 0""",
        "pr",
    ),
    "load_rebase": sql(
        """SELECT pull_request_key, date_trunc('month', created_at)::DATE AS event_month,
        'again' AS refused FROM pr""",
        "pr",
    ),
    "quality_results": sql(
        "SELECT name, severity, description, violations, violations = 0 AS passed FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS name, '{'error' if name in ERRORS else 'warn'}' AS severity, "
            f"'{DESCRIPTIONS[name]}' AS description, ({body}) AS violations"
            for name, body in CHECK_SQL.items()
        )
        + ") c",
        *CHECK_TABLES,
    ),
    "all_named_queries": " UNION ALL ".join(
        f"SELECT '{name}' AS query, (SELECT count(*) FROM ({body}) q) AS rows"
        for name, body in ANALYTICS.items()
    ),
    "report_preview": (
        f"SELECT * FROM ({ANALYTICS['pr_cycle_time_by_repository']}) q "
        "ORDER BY merged_prs DESC, repository LIMIT 15"
    ),
    "cycle_time_from_raw_records": sql(
        f"""WITH m AS (SELECT *, CAST(round(CAST(epoch_us(merged_at) - epoch_us(created_at) AS DOUBLE)
            / 36000000, 0) AS BIGINT) / 100.0::DOUBLE AS h FROM sp WHERE merged_at IS NOT NULL)
        SELECT repository_full_name AS repository, count(*) AS merged_prs,
        {round1("avg(h)")} AS avg_hours_to_merge,
        {round1("quantile_cont(h, 0.5)")} AS median_hours_to_merge,
        {round1("quantile_cont(h, 0.9)")} AS p90_hours_to_merge
        FROM m JOIN n ON n_name = repository_full_name WHERE r_name <> 'AFRICA' GROUP BY 1""",
        "sp", "n",
    ),
    "weekly_commits_by_calendar": sql(
        """SELECT week_start_date, count(*) AS commits,
        count(*) FILTER (WHERE isodow(full_date) >= 6) AS on_weekends
        FROM cmt JOIN cal ON full_date = committed_at::DATE GROUP BY 1""",
        "cmt", "cal",
    ),
    "stream_load": sql(
        f"""SELECT github_pr_id AS pull_request_key, state, merged_at IS NOT NULL AS is_merged,
        {_date_key("merged_at")} AS merged_date_key
        FROM sp JOIN n ON n_name = repository_full_name WHERE r_name <> 'AFRICA'""",
        "sp", "n",
    ),
    "stream_many_runs": sql(
        f"""SELECT github_pr_id AS pull_request_key, state, merged_at IS NOT NULL AS is_merged,
        {_date_key("merged_at")} AS merged_date_key, max_files
        FROM sp JOIN n ON n_name = repository_full_name, (VALUES (0), (1), (3)) AS m(max_files)
        WHERE r_name <> 'AFRICA'""",
        "sp", "n",
    ),
    "stream_isolation": sql(
        """SELECT run_id, status, parked, (SELECT count(*) FROM sp JOIN n
          ON n_name = repository_full_name WHERE r_name <> 'AFRICA') AS pulls
        FROM (VALUES ('r0', 'succeeded', false), ('r1', 'failed', true), ('r2', 'succeeded', false))
          AS v(run_id, status, parked)""",
        "sp", "n",
    ),
    "stream_watermarks": sql(
        """SELECT way, repository AS repository_full_name, entity,
        greatest(previous, new_watermark) AS watermark_at
        FROM win JOIN res USING (repository, entity), (VALUES ('batch'), ('stream')) AS w(way)
        WHERE previous IS NOT NULL OR new_watermark IS NOT NULL""",
        "win", "res",
    ),
    "stream_replay": sql(
        """SELECT 'r0' AS run_id, 'succeeded' AS status, true AS loaded_once, count(*) AS pulls
        FROM sp JOIN n ON n_name = repository_full_name WHERE r_name <> 'AFRICA'""",
        "sp", "n",
    ),
    "stream_drop_overlap": "SELECT event_id, user_id FROM events",
    "stream_weekly_counts": """SELECT date_trunc('week', ts)::DATE AS week_start_date,
        CAST(sum(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS rows
        FROM events GROUP BY 1""",
}

OPERATORS |= {
    f"check_{name}": sql(f"SELECT '{name}' AS name, ({body}) AS violations", *CHECK_TABLES)
    for name, body in CHECK_SQL.items()
}
