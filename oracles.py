"""DuckDB statements that give the same rows as the registered queries.

The staged columns are computed straight from ``events``, not through JSON, so
that the JSON path is checked independently.
"""

from __future__ import annotations

OTHER_TYPES = [
    "CreateEvent",
    "DeleteEvent",
    "IssueCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "CommitCommentEvent",
    "ReleaseEvent",
    "PublicEvent",
    "MemberEvent",
    "GollumEvent",
    "SponsorshipEvent",
]
ACCEPTED = ", ".join(
    f"'{t}'"
    for t in ["WatchEvent", "PushEvent", "ForkEvent", "IssuesEvent", "PullRequestEvent", *OTHER_TYPES]
)

KIND = f"""CASE WHEN event_type = 'purchase' THEN 'PullRequestEvent'
 WHEN n % 91 = 87 AND day(first_at) < 25 THEN 'SponsorshipEvent'
 WHEN n % 7 = 3 THEN [{", ".join(f"'{t}'" for t in OTHER_TYPES)}, 'UnknownEvent', NULL][n % 13 + 1]
 WHEN event_type = 'view' THEN 'WatchEvent' WHEN event_type = 'click' THEN 'PushEvent'
 WHEN event_type = 'signup' THEN 'ForkEvent' WHEN event_type = 'error' THEN 'IssuesEvent' END"""

SUFFIX = "CASE WHEN hour(sent_at) >= 12 THEN '-new' ELSE '' END"

# Every delivery, with the columns that staging gives it.
DELIVERIES = f"""
source AS (
  SELECT event_id AS n, event_type, user_id, ts AS sent_at, ts AS first_at, false AS again,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
sent AS (
  SELECT * FROM source
  UNION ALL
  SELECT n, event_type, user_id, sent_at + INTERVAL 1 HOUR, first_at, true, k FROM source WHERE n % 20 = 0),
deliveries AS (
  SELECT n, again, CAST(n AS VARCHAR) AS event_id, {KIND} AS event_type, CASE WHEN n % 211 <> 5 THEN user_id END AS actor_id,
         CASE WHEN n % 211 <> 5 THEN 'u' || user_id || {SUFFIX} END AS actor_login,
         CASE WHEN n % 500 <> 7 THEN k END AS repo_id,
         CASE WHEN n % 500 <> 7 THEN 'org' || (k % 10) || '/repo' || k || {SUFFIX} END AS repo_name,
         CASE WHEN n % 2 = 0 THEN 'labeled' ELSE 'opened' END AS action,
         n % 1000 AS pr_number, sent_at AS created_at
  FROM sent)"""

SCALARS = "event_id, event_type, actor_id, actor_login, repo_id, repo_name, created_at"

STAGED = f"""{DELIVERIES},
staged AS (SELECT * FROM deliveries WHERE NOT again)"""

ORDERS = """
staged AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'PushEvent' WHEN '2-HIGH' THEN 'IssuesEvent'
           WHEN '3-MEDIUM' THEN 'WatchEvent' WHEN '4-NOT SPECIFIED' THEN 'ForkEvent'
           WHEN '5-LOW' THEN 'ForkEvent' END AS event_type,
         o_custkey AS actor_id, 'c' || o_custkey AS actor_login,
         o_orderkey % 50 AS repo_id, 'repo' || (o_orderkey % 50) AS repo_name,
         o_orderdate AS created_at
  FROM orders)"""

LINEITEM = """
staged AS (
  SELECT l_orderkey || '-' || l_linenumber AS event_id,
         CASE l_returnflag WHEN 'N' THEN 'PushEvent' WHEN 'R' THEN 'WatchEvent'
           WHEN 'A' THEN 'ForkEvent' END AS event_type,
         l_suppkey AS actor_id, 's' || l_suppkey AS actor_login,
         l_partkey AS repo_id, 'part' || l_partkey AS repo_name, l_shipdate AS created_at
  FROM lineitem)"""

CATEGORY = """CASE WHEN event_type = 'WatchEvent' THEN 'star' WHEN event_type = 'ForkEvent' THEN 'fork'
 WHEN event_type IN ('PushEvent', 'PullRequestEvent', 'PullRequestReviewEvent',
                     'PullRequestReviewCommentEvent', 'CommitCommentEvent') THEN 'code'
 WHEN event_type IN ('IssuesEvent', 'IssueCommentEvent') THEN 'issue'
 WHEN event_type IN ('CreateEvent', 'DeleteEvent', 'PublicEvent') THEN 'repo_activity'
 WHEN event_type = 'ReleaseEvent' THEN 'release'
 WHEN event_type IN ('MemberEvent', 'SponsorshipEvent') THEN 'community'
 WHEN event_type = 'GollumEvent' THEN 'wiki' ELSE 'other' END"""

EVENTS = f"""
kinds AS (SELECT *, {CATEGORY} AS category, CAST(created_at AS DATE) AS date_day FROM staged)"""

STATS = f"""{EVENTS},
repo_daily AS (
  SELECT md5(coalesce(CAST(repo_id AS VARCHAR), '_null_') || '-'
             || strftime(date_day, '%Y-%m-%d')) AS surrogate_key,
         repo_id, date_day,
         last(repo_name ORDER BY created_at, repo_name) FILTER (WHERE repo_name IS NOT NULL)
           AS repo_name,
         CAST(count(*) FILTER (WHERE category = 'star') AS BIGINT) AS star_count,
         CAST(count(*) FILTER (WHERE category = 'fork') AS BIGINT) AS fork_count,
         CAST(count(*) FILTER (WHERE category = 'code') AS BIGINT) AS code_event_count,
         CAST(count(*) FILTER (WHERE category = 'issue') AS BIGINT) AS issue_count,
         CAST(count(*) FILTER (WHERE category = 'release') AS BIGINT) AS release_count,
         count(DISTINCT actor_id) AS unique_contributors,
         count(*) AS total_events
  FROM kinds GROUP BY repo_id, date_day)"""

ACTIVITY = f"""{EVENTS},
activity AS (
  SELECT md5(coalesce(CAST(actor_id AS VARCHAR), '_null_') || '-'
             || strftime(date_day, '%Y-%m-%d')) AS surrogate_key,
         actor_id, date_day,
         last(actor_login ORDER BY created_at, actor_login)
           FILTER (WHERE actor_login IS NOT NULL) AS actor_login,
         count(*) AS total_events,
         count(*) FILTER (WHERE category = 'code') AS code_contributions,
         count(*) FILTER (WHERE category = 'issue') AS issue_interactions,
         count(*) FILTER (WHERE category = 'star') AS stars_given,
         count(DISTINCT repo_id) AS unique_repos_touched,
         CAST(count(*) FILTER (WHERE category = 'code') AS DOUBLE) / count(*)
           AS code_contribution_ratio
  FROM kinds GROUP BY actor_id, date_day)"""


def rolling(frame: str) -> str:
    window = f"OVER (PARTITION BY repo_id ORDER BY date_day {frame})"
    return f"""{STATS},
rolling AS (
  SELECT *, CAST(sum(star_count) {window} AS BIGINT) AS rolling_7d_stars,
         CAST(sum(fork_count) {window} AS BIGINT) AS rolling_7d_forks,
         CAST(sum(code_event_count) {window} AS BIGINT) AS rolling_7d_code_events
  FROM repo_daily)"""


ROLLING = rolling("ROWS BETWEEN 6 PRECEDING AND CURRENT ROW")

TRENDING = f"""{ROLLING},
trending AS (
  SELECT * FROM (
    SELECT repo_id, repo_name, date_day, star_count, rolling_7d_stars, rolling_7d_forks,
           rolling_7d_code_events, unique_contributors,
           rank() OVER (PARTITION BY date_day ORDER BY rolling_7d_stars DESC) AS trending_rank
    FROM rolling)
  WHERE trending_rank <= 100)"""

CATEGORY_DAILY = f"""{EVENTS},
category_daily AS (
  SELECT date_day, category AS event_category, count(*) AS event_count,
         count(DISTINCT actor_id) AS unique_contributors,
         count(DISTINCT repo_name) AS unique_repos
  FROM kinds GROUP BY date_day, category)"""

TRENDS = f"""{CATEGORY_DAILY},
lagged AS (
  SELECT *, lag(event_count, 7) OVER (PARTITION BY event_category ORDER BY date_day)
         AS event_count_7d_ago
  FROM category_daily),
trends AS (
  SELECT *, CASE WHEN event_count_7d_ago = 0 OR event_count_7d_ago IS NULL THEN NULL
            ELSE CAST(event_count - event_count_7d_ago AS DOUBLE) / event_count_7d_ago END
         AS wow_growth_rate
  FROM lagged)"""

PR_LABELS = f"""{STAGED},
pr_labels AS (
  SELECT event_id, repo_id, repo_name, actor_id, created_at, pr_number,
         CASE WHEN (n * 7 + p * 3) % 40 <> 39 THEN 'label' || ((n * 7 + p * 3) % 40) END
           AS label_name, 'ededed' AS label_color,
         CAST(p AS BIGINT) AS label_position
  FROM staged CROSS JOIN (VALUES (0), (1), (2), (3)) AS positions(p)
  WHERE event_type = 'PullRequestEvent' AND action = 'labeled' AND p < n % 4)"""

LABEL_DAILY = f"""{PR_LABELS},
label_daily AS (
  SELECT CAST(created_at AS DATE) AS date_day, label_name, count(*) AS label_applied_count,
         count(DISTINCT repo_id) AS unique_repos, count(DISTINCT event_id) AS unique_prs
  FROM pr_labels GROUP BY 1, 2)"""

LABELS = f"""{LABEL_DAILY},
label_usage AS (
  SELECT date_day, label_name, label_applied_count, unique_repos, unique_prs, daily_rank
  FROM (SELECT *, rank() OVER (PARTITION BY date_day ORDER BY label_applied_count DESC)
                  AS daily_rank FROM label_daily)
  WHERE daily_rank <= 20)"""

COHORTS = f"""{ACTIVITY},
cohorts AS (
  SELECT *, CAST(date_trunc('month', min(date_day) OVER (PARTITION BY actor_id)) AS DATE)
         AS cohort_month
  FROM activity)"""

RETENTION = f"""{COHORTS},
by_month AS (
  SELECT cohort_month, CAST(date_trunc('month', date_day) AS DATE) AS activity_month,
         date_diff('month', cohort_month, CAST(date_trunc('month', date_day) AS DATE))
           AS months_since_first,
         count(DISTINCT actor_id) AS retained_contributors,
         CAST(sum(code_contributions) AS BIGINT) AS total_code_contributions
  FROM cohorts GROUP BY 1, 2, 3),
retention AS (
  SELECT cohort_month, activity_month, months_since_first, cohort_size,
         retained_contributors,
         CASE WHEN cohort_size = 0 OR cohort_size IS NULL THEN NULL
              ELSE CAST(retained_contributors AS DOUBLE) / cohort_size END AS retention_rate,
         total_code_contributions
  FROM (SELECT *, first_value(retained_contributors)
                  OVER (PARTITION BY cohort_month ORDER BY months_since_first) AS cohort_size
        FROM by_month))"""

# The deliveries that an incremental run sees, given what was staged before.
SPLIT = f"""{DELIVERIES},
cut AS (SELECT CAST(max(created_at) AS DATE) - 5 AS day FROM deliveries),
target AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY created_at) AS place
    FROM deliveries WHERE created_at < (SELECT day FROM cut))
  WHERE place = 1),
bound AS (SELECT max(created_at) - INTERVAL 3 HOUR AS since FROM target),
batch AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY created_at) AS place
    FROM deliveries WHERE created_at > (SELECT since FROM bound))
  WHERE place = 1)"""

SPINE = """
hours AS (
  SELECT unnest(generate_series(
           CAST(CAST(first AS DATE) AS TIMESTAMP),
           CAST(CAST(last AS DATE) AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS hour
  FROM bounds),
spine AS (
  SELECT hour, strftime(hour, '%Y-%m-%d-') || hour(hour) AS hour_key,
         strftime(hour, 'year=%Y/month=%m/day=%d/hour=%H/%Y-%m-%d-') || hour(hour) || '.json.gz'
           AS path
  FROM hours)"""


# Two briefings with the best ten of the last day. A variant's keys are sorted.
LOGGED = """
logged AS (
  SELECT date_trunc('hour', now) + INTERVAL 1 MINUTE * late AS generated_at, trending_rank AS place,
         CAST(to_json(struct_pack(
           date_day := CAST(date_day AS VARCHAR), repo_name := repo_name,
           rolling_7d_forks := rolling_7d_forks, rolling_7d_stars := rolling_7d_stars,
           trending_rank := trending_rank, unique_contributors := unique_contributors)) AS VARCHAR)
           AS item
  FROM trending, (SELECT max(ts) AS now FROM events), (VALUES (0), (5)) AS times(late)
  WHERE date_day = (SELECT max(date_day) FROM trending) AND trending_rank <= 10)"""

# The staged table after an incremental run.
UPSERTED = f"""{SPLIT},
staged AS (
  SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM batch)
  UNION ALL SELECT * FROM batch)"""


def as_json(name: str, table: str, columns: str) -> str:
    packed = ", ".join(
        f"{c} := CAST({c} AS VARCHAR)" if c.endswith(("_day", "_month")) else f"{c} := {c}"
        for c in sorted(columns.split())
    )
    return f"SELECT '{name}' AS mart, CAST(to_json(struct_pack({packed})) AS VARCHAR) AS row FROM {table}"


def checks(kind: str, model: str, column: str, severity: str, failures: str) -> str:
    return f"""SELECT '{kind}' AS "check", '{model}' AS model, '{column}' AS "column",
 failures, '{severity}' AS severity,
 CASE WHEN failures = 0 THEN 'pass' WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END AS status
 FROM ({failures})"""


def nulls(model: str, table: str, column: str, severity: str = "error") -> str:
    count = f"SELECT count(*) AS failures FROM {table} WHERE {column} IS NULL"
    return checks("not_null", model, column, severity, count)


def repeats(model: str, table: str, column: str) -> str:
    count = (
        f"SELECT count(*) AS failures FROM (SELECT {column} FROM {table} "
        f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    )
    return checks("unique", model, column, "error", count)


# All four marts, one JSON text a row.
ALL_MARTS = ",".join([LABELS, TRENDING, TRENDS[len(EVENTS) + 1 :], RETENTION[len(EVENTS) + 1 :]])
MART_ROWS = " UNION ALL ".join(
    [
        as_json(
            "trending_repos",
            "trending",
            "repo_id repo_name date_day star_count rolling_7d_stars rolling_7d_forks "
            "rolling_7d_code_events unique_contributors trending_rank",
        ),
        as_json(
            "contributor_retention",
            "retention",
            "cohort_month activity_month months_since_first cohort_size retained_contributors "
            "retention_rate total_code_contributions",
        ),
        as_json(
            "category_trends",
            "trends",
            "date_day event_category event_count unique_contributors unique_repos "
            "event_count_7d_ago wow_growth_rate",
        ),
        as_json(
            "label_usage",
            "label_usage",
            "date_day label_name label_applied_count unique_repos unique_prs daily_rank",
        ),
    ]
)


def _report() -> str:
    with_all = ",".join(
        [
            LABELS,
            TRENDING,
            TRENDS[len(EVENTS) + 1 :],
            RETENTION[len(EVENTS) + 1 :],
            "raw AS (SELECT event_id AS id, event_type AS type, created_at FROM deliveries)",
        ]
    )
    strange = (
        "SELECT count(DISTINCT event_type) AS failures FROM staged "
        f"WHERE event_type NOT IN ({ACCEPTED})"
    )
    parts = [
        repeats("raw_events", "raw", "id"),
        nulls("raw_events", "raw", "id"),
        nulls("raw_events", "raw", "type"),
        nulls("raw_events", "raw", "created_at"),
        repeats("staged_events", "staged", "event_id"),
        nulls("staged_events", "staged", "event_id"),
        nulls("staged_events", "staged", "event_type"),
        checks("accepted_values", "staged_events", "event_type", "warn", strange),
        repeats("repo_daily_stats", "repo_daily", "surrogate_key"),
        nulls("repo_daily_stats", "repo_daily", "surrogate_key"),
        nulls("repo_daily_stats", "repo_daily", "repo_id", "warn"),
        repeats("developer_activity", "activity", "surrogate_key"),
        nulls("developer_activity", "activity", "surrogate_key"),
        nulls("developer_activity", "activity", "actor_id"),
        nulls("pr_labels", "pr_labels", "event_id"),
        nulls("pr_labels", "pr_labels", "label_name"),
        nulls("trending_repos", "trending", "repo_id"),
        nulls("trending_repos", "trending", "repo_name"),
        nulls("trending_repos", "trending", "date_day"),
        nulls("contributor_retention", "retention", "cohort_month"),
        nulls("category_trends", "trends", "date_day"),
        nulls("category_trends", "trends", "event_category"),
        nulls("label_usage", "label_usage", "date_day"),
        nulls("label_usage", "label_usage", "label_name"),
    ]
    return f"WITH {with_all} " + " UNION ALL ".join(parts)


def _by_day() -> str:
    """The checks of every delivery, and of the labels in them."""
    strange = f"SELECT count(DISTINCT event_type) AS failures FROM staged WHERE event_type NOT IN ({ACCEPTED})"
    parts = [
        repeats("staged_events", "staged", "event_id"),
        nulls("staged_events", "staged", "event_id"),
        nulls("staged_events", "staged", "event_type"),
        checks("accepted_values", "staged_events", "event_type", "warn", strange),
        nulls("pr_labels", "pr_labels", "event_id"),
        nulls("pr_labels", "pr_labels", "label_name"),
    ]
    every = LABELS.replace("WHERE NOT again)", ")")
    return f"WITH {every} " + " UNION ALL ".join(parts)


def over(tables: str, select: str) -> str:
    return f"WITH {tables.strip()}\n{select}"


ORACLES: dict[str, str] = {
    "raw_json_scan": over(
        DELIVERIES,
        """SELECT event_id, event_type, actor_id, actor_login, repo_id, repo_name, action, pr_number,
 date_trunc('second', created_at) AS created_at FROM deliveries WHERE n % 97 <> 0 AND n % 89 <> 5""",
    ),
    "load_report": over(
        DELIVERIES,
        """SELECT strftime(created_at, 'year=%Y/month=%m/day=%d/hour=%H') AS source_hour,
 CASE WHEN early THEN 'ALREADY_LOADED' ELSE 'SUCCESS' END AS status,
 count(*) FILTER (WHERE NOT early AND n % 97 <> 0 AND n % 89 <> 5) AS rows_loaded,
 count(*) FILTER (WHERE NOT early AND (n % 97 = 0 OR n % 89 = 5)) AS errors_seen
 FROM (SELECT *, created_at < (SELECT date_trunc('day', max(ts)) FROM events) AS early FROM deliveries)
 GROUP BY source_hour, early""",
    ),
    "backfill_result": over(
        f"""{DELIVERIES},
filed AS (
  SELECT * REPLACE (date_trunc('second', created_at) AS created_at),
         created_at + INTERVAL 1 HOUR * (CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END) >= cut.day AS late
  FROM deliveries, (SELECT date_trunc('day', max(ts)) - INTERVAL 1 DAY AS day FROM events) AS cut
  WHERE n % 97 <> 0 AND n % 89 <> 5),
first AS (
  SELECT *, row_number() OVER (PARTITION BY event_id, late ORDER BY created_at) AS place FROM filed),
kept AS (SELECT * FROM first WHERE place = 1)""",
        f"""SELECT {SCALARS} FROM kept WHERE NOT late
 OR event_id NOT IN (SELECT event_id FROM kept WHERE NOT late)""",
    ),
    "unloaded_files": """WITH paths AS (
 SELECT ts, strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H/%Y-%m-%d-') || hour(ts)
        || '.json.gz' AS source_file FROM events)
SELECT DISTINCT source_file FROM paths WHERE source_file NOT IN
 (SELECT source_file FROM paths
  WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events))""",
    "hour_spine": f"""WITH bounds AS (SELECT min(ts) AS first, max(ts) AS last FROM events),{SPINE}
SELECT hour, hour_key, path FROM spine""",
    "missing_hours": f"""WITH bounds AS (
 SELECT min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders),{SPINE}
SELECT hour, hour_key, path FROM spine WHERE hour NOT IN
 (SELECT date_trunc('hour', o_orderdate) FROM orders)""",
    "stage_events": over(
        STAGED,
        f"""SELECT {SCALARS}, '{{"action":"' || action || '","labels":['
 || array_to_string(list_transform(range(CAST(n % 4 AS BIGINT)),
      lambda p: '{{"color":"ededed","name":' || CASE WHEN (n * 7 + p * 3) % 40 = 39 THEN 'null'
        ELSE '"label' || ((n * 7 + p * 3) % 40) || '"' END || '}}'), ',')
 || '],"pull_request":{{"number":' || pr_number || '}}}}' AS payload FROM staged""",
    ),
    "full_refresh": over(
        STAGED, f"SELECT {SCALARS}, CAST(created_at AS DATE) AS date_day FROM staged"
    ),
    "dedup_events": over(
        STAGED, "SELECT event_id AS id, event_type AS type, created_at FROM staged"
    ),
    "incremental_batch": over(SPLIT, f"SELECT {SCALARS} FROM batch"),
    "upsert_result": over(
        SPLIT,
        f"""SELECT {SCALARS}, CAST(created_at AS DATE) AS date_day FROM (
 SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM batch)
 UNION ALL SELECT * FROM batch)""",
    ),
    "upsert_random_ids": over(
        SPLIT,
        f"""SELECT {SCALARS.replace("event_id", "md5(event_id) AS event_id", 1)}, CAST(created_at AS DATE) AS date_day FROM (
 SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM batch)
 UNION ALL SELECT * FROM batch)""",
    ),
    "cdc_upsert": over(
        f"""{DELIVERIES},
first AS (
  SELECT hour(created_at) < 12 AS morning, * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY event_id, hour(created_at) < 12 ORDER BY created_at) AS place
    FROM deliveries WHERE hour(created_at) < 12 OR repo_id IS NOT NULL)
  WHERE place = 1)""",
        f"""SELECT {SCALARS} FROM first WHERE NOT morning
 OR event_id NOT IN (SELECT event_id FROM first WHERE NOT morning)""",
    ),
    "stream_upsert": over(
        f"""{DELIVERIES},
first AS (
  SELECT hour(created_at) < 12 AS morning, * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY event_id, hour(created_at) < 12 ORDER BY created_at) AS place
    FROM deliveries WHERE repo_id IS NOT NULL)
  WHERE place = 1)""",
        f"""SELECT {SCALARS} FROM first WHERE NOT morning
 OR event_id NOT IN (SELECT event_id FROM first WHERE NOT morning)""",
    ),
    "late_rejects": over(
        SPLIT,
        """SELECT event_id AS id, event_type AS type, created_at FROM deliveries
 WHERE created_at <= (SELECT since FROM bound)""",
    ),
    "event_category_counts": over(
        f"{STAGED},{EVENTS}",
        "SELECT category AS event_category, count(*) AS event_count FROM kinds GROUP BY 1",
    ),
    "pr_labels": over(PR_LABELS, "SELECT * FROM pr_labels"),
    "repo_daily_stats": over(f"{STAGED},{STATS}", "SELECT * FROM repo_daily"),
    "developer_activity": over(f"{ORDERS},{ACTIVITY}", "SELECT * FROM activity"),
    "developer_activity_events": over(f"{STAGED},{ACTIVITY}", "SELECT * FROM activity"),
    "category_daily": over(f"{STAGED},{CATEGORY_DAILY}", "SELECT * FROM category_daily"),
    "label_daily": over(LABEL_DAILY, "SELECT * FROM label_daily"),
    "rolling_7d": over(f"{STAGED},{ROLLING}", "SELECT * FROM rolling"),
    "rolling_7d_calendar": over(
        f"{LINEITEM},{rolling('RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW')}",
        "SELECT * FROM rolling",
    ),
    "first_seen_month": over(
        f"{ORDERS},{COHORTS}", "SELECT actor_id, date_day, cohort_month FROM cohorts"
    ),
    "trending_repos": over(f"{STAGED},{TRENDING}", "SELECT * FROM trending"),
    "trending_parts": over(f"{LINEITEM},{TRENDING}", "SELECT * FROM trending"),
    "cohort_retention": over(f"{ORDERS},{RETENTION}", "SELECT * FROM retention"),
    "category_trends": over(f"{STAGED},{TRENDS}", "SELECT * FROM trends"),
    "category_trends_lineitem": over(f"{LINEITEM},{TRENDS}", "SELECT * FROM trends"),
    "label_usage": over(LABELS, "SELECT * FROM label_usage"),
    "feed_trending": over(
        f"{STAGED},{TRENDING}",
        """SELECT repo_name, rolling_7d_stars, rolling_7d_forks, unique_contributors, trending_rank,
 date_day FROM trending
 WHERE date_day = (SELECT max(date_day) FROM trending) AND trending_rank <= 10""",
    ),
    "feed_trends": over(
        f"{STAGED},{TRENDS}",
        """SELECT date_day, event_category, event_count, wow_growth_rate FROM trends
 WHERE date_day >= (SELECT max(date_day) FROM trends) - 7""",
    ),
    "feed_labels": over(
        LABELS,
        """SELECT label_name, label_applied_count, unique_repos, daily_rank FROM label_usage
 WHERE date_day = (SELECT max(date_day) FROM label_usage) AND daily_rank <= 10""",
    ),
    "insight_feed": over(
        f"""{LABELS},{TRENDING},{TRENDS[len(EVENTS) + 1:]},
items AS (
  SELECT 'trending_repos' AS section, CAST(to_json(struct_pack(
           repo_name := repo_name, rolling_7d_stars := rolling_7d_stars,
           rolling_7d_forks := rolling_7d_forks, unique_contributors := unique_contributors,
           trending_rank := trending_rank, date_day := CAST(date_day AS VARCHAR))) AS VARCHAR)
           AS item
  FROM trending
  WHERE date_day = (SELECT max(date_day) FROM trending) AND trending_rank <= 10
  UNION ALL
  SELECT 'language_trends', CAST(to_json(struct_pack(
           date_day := CAST(date_day AS VARCHAR), event_category := event_category,
           event_count := event_count, wow_growth_rate := wow_growth_rate)) AS VARCHAR)
  FROM trends WHERE date_day >= (SELECT max(date_day) FROM trends) - 7
  UNION ALL
  SELECT 'label_usage', CAST(to_json(struct_pack(
           label_name := label_name, label_applied_count := label_applied_count,
           unique_repos := unique_repos, daily_rank := daily_rank)) AS VARCHAR)
  FROM label_usage
  WHERE date_day = (SELECT max(date_day) FROM label_usage) AND daily_rank <= 10)""",
        "SELECT section, item FROM items",
    ),
    "latest_insight": over(
        f"{STAGED},{TRENDING},{LOGGED}",
        """SELECT 'second briefing' AS insight_text, generated_at, 'none' AS model_used,
 first(item ORDER BY place, item) AS best, count(*) AS entries
 FROM logged WHERE minute(generated_at) = 5 GROUP BY generated_at""",
    ),
    "insight_log": over(f"{STAGED},{TRENDING},{LOGGED}", "SELECT * FROM logged"),
    "last_updated": over(STAGED, "SELECT max(created_at) AS last_updated FROM staged"),
    "available_days": over(
        f"{STAGED},{TRENDING}",
        "SELECT DISTINCT date_day FROM trending ORDER BY date_day DESC LIMIT 90",
    ),
    "trending_for_day": over(
        f"{STAGED},{TRENDING}",
        """SELECT repo_name, rolling_7d_stars, rolling_7d_forks, unique_contributors, trending_rank
 FROM trending
 WHERE date_day = (SELECT max(date_day) FROM trending) - 7 AND trending_rank <= 20""",
    ),
    "trends_30d": over(
        f"{STAGED},{TRENDS}",
        """SELECT date_day, event_category, event_count, wow_growth_rate FROM trends
 WHERE date_day >= (SELECT max(date_day) FROM trends) - 30""",
    ),
    "growth_points": over(
        f"{STAGED},{TRENDS}",
        """SELECT date_day, event_category, event_count, wow_growth_rate FROM trends
 WHERE date_day >= (SELECT max(date_day) FROM trends) - 30 AND wow_growth_rate IS NOT NULL""",
    ),
    "labels_latest": over(
        LABELS,
        """SELECT label_name, label_applied_count, unique_repos, daily_rank FROM label_usage
 WHERE date_day = (SELECT max(date_day) FROM label_usage) AND daily_rank <= 20""",
    ),
    "labels_chart": over(
        LABELS,
        """SELECT label_name, label_applied_count FROM label_usage
 WHERE date_day = (SELECT max(date_day) FROM label_usage) AND daily_rank <= 20""",
    ),
    "marts_after_increment": over(ALL_MARTS.replace(STAGED, UPSERTED), MART_ROWS),
    "marts_after_old_day": over(ALL_MARTS, MART_ROWS),
    "retention_after_retraction": over(
        f"""{ORDERS.replace("o_orderdate AS created_at", "date_trunc('month', o_orderdate) AS created_at")},{RETENTION}""",
        "SELECT * FROM retention",
    ),
    "rebuilt_marts": over(LABELS, "SELECT * FROM label_usage"),
    "stream_dedup": over(STAGED, "SELECT event_id FROM staged"),
    "dq_not_null": over(
        STAGED,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS failures FROM staged WHERE {c} IS NULL"
            for c in SCALARS.split(", ")
        ),
    ),
    "dq_unique": over(
        DELIVERIES,
        """SELECT 'id' AS "column", count(*) AS failures FROM
 (SELECT event_id FROM deliveries GROUP BY event_id HAVING count(*) > 1)""",
    ),
    "dq_accepted_values": """SELECT 'event_type' AS "column", count(DISTINCT event_type) AS failures
 FROM events WHERE event_type NOT IN
 ('WatchEvent', 'PushEvent', 'ForkEvent', 'IssuesEvent', 'PullRequestEvent')""",
    "dq_report": _report(),
    "dq_by_day": _by_day(),
    "dq_freshness": over(
        DELIVERIES,
        """SELECT max_loaded_at, as_of,
 CAST(floor((epoch_us(as_of) - epoch_us(max_loaded_at)) / 1000000) AS BIGINT) AS age_seconds,
 CASE WHEN as_of - INTERVAL 6 HOUR > max_loaded_at THEN 'error'
      WHEN as_of - INTERVAL 2 HOUR > max_loaded_at THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max_loaded_at,
             max_loaded_at + INTERVAL 1 HOUR * hours + INTERVAL 1 MICROSECOND * late AS as_of
      FROM (SELECT max(created_at) AS max_loaded_at FROM deliveries),
           (VALUES (0), (2), (4), (6)) AS h(hours), (VALUES (0), (500000)) AS l(late))""",
    ),
}
