import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.operators import daily, ranking
from tidemark.plans import marts

D = dt.date


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_rename_within_a_day_keeps_one_row(events):
    df = events(
        [
            ("1", "WatchEvent", 1, "a", 5, "old/name", "2024-01-01 01:00:00"),
            ("2", "ForkEvent", 2, "b", 5, "new/name", "2024-01-01 20:00:00"),
            ("3", "PushEvent", 2, "b2", 5, None, "2024-01-01 21:00:00"),
        ]
    )
    stats = daily.repo_daily_stats(df).collect()
    assert len(stats) == 1
    row = stats[0]
    assert (row.repo_name, row.unique_contributors, row.total_events) == ("new/name", 2, 3)
    assert (row.star_count, row.fork_count, row.code_event_count) == (1, 1, 1)
    activity = {r.actor_id: r for r in daily.developer_activity(df).collect()}
    assert activity[2].actor_login == "b2" and activity[2].code_contribution_ratio == 0.5


def test_events_without_repo_form_a_group_of_their_own(events):
    df = events([("1", "ForkEvent", 1, "a", None, None, "2024-01-01 01:00:00")] * 2)
    row = daily.repo_daily_stats(df).first()
    assert (row.repo_id, row.repo_name, row.total_events) == (None, None, 2)


def test_category_counts_sum_to_all_events(events):
    kinds = ["PushEvent", "NewEvent", None, "GollumEvent", "MemberEvent"]
    df = events(
        [(str(i), kinds[i % 5], i, "a", i, f"r{i}", "2024-01-01 01:00:00") for i in range(50)]
    )
    got = {r.event_category: r.event_count for r in daily.category_daily(df).collect()}
    assert got == {"code": 10, "other": 20, "wiki": 10, "community": 10}


def test_rolling_frame_counts_active_days_or_calendar_days(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 2), 2), (1, D(2024, 1, 10), 4)],
        "repo_id long, date_day date, stars long",
    )
    sums = {"s": "stars"}
    by_rows = ranking.rolling_sums(df, sums)
    assert rows_of(by_rows, "date_day", "s") == [
        (D(2024, 1, 1), 1), (D(2024, 1, 2), 3), (D(2024, 1, 10), 7),
    ]
    by_days = ranking.rolling_sums(df, sums, calendar=True)
    assert rows_of(by_days, "s") == [(1,), (3,), (4,)]
    edge = ranking.rolling_sums(df, sums, calendar=True, length=9)
    assert rows_of(edge, "s") == [(1,), (3,), (6,)]


def test_growth_counts_rows_not_days(spark):
    days = [1, 2, 3, 5, 6, 7, 8, 9]  # the fourth is missing
    df = spark.createDataFrame(
        [(D(2024, 1, d), "code", 10 * d) for d in days] + [(D(2024, 1, 9), "star", 0)],
        "date_day date, event_category string, event_count long",
    )
    got = {(r.event_category, r.date_day.day): r for r in marts.growth(df).collect()}
    assert got["code", 8].event_count_7d_ago is None
    assert got["code", 9].event_count_7d_ago == 10
    assert got["code", 9].wow_growth_rate == 8.0
    assert got["star", 9].wow_growth_rate is None


def brute_ranks(rows, limit):
    by_day = defaultdict(list)
    for day, value, _ in rows:
        by_day[day].append(value)
    ranked = [
        (day, value, item, 1 + sum(other > value for other in by_day[day]))
        for day, value, item in rows
    ]
    return Counter(r for r in ranked if r[3] <= limit)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_top_ranked_equals_rank_with_hot_group_and_mass_ties(spark, threshold):
    random.seed(3)
    rows = [(random.choice([1, 1, 1, 2, 3, None]), random.choice([0] * 9 + [1, 2, 5]), i)
            for i in range(600)]
    rows.append((4, 0, -1))
    df = workspace.pin(spark.createDataFrame(rows, "day long, value long, item long"), "t")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for limit in (1, 20, 200):
            got = ranking.top_ranked(df, "day", "value", limit, "place")
            got = Counter(tuple(r) for r in got.select("day", "value", "item", "place").collect())
            assert got == brute_ranks(rows, limit)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fewer_starred_than_the_limit_lets_all_ties_in(events):
    df = events(
        [(str(i), "WatchEvent" if i < 3 else "PushEvent", 1, "a", i, f"r{i}", "2024-01-01 01:00:00")
         for i in range(30)]
    )
    got = Counter(r.trending_rank for r in marts.trending_repos(df, limit=5).collect())
    assert got == {1: 3, 4: 27}
    got = Counter(r.trending_rank for r in marts.trending_repos(df, limit=3).collect())
    assert got == {1: 3}


def test_retention_of_null_actors(events):
    df = events(
        [
            ("1", "PushEvent", None, None, 1, "r", "2024-01-05 01:00:00"),
            ("2", "PushEvent", None, None, 1, "r", "2024-03-05 01:00:00"),
            ("3", "PushEvent", 7, "x", 1, "r", "2024-02-05 01:00:00"),
            ("4", "WatchEvent", 7, "x", 1, "r", "2024-02-29 01:00:00"),
            ("5", "WatchEvent", 8, "y", 1, "r", "2024-02-29 01:00:00"),
            ("6", "PushEvent", 7, "x", 1, "r", "2025-02-01 01:00:00"),
        ]
    )
    got = rows_of(
        marts.contributor_retention(df),
        "cohort_month", "activity_month", "months_since_first", "cohort_size",
        "retained_contributors", "retention_rate", "total_code_contributions",
    )
    assert got == [
        (D(2024, 1, 1), D(2024, 1, 1), 0, 0, 0, None, 1),
        (D(2024, 1, 1), D(2024, 3, 1), 2, 0, 0, None, 1),
        (D(2024, 2, 1), D(2024, 2, 1), 0, 2, 2, 1.0, 1),
        (D(2024, 2, 1), D(2025, 2, 1), 12, 2, 1, 0.5, 1),
    ]


def label_event(number, labels, action="labeled", kind="PullRequestEvent", pr=5):
    payload = {"action": action, "pull_request": {"number": pr}}
    if labels != "missing":
        payload["labels"] = labels
    return {"id": str(number), "type": kind, "payload": payload, "repo": {"id": 1, "name": "r"},
            "at": "2024-01-01 01:00:00"}


def test_label_edge_cases(raw):
    from tidemark.plans.staging import stage_events

    rows = [
        label_event(1, "missing"),
        label_event(2, []),
        label_event(3, None),
        label_event(4, "text"),
        label_event(5, [None, {"color": "red"}, {"name": None}, {"name": "bug"}], pr=5.7),
        label_event(6, [{"name": "bug", "color": "red"}], action="opened"),
        label_event(7, [{"name": "bug", "color": "red"}], kind="IssuesEvent"),
        label_event(8, {"name": "in an object"}),
        label_event(9, [{"name": "bug"}, {"name": "bug"}], pr="12"),
    ]
    labels = daily.pr_labels(stage_events(raw(rows)))
    got = sorted(
        (r.event_id, -1 if r.label_position is None else r.label_position, r.label_name or "",
         r.label_color or "", r.pr_number)
        for r in labels.collect()
    )
    assert got == [
        ("5", 0, "", "", 5), ("5", 1, "", "red", 5), ("5", 2, "", "", 5), ("5", 3, "bug", "", 5),
        ("8", -1, "", "", 5),
        ("9", 0, "bug", "", 12), ("9", 1, "bug", "", 12),
    ]
    usage = {r.label_name: r for r in daily.label_daily(labels).collect()}
    assert (usage["bug"].label_applied_count, usage["bug"].unique_prs) == (3, 2)


def test_marts_match_brute_force_on_skewed_events(events):
    """A third of the rows in one repo, one actor and one day."""
    random.seed(11)
    kinds = ["WatchEvent", "ForkEvent", "PushEvent", "IssuesEvent", "ReleaseEvent"]
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        repo = 1 if hot else random.randint(2, 40)
        actor = 1 if hot else random.randint(2, 30)
        day = 3 if hot else random.randint(1, 12)
        rows.append((str(i), random.choice(kinds), actor, f"u{actor}", repo, f"r{repo}",
                     f"2024-01-{day:02d} {random.randint(0, 23):02d}:00:00"))
    stars, actors = Counter(), defaultdict(set)
    days = defaultdict(set)
    for _, kind, actor, _, repo, _, at in rows:
        day = D.fromisoformat(at[:10])
        stars[repo, day] += kind == "WatchEvent"
        actors[repo, day].add(actor)
        days[repo].add(day)
    rolled = {}
    for repo, active in days.items():
        active = sorted(active)
        for i, day in enumerate(active):
            rolled[repo, day] = sum(stars[repo, d] for d in active[max(0, i - 6): i + 1])
    expected = Counter()
    for (repo, day), value in rolled.items():
        place = 1 + sum(v > value for (_, d), v in rolled.items() if d == day)
        if place <= 10:
            expected[repo, day, stars[repo, day], value, len(actors[repo, day]), place] += 1
    got = marts.trending_repos(events(rows), limit=10).select(
        "repo_id", "date_day", "star_count", "rolling_7d_stars", "unique_contributors",
        "trending_rank",
    )
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_trailing_days_are_inclusive(spark):
    df = spark.range(60).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date_day")
    )
    assert ranking.trailing_days(df, 7).count() == 8
    assert ranking.trailing_days(df, 30).count() == 31
    assert ranking.at_latest(df).collect()[0][0] == D(2024, 2, 29)
