import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import cache, overview

SCOPE = {"team_id": "t1", "project_id": "p1", "time_period": "2025-Q2"}


@pytest.fixture
def scores(spark):
    data = []
    for team, people, means in [("t1", 18, (4.2, 3.8, 3.9, 3.5)), ("t2", 12, (3.6, 3.3, 3.4, 3.1)), ("t3", 3, (4.0, 4.0, 4.0, 4.0))]:
        for (cat, q), m in zip([("Basic Needs", 2), ("Individual", 4), ("Teamwork", 4), ("Growth", 2)], means):
            data.append((team, "p1", "2025-Q2", cat, m, q, people, 0.9, 3.72))
    return spark.createDataFrame(data, "team_id string, project_id string, time_period string, category string, mean_score double, question_count int, response_count int, response_rate double, benchmark double")


@pytest.fixture
def overviews(spark, scores):
    teams = spark.createDataFrame([("t1", "Alpha"), ("t2", "Beta")], "team_id string, team_name string")
    projects = spark.createDataFrame([("p1", "Phoenix")], "project_id string, project_name string")
    return overview.team_overview(scores, teams, projects, F.lit("2025-07-01 06:00:00").cast("timestamp"))


def test_overall_is_weighted_by_question_count(overviews, rows):
    got = rows(overviews, "team_id", "team_name", "overall_score", "status")
    assert got == [("t1", "Alpha", 3.85, "ok"), ("t2", "Beta", 3.35, "ok"), ("t3", "t3", None, "suppressed")]
    cats = overviews.filter("team_id = 't1'").first().category_scores
    assert [c.category for c in cats] == ["Basic Needs", "Growth", "Individual", "Teamwork"]


def test_flag_mode_keeps_the_score(scores, spark):
    empty = spark.createDataFrame([], "team_id string, team_name string")
    out = overview.team_overview(scores, empty, spark.createDataFrame([], "project_id string, project_name string"), mode="flag")
    assert out.filter("team_id = 't3'").first().overall_score == 4.0


def test_status_priority(spark, overviews):
    ask = [(1, "u", "t1"), (2, "u", "t3"), (3, "u", "t9"), (4, "x", "t1"), (5, "x", "t9")]
    requests = spark.createDataFrame([(i, u, t, "p1", "2025-Q2") for i, u, t in ask], "id int, user_id string, team_id string, project_id string, time_period string")
    may = spark.createDataFrame([("u", "t1"), ("u", "t3"), ("u", "t9")], "user_id string, team_id string")
    run = lambda now, age: {r.id: (r.status, r.overall_score) for r in overview.resolve_status(requests, overviews, may, F.lit(now).cast("timestamp"), age).collect()}
    got = run("2025-07-02 00:00:00", "7 DAY")
    assert got == {1: ("ok", 3.85), 2: ("suppressed", None), 3: ("no_data", None), 4: ("not_entitled", None), 5: ("not_entitled", None)}
    assert run("2025-09-01 00:00:00", "7 DAY")[1] == ("stale_cache", 3.85)


def test_default_scope_rules(spark, rows):
    members = spark.createDataFrame(
        [("u1", "t1", "Alpha", "manager"), ("u1", "t2", "Beta", "member"), ("u2", "t2", "Beta", "manager"), ("u3", "t3", "Gamma", "member"), ("u4", "t1", "Alpha", "member"), ("u4", "t2", "Beta", "member"),
         ("u5", "t1", "Alpha", "manager"), ("u5", "t2", "Beta", "manager")], "user_id string, team_id string, team_name string, role string")
    projects = spark.createDataFrame([("p1", "Phoenix", "2025-Q2"), ("p2", "Atlas", "2025-Q1")], "project_id string, project_name string, latest_period string")
    got = rows(overview.resolve_scopes(members, projects), "user_id", "team_id", "project_id", "is_resolved")
    assert got == [("u1", "t1", "p1", True), ("u2", "t2", "p1", True), ("u3", "t3", "p1", True), ("u4", None, None, False), ("u5", None, None, False)]
    assert [r.project_id for r in overview.active_projects(projects).collect()] == ["p1", "p2"]
    assert [r.team_id for r in overview.user_teams(members, "u1").collect()] == ["t1", "t2"]
    assert rows(overview.resolve_scopes(members, projects.limit(0)), "is_resolved") == [(False,)] * 5


@pytest.fixture
def answers(spark):
    rng = random.Random(5)
    return spark.createDataFrame([("t1", f"r{i}", "NY" if i % 3 else "LA", f"Q{q:02d}", "Growth" if q > 2 else "Basic Needs", rng.randrange(1, 6)) for i in range(40) for q in range(1, 5)],
                                 "team string, person string, city string, q string, cat string, s int")


def test_shapes_grow_and_are_rated(answers):
    shapes = {
        "A": overview.shape_overview(answers, ["team"], "q", "cat", "s"),
        "B": overview.shape_detailed(answers, ["team"], "q", "cat", "s"),
        "C": overview.shape_dimensional(answers, ["team"], "q", "cat", "s", ["city"]),
        "D": overview.shape_raw(answers, ["team"], "person", ["city"], "q", "s", ["Q01", "Q02", "Q03", "Q04"]),
    }
    report = {r["shape"]: r for r in overview.payload_report(shapes, ["team"]).collect()}
    assert report["A"].size_bytes < report["B"].size_bytes < report["D"].size_bytes
    assert report["A"].rating == "Excellent"
    assert shapes["D"].count() == 40
    assert all(r.est_tokens == r.size_bytes // 4 for r in report.values())
    assert [q.question for q in shapes["B"].first().questions] == ["Q01", "Q02", "Q03", "Q04"]


def test_whole_documents_carry_their_scope(spark, answers):
    scopes = spark.createDataFrame([("t1", "Team é", "P", "2025-Q2", 40, 0.5, 3.1)], "team string, name string, project string, period string, response_count int, response_rate double, benchmark double")
    rows = answers.withColumnRenamed("team", "id")
    scopes = scopes.withColumnRenamed("team", "id").withColumnRenamed("name", "team")
    docs = overview.whole_documents(rows, scopes, ["id"], "q", "cat", "s", ["city"])
    heads = {name[0]: [c for c in d.columns if c != "_id"] for name, d in docs.items()}
    assert heads["A"] == ["team", "project", "period", "overall_score", "response_count", "response_rate", "benchmark", "categories"]
    assert heads["B"] == heads["C"] == ["team", "project", "period", "response_count", "categories"]
    assert heads["D"] == ["team", "project", "period", "responses"]
    b = docs["B detailed"].first()
    assert [(c.category, [q.question for q in c.questions]) for c in b.categories] == [("Basic Needs", ["Q01", "Q02"]), ("Growth", ["Q03", "Q04"])]
    c = docs["C dimensional"].first().categories[0].questions[0]
    assert [(x.dimension, x.value) for x in c.slices] == [("city", "LA"), ("city", "NY")] and sum(x["count"] for x in c.slices) == 40

    raw = overview.shape_raw(rows, ["id"], "person", ["city"], "q", "s", ["Q01", "Q02"]).withColumnRenamed("id", "_id")
    report = {r["shape"]: r for r in overview.payload_report(docs, ["_id"], {"D raw": raw}).collect()}
    members = [r.asDict() for r in raw.drop("_id").collect()]
    whole = json.dumps({"team": "Team é", "project": "P", "period": "2025-Q2", "responses": members}, separators=(",", ":"), ensure_ascii=False)
    assert report["D raw"].size_bytes == len(whole.encode()) == len(whole) + 1 and report["D raw"].est_tokens == len(whole) // 4
    a = docs["A overview"].drop("_id").first().asDict(recursive=True)
    assert report["A overview"].size_bytes == len(json.dumps(a, separators=(",", ":"), ensure_ascii=False).encode())


def replay(log, ttl):
    """Plain replay of one cache: (id, key, seconds) in time order."""
    loaded, out = {}, {}
    for i, key, t in sorted(log, key=lambda r: (r[2], r[0])):
        if key not in loaded:
            out[i] = "MISS"
            loaded[key] = t
        elif t - loaded[key] > ttl:
            out[i] = "EXPIRED"
            loaded[key] = t
        else:
            out[i] = "HIT"
    return out


@pytest.mark.parametrize("seed, ttl, span", [(1, 300, 40_000), (2, 60, 3_000), (3, 1000, 5_000), (4, 10, 100_000)])
def test_ttl_replay_matches_a_plain_cache(spark, seed, ttl, span):
    rng = random.Random(seed)
    log = [(i, "hot" if rng.random() < 0.5 else rng.choice("abc"), rng.randrange(0, span)) for i in range(500)]
    start = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(i, k, start + dt.timedelta(seconds=t)) for i, k, t in log], "id int, k string, ts timestamp_ntz")
    assert {r.id: r.outcome for r in cache.ttl_replay(df, "k", "ts", "id", ttl).collect()} == replay(log, ttl)


def test_conversation_of_five_calls(spark):
    start = dt.datetime(2025, 7, 1)
    calls = ["t1/Q2", "t1/Q1", "t1/Q2", "t2/Q2", "t1/Q2"]
    df = spark.createDataFrame([(i, k, start + dt.timedelta(seconds=i)) for i, k in enumerate(calls)], "id int, k string, ts timestamp_ntz")
    replayed = cache.ttl_replay(df, "k", "ts", "id", 300)
    assert [r.outcome for r in replayed.orderBy("id").collect()] == ["MISS", "MISS", "HIT", "MISS", "HIT"]
    report = cache.cache_report(replayed).first()
    assert (report.calls, report.hits, report.hit_pct) == (5, 2, 40.0)


def test_routing_falls_back_and_explains(spark, rows):
    t = "team string, m double, is_suppressed boolean"
    live = spark.createDataFrame([("a", 1.0, False), ("b", None, True), ("c", 3.0, False)], t)
    asks = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "zz")], "id int, team string")
    out = cache.route_requests(asks, live.filter("team = 'a'"), live, ["team"], "m")
    assert rows(out, "id", "tier", "m", "reason") == [(1, "serving", 1.0, None), (2, "analytical", None, "suppressed"), (3, "analytical", 3.0, None), (4, "none", None, "no_data")]
