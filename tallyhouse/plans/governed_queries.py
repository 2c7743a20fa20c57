"""Governed results: overviews, request status, scopes, shapes, cache replay, routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish
from tallyhouse.operators import cache, overview
from tallyhouse.operators.privacy import suppress
from tallyhouse.plans.catalog import pub, query, with_survey
from tallyhouse.session import pin, scratch_path
from tallyhouse.sources.files import materialize
from tallyhouse.sources.survey import survey, table, teams

# ---- overviews --------------------------------------------------------------

_PERIOD = "CAST(year AS VARCHAR) || '-Q' || CAST(quarter AS VARCHAR)"
_K = 12


def category_scores(spark, sf):
    """Category means per team, project and period, with the scope's people, response rate and benchmark.

    Rows collapse once to (scope, category, question, person) cells, which are
    stored; everything else is derived from them.
    """
    period = F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string"))
    rows = materialize(
        survey(spark, sf)
        .groupBy("team_id", F.col("project").alias("project_id"), period.alias("time_period"), "category", "question_no", "respondent_id")
        .agg(F.sum("score").alias("score_sum"), F.count("score").alias("score_count"), F.max("submitted_at").alias("submitted_at")),
        scratch_path(spark, "answers"),
    )
    mean_score = publish(F.sum("score_sum") / F.sum("score_count"))
    scope = ["team_id", "project_id", "time_period"]
    cells = rows.groupBy(*scope, "category").agg(
        mean_score.alias("mean_score"), F.countDistinct("question_no").alias("question_count")
    )
    people = rows.groupBy(*scope).agg(F.countDistinct("respondent_id").alias("response_count"), F.max("submitted_at").alias("freshness"))
    invited = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("team_id"), F.col("c_mktsegment").alias("project_id")).agg(
        F.count(F.lit(1)).alias("invited")
    )
    bench = rows.groupBy("time_period").agg(mean_score.alias("benchmark"))
    return (
        cells.join(people, scope)
        .join(invited, ["team_id", "project_id"])
        .join(bench, "time_period")
        .withColumn("response_rate", F.col("response_count") / F.col("invited"))
        .drop("invited")
    )


def overviews(spark, sf):
    scores = pin(category_scores(spark, sf))
    fresh = scores.groupBy(*overview.SCOPE).agg(F.max("freshness").alias("freshness"))
    projects = table(spark, sf, "customer").filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_mktsegment").alias("project_id"), F.concat(F.lit("Project "), F.lower("c_mktsegment")).alias("project_name")
    ).distinct()
    records = overview.team_overview(scores, teams(spark, sf), projects, k=_K)
    return records.drop("freshness").join(fresh, list(overview.SCOPE))


_CELLS = f"""
, p AS (SELECT *, {_PERIOD} AS time_period FROM survey)
, cells AS (SELECT team_id, project AS project_id, time_period, category, {pub('AVG(score)')} AS mean_score, COUNT(DISTINCT question_no) AS question_count FROM p GROUP BY ALL)
, people AS (SELECT team_id, project AS project_id, time_period, COUNT(DISTINCT respondent_id) AS response_count, MAX(submitted_at) AS freshness FROM p GROUP BY team_id, project, time_period)
, invited AS (SELECT c_nationkey AS team_id, c_mktsegment AS project_id, COUNT(*) AS invited FROM customer GROUP BY ALL)
, bench AS (SELECT time_period, {pub('AVG(score)')} AS benchmark FROM p GROUP BY time_period)
, records AS (SELECT c.team_id, c.project_id, c.time_period, {pub('SUM(c.mean_score * c.question_count) / SUM(c.question_count)')} AS overall_score,
       COUNT(*) AS categories, STRING_AGG(c.category, ',' ORDER BY c.category) AS category_names, MAX(pe.response_count) AS response_count,
       {pub('CAST(MAX(pe.response_count) AS DOUBLE) / MAX(i.invited)', 4)} AS response_rate, MAX(b.benchmark) AS benchmark, MAX(pe.freshness) AS freshness
  FROM cells c JOIN people pe USING (team_id, project_id, time_period) JOIN invited i USING (team_id, project_id) JOIN bench b USING (time_period)
  GROUP BY c.team_id, c.project_id, c.time_period)
, ov AS (SELECT r.team_id, r.project_id, r.time_period, n.n_name AS team_name,
       CASE WHEN r.project_id = 'MACHINERY' THEN r.project_id ELSE 'Project ' || LOWER(r.project_id) END AS project_name,
       CASE WHEN response_count >= {_K} THEN overall_score END AS overall_score,
       CASE WHEN response_count >= {_K} THEN category_names END AS category_names,
       CASE WHEN response_count >= {_K} THEN CAST(categories AS INT) END AS categories,
       response_count, response_rate, benchmark, freshness, response_count < {_K} AS suppressed,
       CASE WHEN response_count < {_K} THEN 'suppressed' ELSE 'ok' END AS status
  FROM records r JOIN nation n ON n.n_nationkey = r.team_id)
"""


@query("team_overview_flat", with_survey(_CELLS + "SELECT * FROM ov"))
def team_overview_flat(spark, sf):
    out = overviews(spark, sf)
    names = F.array_join(F.transform("category_scores", lambda c: c.category), ",")
    return out.withColumns({"category_names": names, "categories": F.when(F.col("category_scores").isNotNull(), F.size("category_scores"))}).drop("category_scores")


def _requests(spark, sf):
    """Events read as requests for an overview; some ask for teams that do not exist."""
    names = F.array(*[F.lit(s) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])
    n = F.col("event_id")
    return table(spark, sf, "events").select(
        n.alias("request_id"),
        "user_id",
        (n % 27).cast("int").alias("team_id"),
        F.element_at(names, (n % 5 + 1).cast("int")).alias("project_id"),
        F.concat((F.lit(1995) + n % 7).cast("string"), F.lit("-Q"), (n % 4 + 1).cast("string")).alias("time_period"),
    )


_REQUESTS = """
, requests AS (SELECT event_id AS request_id, user_id, CAST(event_id % 27 AS INT) AS team_id,
   (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[CAST(event_id % 5 + 1 AS INT)] AS project_id,
   CAST(1995 + event_id % 7 AS VARCHAR) || '-Q' || CAST(event_id % 4 + 1 AS VARCHAR) AS time_period FROM events)
"""


@query("scope_status", with_survey(_CELLS + _REQUESTS + """
, entitled AS (SELECT DISTINCT user_id, CAST(event_id % 27 AS INT) AS team_id FROM events WHERE event_type IN ('purchase', 'signup'))
, judged AS (SELECT r.*, o.overall_score AS v, o.response_count AS n,
   CASE WHEN e.user_id IS NULL THEN 'not_entitled' WHEN o.team_id IS NULL THEN 'no_data' WHEN o.suppressed THEN 'suppressed'
        WHEN o.freshness < TIMESTAMP '2001-01-01 00:00:00' - INTERVAL 900 DAY THEN 'stale_cache' ELSE 'ok' END AS status
   FROM requests r LEFT JOIN entitled e ON e.user_id = r.user_id AND e.team_id = r.team_id LEFT JOIN ov o ON o.team_id = r.team_id AND o.project_id = r.project_id AND o.time_period = r.time_period)
SELECT request_id, user_id, team_id, project_id, time_period, status, CASE WHEN status IN ('ok', 'stale_cache') THEN v END AS overall_score,
       CASE WHEN status <> 'not_entitled' THEN COALESCE(n, 0) END AS response_count FROM judged"""))
def scope_status(spark, sf):
    requests = _requests(spark, sf)
    entitled = (
        table(spark, sf, "events").filter(F.col("event_type").isin("purchase", "signup"))
        .select("user_id", (F.col("event_id") % 27).cast("int").alias("team_id")).distinct()
    )
    now = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")
    return overview.resolve_status(requests, overviews(spark, sf), entitled, now, "900 DAY")


def _memberships(spark, sf):
    """Customers as users, the nations they bought from as teams, urgent orders as management."""
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), (F.col("o_orderkey") % 25).cast("int").alias("team_id"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent")
    )
    per_team = rows.groupBy("user_id", "team_id").agg(F.max("urgent").alias("m"))
    named = per_team.join(teams(spark, sf).select("team_id", "team_name"), "team_id")
    return named.select("user_id", "team_id", "team_name", F.when(F.col("m"), "manager").otherwise("member").alias("role"))


def _projects(spark, sf):
    seen = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    period = F.concat(F.year("o_orderdate").cast("string"), F.lit("-Q"), F.quarter("o_orderdate").cast("string"))
    return seen.groupBy(F.col("c_mktsegment").alias("project_id")).agg(F.max(period).alias("latest_period")).withColumn(
        "project_name", F.concat(F.lit("Project "), F.lower("project_id"))
    )


_MEMBERS = """
WITH members AS (SELECT o.user_id, o.team_id, n.n_name AS team_name, o.role FROM (
   SELECT o_custkey AS user_id, CAST(o_orderkey % 25 AS INT) AS team_id, CASE WHEN BOOL_OR(o_orderpriority = '1-URGENT') THEN 'manager' ELSE 'member' END AS role
   FROM orders GROUP BY 1, 2) o JOIN nation n ON n.n_nationkey = o.team_id),
projects AS (SELECT c_mktsegment AS project_id, 'Project ' || LOWER(c_mktsegment) AS project_name,
   MAX(CAST(YEAR(o_orderdate) AS VARCHAR) || '-Q' || CAST(QUARTER(o_orderdate) AS VARCHAR)) AS latest_period
   FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)
"""


@query("default_scopes", _MEMBERS + """
, u AS (SELECT user_id, COUNT(*) AS n, COUNT(CASE WHEN role = 'manager' THEN 1 END) AS m, MAX(CASE WHEN role = 'manager' THEN team_id END) AS mt, MAX(team_id) AS t FROM members GROUP BY user_id),
c AS (SELECT user_id, CASE WHEN m = 1 THEN mt WHEN n = 1 THEN t END AS team_id FROM u),
p AS (SELECT * FROM projects ORDER BY latest_period DESC, project_id DESC LIMIT 1)
SELECT c.user_id, c.team_id, n.n_name AS team_name, CASE WHEN c.team_id IS NOT NULL THEN p.project_id END AS project_id,
       CASE WHEN c.team_id IS NOT NULL THEN p.project_name END AS project_name, CASE WHEN c.team_id IS NOT NULL THEN p.latest_period END AS time_period,
       c.team_id IS NOT NULL AS is_resolved FROM c CROSS JOIN p LEFT JOIN nation n ON n.n_nationkey = c.team_id""")
def default_scopes(spark, sf):
    return overview.resolve_scopes(_memberships(spark, sf), _projects(spark, sf))


@query("user_teams", _MEMBERS + "SELECT team_id, team_name, role FROM members WHERE user_id = 7")
def user_teams(spark, sf):
    return overview.user_teams(_memberships(spark, sf), 7)


@query("active_projects", _MEMBERS + "SELECT project_id, latest_period, project_name FROM projects")
def active_projects(spark, sf):
    return overview.active_projects(_projects(spark, sf))


# ---- shapes -----------------------------------------------------------------


@query("shape_overview", with_survey(f"""
, q AS (SELECT team_id, category, question_no, {pub('AVG(score)')} AS m FROM survey GROUP BY ALL)
, c AS (SELECT team_id, category, {pub('AVG(m)')} AS m, COUNT(*) AS n FROM q GROUP BY team_id, category)
, o AS (SELECT team_id, {pub('SUM(m * n) / SUM(n)')} AS overall_score FROM c GROUP BY team_id)
SELECT q.team_id, o.overall_score, q.category, c.m AS category_mean, q.question_no, q.m AS question_mean FROM q JOIN c USING (team_id, category) JOIN o USING (team_id)"""))
def shape_overview(spark, sf):
    """The nested overview, flattened back to check every level of it."""
    nested = overview.shape_overview(survey(spark, sf), ["team_id"], "question_no", "category", "score")
    cats = nested.select("team_id", "overall_score", F.explode("categories").alias("c"))
    rows = cats.select("team_id", "overall_score", F.col("c.category").alias("category"), F.col("c.mean_score").alias("category_mean"), F.explode("c.questions").alias("q"))
    return rows.select("team_id", "overall_score", "category", "category_mean", F.col("q.question").alias("question_no"), F.col("q.mean_score").alias("question_mean"))


@query("shape_detailed", with_survey(f"""
SELECT team_id, category, question_no, {pub('AVG(score)')} AS mean_score, {pub('STDDEV_POP(score)')} AS std_dev, COUNT(score) AS response_count,
       COUNT(CASE WHEN score = 5 THEN 1 END) AS fives FROM survey GROUP BY team_id, category, question_no"""))
def shape_detailed(spark, sf):
    nested = overview.shape_detailed(survey(spark, sf), ["team_id"], "question_no", "category", "score")
    rows = nested.select("team_id", F.explode("questions").alias("q"))
    return rows.select(
        "team_id", "q.category", F.col("q.question").alias("question_no"), "q.mean_score", "q.std_dev", "q.response_count",
        F.element_at("q.distribution", F.lit("5")).alias("fives"),
    )


@query("shape_dimensional", with_survey(f"""
, long AS (SELECT team_id, category, question_no, score, 'project' AS dimension, project AS value FROM survey UNION ALL
  SELECT team_id, category, question_no, score, 'location', location FROM survey)
SELECT team_id, category, question_no, dimension, value, {pub('AVG(score)')} AS mean_score, COUNT(score) AS response_count FROM long GROUP BY ALL"""))
def shape_dimensional(spark, sf):
    nested = overview.shape_dimensional(survey(spark, sf), ["team_id"], "question_no", "category", "score", ["project", "location"])
    rows = nested.select("team_id", "category", "question_no", F.explode("slices").alias("s"))
    return rows.select("team_id", "category", "question_no", "s.dimension", "s.value", "s.mean_score", "s.response_count")


@query("shape_raw", with_survey("SELECT team_id, respondent_id, project, " + ", ".join(
    f"MAX(CASE WHEN question_no = {q} THEN score END) AS q{q}" for q in range(1, 13)) + " FROM survey GROUP BY team_id, respondent_id, project"))
def shape_raw(spark, sf):
    return overview.shape_raw(survey(spark, sf), ["team_id"], "respondent_id", ["project"], "question_no", "score", range(1, 13))


_DOC_KEYS = ["team_id", "project_id", "time_period"]
_HEAD = "'team': team_name, 'project': project_id, 'period': time_period"
_COUNTS = "{" + ", ".join(f"'{v}': COUNT(*) FILTER (score = {v})" for v in range(1, 6)) + "}"
_SCOPE_SQL = "team_id, project_id, time_period"
_ANSWERS = ", ".join(f"'q{q}': MAX(score) FILTER (question_no = {q})" for q in range(1, 13))
_DOCUMENTS = f"""
, p AS (SELECT *, project AS project_id, {_PERIOD} AS time_period FROM survey)
, invited AS (SELECT c_nationkey AS team_id, c_mktsegment AS project_id, COUNT(*) AS invited FROM customer GROUP BY ALL)
, bench AS (SELECT time_period, {pub('AVG(score)')} AS benchmark FROM p GROUP BY time_period)
, scopes AS (SELECT {_SCOPE_SQL}, MAX(team_name) AS team_name, COUNT(DISTINCT respondent_id) AS people,
       {pub('CAST(COUNT(DISTINCT respondent_id) AS DOUBLE) / MAX(invited)')} AS rate, MAX(benchmark) AS benchmark
  FROM p JOIN invited USING (team_id, project_id) JOIN bench USING (time_period) GROUP BY {_SCOPE_SQL})
, q AS (SELECT {_SCOPE_SQL}, category, question_no, {pub('AVG(score)')} AS m, {pub('STDDEV_POP(score)')} AS sd, LIST_SORT(LIST(score)) AS s, COUNT(*) AS n,
       {_COUNTS} AS spread, {pub('100.0 * COUNT(*) FILTER (score >= 4) / COUNT(*)', 1)} AS up, {pub('100.0 * COUNT(*) FILTER (score <= 2) / COUNT(*)', 1)} AS down
  FROM p GROUP BY {_SCOPE_SQL}, category, question_no)
, ca AS (SELECT {_SCOPE_SQL}, category, {pub('AVG(m)')} AS m, COUNT(*) AS n, LIST({{'question': question_no, 'mean_score': m}}) AS qs,
       LIST({{'question': question_no, 'mean': m, 'median': s[n // 2 + 1], 'std_dev': sd, 'p25': s[n // 4 + 1], 'p75': s[3 * n // 4 + 1], 'min': s[1], 'max': s[n],
              'distribution': spread, 'favorable_pct': up, 'unfavorable_pct': down}}) AS ds FROM q GROUP BY {_SCOPE_SQL}, category)
, a AS (SELECT {_SCOPE_SQL}, {pub('SUM(m * n) / SUM(n)')} AS overall, LIST({{'category': category, 'mean_score': m, 'questions': qs}}) AS cs, LIST({{'category': category, 'questions': ds}}) AS bs FROM ca GROUP BY {_SCOPE_SQL})
, long AS (SELECT {_SCOPE_SQL}, category, question_no, score, 'location' AS dimension, location AS value FROM p UNION ALL SELECT {_SCOPE_SQL}, category, question_no, score, 'department', department FROM p)
, sl AS (SELECT {_SCOPE_SQL}, category, question_no, {{'dimension': dimension, 'value': value, 'mean': {pub('AVG(score)')}, 'count': COUNT(score), 'distribution': {_COUNTS}}} AS slice
  FROM long GROUP BY {_SCOPE_SQL}, category, question_no, dimension, value)
, sq AS (SELECT {_SCOPE_SQL}, category, {{'question': question_no, 'slices': LIST(slice)}} AS one FROM sl GROUP BY {_SCOPE_SQL}, category, question_no)
, sc AS (SELECT {_SCOPE_SQL}, {{'category': category, 'questions': LIST(one)}} AS one FROM sq GROUP BY {_SCOPE_SQL}, category)
, c AS (SELECT {_SCOPE_SQL}, LIST(one) AS cs FROM sc GROUP BY {_SCOPE_SQL})
, raw AS (SELECT {_SCOPE_SQL}, {{'respondent_id': respondent_id, 'location': location, {_ANSWERS}}} AS one FROM p GROUP BY {_SCOPE_SQL}, respondent_id, location)
, d AS (SELECT {_SCOPE_SQL}, LIST(one) AS rs FROM raw GROUP BY {_SCOPE_SQL})
, docs AS (
  SELECT 'A overview' AS shape, {_SCOPE_SQL}, CAST(TO_JSON({{{_HEAD}, 'overall_score': overall, 'response_count': people, 'response_rate': rate, 'benchmark': benchmark, 'categories': cs}}) AS VARCHAR) AS doc FROM scopes JOIN a USING ({_SCOPE_SQL})
  UNION ALL SELECT 'B detailed', {_SCOPE_SQL}, CAST(TO_JSON({{{_HEAD}, 'response_count': people, 'categories': bs}}) AS VARCHAR) FROM scopes JOIN a USING ({_SCOPE_SQL})
  UNION ALL SELECT 'C dimensional', {_SCOPE_SQL}, CAST(TO_JSON({{{_HEAD}, 'response_count': people, 'categories': cs}}) AS VARCHAR) FROM scopes JOIN c USING ({_SCOPE_SQL})
  UNION ALL SELECT 'D raw', {_SCOPE_SQL}, CAST(TO_JSON({{{_HEAD}, 'responses': rs}}) AS VARCHAR) FROM scopes JOIN d USING ({_SCOPE_SQL}))
SELECT shape, {_SCOPE_SQL}, OCTET_LENGTH(ENCODE(doc)) AS size_bytes, LENGTH(doc) // 4 AS est_tokens,
       CASE WHEN LENGTH(doc) // 4 < 1000 THEN 'Excellent' WHEN LENGTH(doc) // 4 < 3000 THEN 'Good' WHEN LENGTH(doc) // 4 < 15000 THEN 'Degrades' ELSE 'Poor' END AS rating FROM docs"""


@query("payload_report", with_survey(_DOCUMENTS))
def payload_report(spark, sf):
    """JSON size, token estimate and rating of the four whole documents per team, project and period."""
    period = F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string"))
    rows = materialize(survey(spark, sf).withColumns({"project_id": F.col("project"), "time_period": period}), scratch_path(spark, "survey"))
    people = rows.groupBy(*_DOC_KEYS).agg(F.max("team_name").alias("team"), F.countDistinct("respondent_id").alias("response_count"))
    invited = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("team_id"), F.col("c_mktsegment").alias("project_id")).agg(F.count(F.lit(1)).alias("invited"))
    bench = rows.groupBy("time_period").agg(publish(F.avg("score")).alias("benchmark"))
    scopes = people.join(invited, ["team_id", "project_id"]).join(bench, "time_period").select(
        *_DOC_KEYS, "team", F.col("project_id").alias("project"), F.col("time_period").alias("period"),
        "response_count", publish(F.col("response_count") / F.col("invited")).alias("response_rate"), "benchmark",
    )
    documents = overview.whole_documents(rows, scopes, _DOC_KEYS, "question_no", "category", "score", ["location", "department"])
    raw = overview.shape_raw(rows, _DOC_KEYS, "respondent_id", ["location"], "question_no", "score", range(1, 13))
    keys = [f"_{k}" for k in _DOC_KEYS]
    report = overview.payload_report(documents, keys, {"D raw": raw.withColumnsRenamed(dict(zip(_DOC_KEYS, keys, strict=True)))})
    return report.withColumnsRenamed(dict(zip(keys, _DOC_KEYS, strict=True)))


# ---- cache and tiers --------------------------------------------------------

_TTL = """
WITH RECURSIVE loads AS (
  SELECT user_id, MIN(ts) AS ts, TRUE AS cold FROM events GROUP BY user_id
  UNION ALL
  SELECT e.user_id, MIN(e.ts), FALSE FROM loads l JOIN events e ON e.user_id = l.user_id AND e.ts > l.ts + INTERVAL 6 HOUR GROUP BY e.user_id),
first_ids AS (SELECT l.user_id, l.cold, MIN(e.event_id) AS event_id FROM loads l JOIN events e ON e.user_id = l.user_id AND e.ts = l.ts GROUP BY l.user_id, l.cold, l.ts),
replayed AS (SELECT e.event_id, e.user_id, e.event_type, CASE WHEN f.cold THEN 'MISS' WHEN NOT f.cold THEN 'EXPIRED' ELSE 'HIT' END AS outcome
  FROM events e LEFT JOIN first_ids f ON f.event_id = e.event_id)
"""


@query("ttl_replay", _TTL + "SELECT event_id, user_id, event_type, outcome FROM replayed")
def ttl_replay(spark, sf):
    log = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return cache.ttl_replay(log, "user_id", "ts", "event_id", 6 * 3600).drop("ts")


@query("cache_report", _TTL + f"""
SELECT event_type, COUNT(*) AS calls, COUNT(CASE WHEN outcome = 'HIT' THEN 1 END) AS hits, COUNT(CASE WHEN outcome = 'MISS' THEN 1 END) AS misses,
       COUNT(CASE WHEN outcome = 'EXPIRED' THEN 1 END) AS expired, {pub("100.0 * COUNT(CASE WHEN outcome = 'HIT' THEN 1 END) / COUNT(*)", 1)} AS hit_pct
       FROM replayed GROUP BY event_type""")
def cache_report(spark, sf):
    log = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return cache.cache_report(cache.ttl_replay(log, "user_id", "ts", "event_id", 6 * 3600), ["event_type"])


@query("route_requests", with_survey(_REQUESTS + f"""
, live AS (SELECT team_id, project AS project_id, CASE WHEN COUNT(DISTINCT respondent_id) >= 10 THEN {pub('AVG(score)')} END AS mean_score,
   COUNT(DISTINCT respondent_id) < 10 AS is_suppressed FROM survey GROUP BY team_id, project)
SELECT request_id, user_id, r.team_id, r.project_id, time_period, CASE WHEN l.team_id IS NULL THEN 'none' WHEN l.team_id < 15 THEN 'serving' ELSE 'analytical' END AS tier,
       l.mean_score, CASE WHEN l.team_id IS NULL THEN 'no_data' WHEN l.is_suppressed THEN 'suppressed' END AS reason
FROM requests r LEFT JOIN live l ON l.team_id = r.team_id AND l.project_id = r.project_id"""))
def route_requests(spark, sf):
    """Teams below 15 are pre-computed; the rest is recomputed; unknown teams have no data."""
    people = survey(spark, sf).groupBy("team_id", F.col("project").alias("project_id")).agg(
        publish(F.avg("score")).alias("mean_score"), F.countDistinct("respondent_id").alias("n")
    )
    live = suppress(people, "n", ["mean_score"], 10)
    return cache.route_requests(_requests(spark, sf), live.filter("team_id < 15"), live, ["team_id", "project_id"], "mean_score")
