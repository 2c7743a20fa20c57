"""Bronze-silver-gold queries, data-quality contracts, rollups, refresh and serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish, reject_uncastable, run_sql
from tallyhouse.operators import compare, quality, refresh, rollup
from tallyhouse.operators.aggregate import group_means
from tallyhouse.operators.joins import orphans
from tallyhouse.operators.quality import CheckSpec, Contract, run_suite
from tallyhouse.plans import medallion
from tallyhouse.plans.catalog import pub, query, with_silver, with_survey
from tallyhouse.plans.inputs import LATEST, question_config, survey_bronze, survey_silver
from tallyhouse.session import scratch_path
from tallyhouse.sources import published
from tallyhouse.sources import snapshots
from tallyhouse.sources.files import append, materialize, read_csv, register_view, with_audit, write_parquet
from tallyhouse.sources.schemas import TABLES
from tallyhouse.sources.survey import CATEGORIES, survey, table, teams

# ---- layers -----------------------------------------------------------------


def _stored_silver(spark, sf):
    """Silver as a table, the way the layers keep it, since several results read it."""
    return materialize(survey_silver(spark, sf), scratch_path(spark, "silver"))


RAW_TEXT = "CASE WHEN raw_score = 0 THEN 'X' ELSE CAST(raw_score AS VARCHAR) END"


@query("bronze_rejects", with_survey(f"""
SELECT response_id, team_id, submitted_at, {RAW_TEXT} AS score FROM survey WHERE TRY_CAST({RAW_TEXT} AS INT) IS NULL"""))
def bronze_rejects(spark, sf):
    """Rows whose score text is no number."""
    text = F.when(F.col("raw_score") == 0, "X").otherwise(F.col("raw_score").cast("string"))
    raw = survey(spark, sf).select("response_id", "team_id", "submitted_at", text.alias("score"))
    return reject_uncastable(raw, "score", "int")[1]


@query("silver_responses", with_silver("SELECT response_id, respondent_id, team_id, project, question_no, category, raw_score, score, is_reverse_scored, submitted_at FROM silver"))
def silver_responses(spark, sf):
    return survey_silver(spark, sf).select(
        "response_id", "respondent_id", "team_id", "project", "question_no", "category", "raw_score", "score", "is_reverse_scored", "submitted_at"
    )


@query("suppression_flags", with_silver("SELECT team_id, COUNT(DISTINCT respondent_id) AS respondent_count, COUNT(DISTINCT respondent_id) < 50 AS is_suppressed FROM silver GROUP BY team_id"))
def suppression_flags(spark, sf):
    return medallion.suppression_flags(survey_silver(spark, sf), k=50)


_OVERVIEW = """
, flags AS (SELECT team_id, COUNT(DISTINCT respondent_id) < 50 AS is_suppressed FROM silver GROUP BY team_id)
"""


@query("team_overview_metrics", with_silver(f"""
SELECT s.team_id, s.category, CASE WHEN NOT f.is_suppressed THEN {pub('AVG(s.score)')} END AS mean_score,
       COUNT(*) AS response_count, COUNT(DISTINCT s.respondent_id) AS respondent_count, n.n_name AS team_name, r.r_name AS department, f.is_suppressed
FROM silver s JOIN flags f ON s.team_id = f.team_id JOIN nation n ON n.n_nationkey = s.team_id JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY s.team_id, s.category, n.n_name, r.r_name, f.is_suppressed""", _OVERVIEW))
def team_overview_metrics(spark, sf):
    silver = _stored_silver(spark, sf)
    return medallion.team_overview_metrics(silver, medallion.silver_teams(teams(spark, sf)), medallion.suppression_flags(silver, k=50))


@query("team_overview_flagged", with_silver(f"""
SELECT s.team_id, s.category, {pub('AVG(s.score)')} AS mean_score,
       COUNT(*) AS response_count, COUNT(DISTINCT s.respondent_id) AS respondent_count, n.n_name AS team_name, r.r_name AS department, f.is_suppressed
FROM silver s JOIN flags f ON s.team_id = f.team_id JOIN nation n ON n.n_nationkey = s.team_id JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY s.team_id, s.category, n.n_name, r.r_name, f.is_suppressed""", _OVERVIEW))
def team_overview_flagged(spark, sf):
    """The gold shape that marks suppressed teams and still carries their mean."""
    silver = _stored_silver(spark, sf)
    return medallion.team_overview_metrics(silver, teams(spark, sf), medallion.suppression_flags(silver, k=50), mode="flag")


@query("category_summary", with_silver(f"""
SELECT category, {pub('AVG(score)')} AS mean_score, MIN(score) AS min_score, MAX(score) AS max_score, COUNT(*) AS total_responses,
       COUNT(DISTINCT team_id) AS teams_represented FROM silver GROUP BY category"""))
def category_summary(spark, sf):
    return medallion.category_summary(survey_silver(spark, sf))


@query("reject_reasons", with_survey("""
, d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY response_id ORDER BY submitted_at DESC, raw_score DESC, question_no DESC, respondent_id DESC) AS rn FROM survey)
SELECT CASE WHEN rn > 1 THEN 'duplicate' WHEN raw_score BETWEEN 1 AND 5 THEN 'kept' ELSE 'out_of_range' END AS reason, COUNT(*) AS row_count FROM d GROUP BY 1"""))
def reject_reasons(spark, sf):
    return medallion.reject_reasons(survey_bronze(spark, sf), "response_id", "score", LATEST)


@query("layer_counts", with_silver("""
SELECT 'bronze' AS layer, COUNT(*) AS row_count FROM survey UNION ALL SELECT 'silver', COUNT(*) FROM silver
UNION ALL SELECT 'gold', COUNT(*) FROM (SELECT DISTINCT team_id, category FROM silver)"""))
def layer_counts(spark, sf):
    """Row counts of the three layers. Silver is stored once, as it is when the layers run."""
    bronze = survey_bronze(spark, sf)
    silver = _stored_silver(spark, sf)
    return medallion.layer_counts({"bronze": bronze, "silver": silver, "gold": silver.select("team_id", "category").distinct()})


@query("audited_load", "SELECT 'orders.parquet' AS source_file, COUNT(*) AS row_count, COUNT(*) AS stamped FROM orders")
def audited_load(spark, sf):
    """Rows per file they were read from, all with a load time."""
    rows = with_audit(table(spark, sf, "orders"))
    return rows.groupBy(F.substring_index("_source_file", "/", -1).alias("source_file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("_loaded_at").alias("stamped")
    )


@query("csv_load", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_load(spark, sf):
    """A seed in CSV with header, read back under its declared schema."""
    path = scratch_path(spark, "seed")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path, TABLES["customer"])


@query("view_read", f"SELECT o_orderstatus, {pub('AVG(o_totalprice)')} AS mean_price FROM orders GROUP BY o_orderstatus")
def view_read(spark, sf):
    register_view(table(spark, sf, "orders"), "orders_view")
    return spark.sql("SELECT o_orderstatus, CAST(ROUND(CAST(AVG(o_totalprice) AS DECIMAL(18,6)), 2) AS DOUBLE) AS mean_price FROM orders_view GROUP BY o_orderstatus")


_LAYERED = """
, raw AS (SELECT CAST(response_id AS VARCHAR) AS response_id, CAST(respondent_id AS VARCHAR) AS respondent_id, CAST(team_id AS VARCHAR) AS team_id, project AS project_id,
    CAST(question_no AS VARCHAR) AS question_id, raw_score, submitted_at, category, is_reverse_scored FROM survey)
, clean AS (SELECT *, CASE WHEN is_reverse_scored THEN 6 - raw_score ELSE raw_score END AS score FROM (
    SELECT raw.*, ROW_NUMBER() OVER (PARTITION BY response_id ORDER BY submitted_at DESC, respondent_id DESC, team_id DESC, project_id DESC, question_id DESC, raw_score DESC) AS rn FROM raw)
    WHERE rn = 1 AND raw_score BETWEEN 1 AND 5)
, flags AS (SELECT team_id, COUNT(DISTINCT respondent_id) < 4 AS is_suppressed FROM clean GROUP BY team_id)
"""


@query("layered_run", with_survey(_LAYERED + f"""
SELECT c.team_id, c.category, {pub('AVG(c.score)')} AS mean_score, COUNT(*) AS response_count, COUNT(DISTINCT c.respondent_id) AS respondent_count,
       n.n_name AS team_name, r.r_name AS department, f.is_suppressed
FROM clean c JOIN flags f ON f.team_id = c.team_id JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = c.team_id JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY c.team_id, c.category, n.n_name, r.r_name, f.is_suppressed"""))
def layered_run(spark, sf):
    """All layers built in order from raw text tables, gated by their 26 checks and the custom one; gold is returned."""
    text = lambda c: F.col(c).cast("string")
    raw = survey(spark, sf).select(
        text("response_id").alias("response_id"), text("respondent_id").alias("respondent_id"), text("team_id").alias("team_id"),
        F.col("project").alias("project_id"), text("question_no").alias("question_id"), text("raw_score").alias("score"), text("submitted_at").alias("submitted_at"),
    )
    questions = question_config(spark, sf).select(
        text("question_no").alias("question_id"), F.concat(F.lit("Question "), text("question_no")).alias("question_text"), "category", text("is_reverse_scored").alias("is_reverse_scored")
    )
    people = teams(spark, sf).select(text("team_id").alias("team_id"), "team_name", "department", "division")
    path = scratch_path(spark, "layers")
    sources = {"raw_survey_responses": materialize(raw, f"{path}/raw"), "raw_question_config": questions, "raw_team_hierarchy": people}
    return medallion.run_layers(spark, medallion.engagement_models(), sources, path)["team_overview_metrics"]


# ---- contracts --------------------------------------------------------------

SUITE = [
    CheckSpec("silver", "unique", "response_id"),
    CheckSpec("silver", "not_null", "response_id"),
    CheckSpec("silver", "not_null", "score"),
    CheckSpec("silver", "accepted_values", "score", (1, 2, 3, 4, 5)),
    CheckSpec("silver", "accepted_values", "category", CATEGORIES),
    CheckSpec("bronze", "unique", "response_id"),
    CheckSpec("bronze", "in_range", "score", (1, 5)),
    CheckSpec("bronze", "relationships", "team_id", ("teams", "team_id")),
]


def _line(name: str, kind: str, tab: str, failing: str) -> str:
    return f"SELECT '{name}' AS test_name, '{kind}' AS test_type, '{tab}' AS table_name, {failing} AS failing_rows"


def _suite_sql(silver: str) -> str:
    lines = [
        _line("unique_silver_response_id", "unique", "silver", f"(SELECT COUNT(*) FROM (SELECT response_id FROM {silver} GROUP BY response_id HAVING COUNT(*) > 1))"),
        _line("not_null_silver_response_id", "not_null", "silver", f"(SELECT COUNT(*) FROM {silver} WHERE response_id IS NULL)"),
        _line("not_null_silver_score", "not_null", "silver", f"(SELECT COUNT(*) FROM {silver} WHERE score IS NULL)"),
        _line("accepted_values_silver_score", "accepted_values", "silver", f"(SELECT COUNT(*) FROM {silver} WHERE score NOT IN (1, 2, 3, 4, 5))"),
        _line("accepted_values_silver_category", "accepted_values", "silver", f"(SELECT COUNT(*) FROM {silver} WHERE category NOT IN ('Basic Needs', 'Individual', 'Teamwork', 'Growth'))"),
        _line("unique_bronze_response_id", "unique", "bronze", "(SELECT COUNT(*) FROM (SELECT response_id FROM survey GROUP BY response_id HAVING COUNT(*) > 1))"),
        _line("in_range_bronze_score", "in_range", "bronze", "(SELECT COUNT(*) FROM survey WHERE raw_score NOT BETWEEN 1 AND 5)"),
        _line("relationships_bronze_team_id", "relationships", "bronze", "(SELECT COUNT(*) FROM survey WHERE team_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4))"),
    ]
    return "SELECT *, CASE WHEN failing_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(lines) + ")"


def _suite_tables(spark, sf):
    known = teams(spark, sf).filter("department <> 'MIDDLE EAST'")
    bronze = materialize(survey_bronze(spark, sf), scratch_path(spark, "bronze"))
    silver = medallion.silver_responses(bronze, question_config(spark, sf), question_key="question_no", latest=LATEST)
    return {"silver": materialize(silver, scratch_path(spark, "silver")), "bronze": bronze, "teams": known}


@query("dq_suite", with_silver(_suite_sql("silver")))
def dq_suite(spark, sf):
    """Contract checks on both layers; bronze breaks its key, range and reference checks on purpose."""
    return run_suite(_suite_tables(spark, sf), SUITE)


@query("dq_injected_failure", with_silver(_suite_sql("injected"), """, injected AS (
SELECT response_id, score, category FROM silver UNION ALL SELECT -response_id, 7, category FROM silver WHERE team_id = 3)"""))
def dq_injected_failure(spark, sf):
    """The suite after rows with score 7 were added to silver: accepted_values must fail."""
    tables = _suite_tables(spark, sf)
    silver = tables["silver"].select("response_id", "score", "category", "team_id")
    bad = silver.filter("team_id = 3").withColumns({"response_id": -F.col("response_id"), "score": F.lit(7)})
    return run_suite({**tables, "silver": silver.unionByName(bad)}, SUITE)


@query("contract_checks", """
SELECT test_name, test_type, 'orders' AS table_name, failing_rows, CASE WHEN failing_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
SELECT 'not_null_orders_o_custkey' AS test_name, 'not_null' AS test_type, (SELECT COUNT(*) FROM orders WHERE o_custkey IS NULL) AS failing_rows
UNION ALL SELECT 'unique_orders_o_orderkey', 'unique', (SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1))
UNION ALL SELECT 'accepted_values_orders_o_orderstatus', 'accepted_values', (SELECT COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
UNION ALL SELECT 'relationships_orders_o_custkey', 'relationships', (SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)))""")
def contract_checks(spark, sf):
    """A declared contract turned into checks: completeness, key, domain and reference."""
    contract = Contract(
        "orders", required=["o_custkey"], keys=["o_orderkey"], domains={"o_orderstatus": ("F", "O")}, references={"o_custkey": ("customer", "c_custkey")}
    )
    return run_suite({"orders": table(spark, sf, "orders"), "customer": table(spark, sf, "customer")}, contract.checks())


@query("relationships", "SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)")
def relationships(spark, sf):
    """Line items whose supplier is not among those with a large balance."""
    parent = table(spark, sf, "supplier").filter("s_acctbal > 5000")
    return orphans(table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey"), "l_suppkey", parent, "s_suppkey")


@query("accepted_values", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')")
def accepted_values(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return quality.accepted_values(rows, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])


@query("unique_violations", "SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1")
def unique_violations(spark, sf):
    return quality.unique(table(spark, sf, "lineitem"), "l_orderkey")


@query("quarantine", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CONCAT_WS(',', CASE WHEN l_quantity > 45 THEN 'too_many' END, CASE WHEN l_tax = 0 THEN 'no_tax' END,
 CASE WHEN l_returnflag = 'R' THEN 'returned' END) AS reasons
FROM lineitem WHERE l_quantity > 45 OR l_tax = 0 OR l_returnflag = 'R'""")
def quarantined(spark, sf):
    rules = {"too_many": F.col("l_quantity") > 45, "no_tax": F.col("l_tax") == 0, "returned": F.col("l_returnflag") == "R"}
    bad = quality.quarantine(table(spark, sf, "lineitem"), rules)[1]
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.array_join("reject_reasons", ",").alias("reasons"))


# ---- rollups ----------------------------------------------------------------

_PARTS = "CAST(SUM(score) AS BIGINT) AS score_sum, COUNT(score) AS score_count, MIN(score) AS score_min, MAX(score) AS score_max"
_DIMS = ["department", "category", "project", "year"]


def _stored_rollup(spark, sf):
    return rollup.build_rollup(survey(spark, sf), _DIMS, "score")


@query("rollup_build", with_survey(f"SELECT department, category, project, year, {_PARTS} FROM survey GROUP BY ALL"))
def rollup_build(spark, sf):
    return _stored_rollup(spark, sf)


@query("rollup_mean", with_survey(f"SELECT department, category, project, year, {pub('CAST(SUM(score) AS DOUBLE) / COUNT(score)')} AS mean_score, COUNT(score) AS response_count FROM survey GROUP BY ALL"))
def rollup_mean(spark, sf):
    return rollup.rollup_mean(_stored_rollup(spark, sf), _DIMS)


@query("rollup_derived", with_survey(f"SELECT department, year, {_PARTS} FROM survey GROUP BY department, year"))
def rollup_derived(spark, sf):
    """Two dimensions dropped by re-aggregating the stored cells."""
    return rollup.derive_rollup(_stored_rollup(spark, sf), ["department", "year"])


@query("rollup_read", with_survey(f"SELECT category, {pub('CAST(SUM(score) AS DOUBLE) / COUNT(score)')} AS mean_score, COUNT(score) AS response_count FROM survey GROUP BY category"))
def rollup_read(spark, sf):
    """A rollup published as a table, then asked for a coarser mean."""
    path = scratch_path(spark, "rollup")
    published.publish_version(_stored_rollup(spark, sf), path, _DIMS)
    return rollup.rollup_mean(rollup.derive_rollup(published.read_version(spark, path), ["category"]), ["category"])


@query("cube_rollup", with_survey(f"""
SELECT department, category, division, CAST(GROUPING_ID(department, category, division) AS BIGINT) AS grouping_id, {_PARTS}
FROM survey GROUP BY CUBE (department, category, division)"""))
def cube_rollup(spark, sf):
    return rollup.cube_rollup(survey(spark, sf), ["department", "category", "division"], "score")


@query("grouping_sets", with_survey(f"""
SELECT team_name, category, year, CAST(GROUPING_ID(team_name, category, year) AS BIGINT) AS grouping_id, {_PARTS}
FROM survey GROUP BY GROUPING SETS ((team_name, year), (category), (team_name, category, year))"""))
def grouping_sets(spark, sf):
    sets = [["team_name", "year"], ["category"], ["team_name", "category", "year"]]
    return rollup.grouping_sets(survey(spark, sf), ["team_name", "category", "year"], sets, "score")


@query("answer_from_rollups", with_survey(f"""
SELECT department, {pub('AVG(score)')} AS mean_score, COUNT(score) AS response_count, 'department_year' AS source FROM survey GROUP BY department"""))
def answer_from_rollups(spark, sf):
    """Of two stored rollups that hold the asked dimension, the smaller one answers."""
    facts = survey(spark, sf)
    path = scratch_path(spark, "rollups")
    wide = materialize(_stored_rollup(spark, sf), f"{path}/wide")
    narrow = materialize(rollup.derive_rollup(wide, ["department", "year"]), f"{path}/narrow")
    stored = {
        "department_category_project_year": (wide, _DIMS, wide.count()),
        "department_year": (narrow, ["department", "year"], narrow.count()),
    }
    return rollup.answer_from_rollups(stored, facts, ["department"], "score")


@query("rollup_sketches", "SELECT event_type, COUNT(value) AS score_count, TRUE AS p90_within, TRUE AS people_within FROM events GROUP BY event_type")
def rollup_sketches(spark, sf):
    """A P90 and a distinct count from the sketches of a finer stored rollup, held against the facts: the P90's rank
    within 1 %, the count within 2.5 %."""
    facts = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "user_id", "value")
    path = scratch_path(spark, "sketches")
    cells = materialize(rollup.build_sketches(facts, ["event_type", "day"], "value", "user_id"), path)
    derived = rollup.sketched(rollup.derive_sketches(cells, ["event_type"]), ["event_type"], {"p90": 0.9})
    below = facts.join(derived, "event_type").groupBy("event_type", "score_count", "people").agg(
        F.avg((F.col("value") <= F.col("p90")).cast("double")).alias("under"), F.avg((F.col("value") < F.col("p90")).cast("double")).alias("strictly"), F.countDistinct("user_id").alias("exact")
    )
    near = (F.col("under") >= 0.89) & (F.col("strictly") <= 0.91)
    return below.select("event_type", "score_count", near.alias("p90_within"), (F.abs(F.col("people") - F.col("exact")) <= 0.025 * F.col("exact")).alias("people_within"))


# ---- refresh ----------------------------------------------------------------

_CUT = "TIMESTAMP '2024-01-25 00:00:00'"


def _cut():
    return F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")


def _events(spark, sf):
    """Events with the value in cents, so sums are exact."""
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))


_CENTS = "CAST(ROUND(value * 100) AS BIGINT)"
_EVENT_PARTS = f"CAST(SUM({_CENTS}) AS BIGINT) AS score_sum, COUNT(*) AS score_count, MIN({_CENTS}) AS score_min, MAX({_CENTS}) AS score_max"


@query("mv_staleness", f"""
WITH stored AS (SELECT event_type, user_id, CAST(SUM({_CENTS}) AS BIGINT) AS s, COUNT(*) AS n FROM events WHERE ts < {_CUT} GROUP BY ALL),
live AS (SELECT event_type, user_id, CAST(SUM({_CENTS}) AS BIGINT) AS s, COUNT(*) AS n FROM events GROUP BY ALL)
SELECT COALESCE(a.event_type, b.event_type) AS event_type, COALESCE(a.user_id, b.user_id) AS user_id, a.s AS stored_score_sum, a.n AS stored_score_count,
       b.s AS live_score_sum, b.n AS live_score_count, CASE WHEN a.s = b.s AND a.n = b.n THEN 'FRESH' ELSE 'STALE' END AS status
FROM stored a FULL JOIN live b ON a.event_type = b.event_type AND a.user_id = b.user_id""")
def mv_staleness(spark, sf):
    """A view stored before the last days' events arrived, held against the live result."""
    rows = _events(spark, sf)
    dims = ["event_type", "user_id"]
    path = scratch_path(spark, "mv")
    refresh.MaterializedView(spark, path, lambda: rows.filter(F.col("ts") < _cut()), dims, "cents").refresh()
    return refresh.MaterializedView(spark, path, lambda: rows, dims, "cents").staleness()


@query("mv_inputs_moved", f"""
SELECT 'customer' AS source, COUNT(*) AS row_count, CAST(NULL AS VARCHAR) AS newest, 'FRESH' AS status FROM customer
UNION ALL SELECT 'events', COUNT(*), STRFTIME(DATE_TRUNC('day', MAX(ts)), '%Y-%m-%d'), 'STALE' FROM events WHERE ts < {_CUT}""")
def mv_inputs_moved(spark, sf):
    """Which inputs of a view moved since it was stored, from file listings: events get new files, customers do not."""
    rows, path = table(spark, sf, "events"), scratch_path(spark, "mv")
    feed = f"{path}/events"
    rows.filter(F.col("ts") < _cut()).write.parquet(feed)
    view = refresh.MaterializedView(
        spark, f"{path}/view", lambda: spark.read.parquet(feed), ["event_type"], "user_id", {"events": (feed, "ts"), "customer": f"{sf}/customer.parquet"}
    )
    view.refresh()
    rows.filter(F.col("ts") >= _cut()).write.mode("append").parquet(feed)
    return view.input_staleness().select("source", "row_count", F.substring("newest", 1, 10).alias("newest"), "status")


_CHANGED = f"(SELECT event_type, user_id, CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END + {_CENTS} AS cents FROM events WHERE event_id % 11 > 0 OR ts >= {_CUT})"


@query("mv_retractions", f"SELECT event_type, user_id, CAST(SUM(cents) AS BIGINT) AS score_sum, COUNT(*) AS score_count, MIN(cents) AS score_min, MAX(cents) AS score_max FROM {_CHANGED} GROUP BY ALL")
def mv_retractions(spark, sf):
    """Events stored early, then some deleted, some corrected and new ones added: equal to a full build of what is left."""
    rows = _events(spark, sf)
    old = F.col("ts") < _cut()
    deleted, corrected = old & (F.col("event_id") % 11 == 0), F.col("event_id") % 7 == 0
    after = rows.filter(~deleted).withColumn("cents", F.col("cents") + F.when(corrected, 1).otherwise(0))
    dims, path = ["event_type", "user_id"], scratch_path(spark, "mv")
    refresh.MaterializedView(spark, path, lambda: rows.filter(old), dims, "cents").refresh()
    view = refresh.MaterializedView(spark, path, lambda: after, dims, "cents")
    view.refresh_changes(after.filter(~old | corrected), rows.filter(old & (deleted | corrected)))
    return view.read()


@query("mv_incremental_equals_full", f"SELECT event_type, user_id, {_EVENT_PARTS} FROM events GROUP BY ALL")
def mv_incremental_equals_full(spark, sf):
    """Old events materialised, new ones folded in: equal to a full build."""
    rows = _events(spark, sf)
    path = scratch_path(spark, "mv")
    view = refresh.MaterializedView(spark, path, lambda: rows.filter(F.col("ts") < _cut()), ["event_type", "user_id"], "cents")
    view.refresh()
    view.refresh_incremental(rows.filter(F.col("ts") >= _cut()))
    return view.read()


@query("incremental_load", f"SELECT event_id, ts, user_id, event_type, {_CENTS} AS cents FROM events")
def incremental_load(spark, sf):
    """A target that stops early and misses some late rows catches up through the lookback margin; the source
    sends some rows again, earlier and with another amount."""
    rows = _events(spark, sf)
    held_back = (F.col("ts") >= F.lit("2024-01-23 00:00:00").cast("timestamp_ntz")) & (F.col("event_type") == "error")
    target = materialize(rows.filter((F.col("ts") < _cut()) & ~held_back), scratch_path(spark, "target"))
    again = rows.filter("event_id % 3 = 0").withColumns({"ts": F.col("ts") - F.expr("INTERVAL 1 HOUR"), "cents": F.col("cents") + 1})
    return refresh.incremental_load(rows.unionByName(again), target, ["event_id"], "ts", lookback="3 days")


@query("incremental_strict", f"""
WITH target AS (SELECT * FROM events WHERE ts < {_CUT} AND event_type <> 'error')
SELECT event_id, ts, user_id, event_type, {_CENTS} AS cents FROM events
WHERE (ts < {_CUT} AND event_type <> 'error') OR ts > (SELECT MAX(ts) FROM target)""")
def incremental_strict(spark, sf):
    """Only rows past the newest stored time are taken: older rows that came late stay missing."""
    rows = _events(spark, sf)
    target = rows.filter((F.col("ts") < _cut()) & (F.col("event_type") != "error"))
    return refresh.incremental_load(rows, target, ["event_id"], "ts", lookback=None)


@query("upsert", f"""
SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'fixed' ELSE event_type END AS event_type, CASE WHEN event_type = 'error' THEN 0 ELSE {_CENTS} END AS cents FROM events
UNION ALL SELECT -event_id - 1, user_id, 'new', 1 FROM events WHERE event_type = 'signup'""")
def upsert(spark, sf):
    rows = _events(spark, sf).select("event_id", "user_id", "event_type", "cents")
    changed = rows.filter("event_type = 'error'").select("event_id", "user_id", F.lit("fixed").alias("event_type"), F.lit(0).cast("bigint").alias("cents"))
    added = rows.filter("event_type = 'signup'").select((-F.col("event_id") - 1).alias("event_id"), "user_id", F.lit("new").alias("event_type"), F.lit(1).cast("bigint").alias("cents"))
    return refresh.upsert(rows, changed.unionByName(added), ["event_id"])


_UPSERTED = f"""
SELECT event_id, user_id, CASE WHEN event_type = 'signup' OR event_type = 'click' AND event_id % 2 = 0 THEN 'moved' ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' AND value < 50 THEN 0 ELSE {_CENTS} END AS cents FROM events"""


@query("upsert_partitions", _UPSERTED)
def upsert_partitions(spark, sf):
    """A keyed upsert into a partitioned table, of changed rows and of rows that move: half of one partition and
    the whole of another. Only partitions with such rows are rewritten."""
    rows, path = _events(spark, sf).select("event_id", "user_id", "event_type", "cents"), scratch_path(spark, "partitioned")
    write_parquet(rows, path, partition_by=["event_type"])
    refresh.upsert_partitions(spark, path, _partition_updates(rows), ["event_id"], "event_type")
    return spark.read.parquet(path)


def _partition_updates(rows):
    changed = rows.filter("event_type = 'error' AND cents < 5000").withColumn("cents", F.lit(0).cast("bigint"))
    moved = rows.filter("event_type = 'signup' OR event_type = 'click' AND event_id % 2 = 0").withColumn("event_type", F.lit("moved"))
    return changed.unionByName(moved)


@query("upsert_snapshot", _UPSERTED)
def upsert_snapshot(spark, sf):
    """The same upsert as one commit of a table with snapshots."""
    rows, path = _events(spark, sf).select("event_id", "user_id", "event_type", "cents"), scratch_path(spark, "snapshots")
    snapshots.create_snapshot(rows, path, "event_type")
    snapshots.upsert_snapshot(spark, path, _partition_updates(rows), ["event_id"], "event_type")
    return snapshots.read_snapshot(spark, path)


@query("update_delete", f"""
SELECT event_id, CASE WHEN event_type = 'click' THEN user_id + 1000 ELSE user_id END AS user_id, event_type, {_CENTS} AS cents FROM events WHERE NOT {_CENTS} < 500""")
def update_delete(spark, sf):
    rows = _events(spark, sf).drop("ts")
    moved = refresh.update_where(rows, F.col("event_type") == "click", {"user_id": F.col("user_id") + 1000})
    return refresh.delete_where(moved, F.col("cents") < 500)


@query("append_rows", "SELECT event_type, COUNT(*) + COUNT(CASE WHEN value < 50 THEN 1 END) AS n FROM events GROUP BY event_type")
def append_rows(spark, sf):
    """Bronze only grows: small events are delivered twice and both copies stay."""
    rows = _events(spark, sf)
    path = scratch_path(spark, "bronze")
    write_parquet(rows, path)
    append(rows.filter("cents < 5000"), path)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("metric_diff", f"""
WITH b AS (SELECT event_type, user_id, COUNT(*) AS n FROM events WHERE ts < {_CUT} GROUP BY ALL), a AS (SELECT event_type, user_id, COUNT(*) AS n FROM events GROUP BY ALL)
SELECT COALESCE(b.event_type, a.event_type) AS event_type, COALESCE(b.user_id, a.user_id) AS user_id, b.n AS old_n, a.n AS new_n,
       CASE WHEN b.n IS NULL THEN 'added' WHEN a.n IS NULL THEN 'removed' ELSE 'changed' END AS status
FROM b FULL JOIN a ON a.event_type = b.event_type AND a.user_id = b.user_id WHERE b.n IS DISTINCT FROM a.n""")
def metric_diff(spark, sf):
    rows = table(spark, sf, "events")
    count = lambda df: df.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return compare.metric_diff(count(rows.filter(F.col("ts") < _cut())), count(rows), ["event_type", "user_id"], ["n"])


@query("consistency_check", f"""
WITH a AS (SELECT user_id, {pub('AVG(value)')} AS m FROM events GROUP BY user_id), b AS (SELECT user_id, {pub('AVG(value)')} AS m FROM events WHERE event_type <> 'error' OR ts < {_CUT} GROUP BY user_id)
SELECT COALESCE(a.user_id, b.user_id) AS user_id, {pub('ABS(a.m - b.m)', 4)} AS delta_m, CASE WHEN a.m = b.m THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM a FULL JOIN b ON a.user_id = b.user_id""")
def consistency_check(spark, sf):
    """Two consumers of one metric, one of them missing the newest errors."""
    rows = table(spark, sf, "events")
    m = lambda df: df.groupBy("user_id").agg(publish(F.avg("value")).alias("m"))
    return compare.consistency_check(m(rows), m(rows.filter((F.col("event_type") != "error") | (F.col("ts") < _cut()))), ["user_id"], ["m"])


@query("served_read", with_survey(f"SELECT team_id, category, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey WHERE team_id = 7 GROUP BY team_id, category"))
def served_read(spark, sf):
    """Gold published as a key-sorted version, then read for one team."""
    path = scratch_path(spark, "serving")
    published.publish_version(group_means(survey(spark, sf), ["team_id", "category"], "score"), path, ["team_id", "category"])
    return published.serve(spark, path, team_id=7)


@query("pinned_version", f"SELECT event_type, COUNT(*) AS n FROM events WHERE ts < {_CUT} GROUP BY event_type")
def pinned_version(spark, sf):
    """A reader that stays on version 1 while version 2 is published."""
    rows = table(spark, sf, "events")
    count = lambda df: df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "serving")
    first = published.publish_version(count(rows.filter(F.col("ts") < _cut())), path, ["event_type"])
    published.publish_version(count(rows), path, ["event_type"])
    return published.read_version(spark, path, first)


@query("bound_parameters", f"SELECT o_orderpriority, {pub('AVG(o_totalprice)')} AS mean_price, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 50000 AND 200000 GROUP BY o_orderpriority")
def bound_parameters(spark, sf):
    text = (
        "SELECT o_orderpriority, CAST(ROUND(CAST(AVG(o_totalprice) AS DECIMAL(18,6)), 2) AS DOUBLE) AS mean_price, COUNT(*) AS n "
        "FROM {orders} WHERE o_orderstatus = :status AND o_totalprice BETWEEN :lo AND :hi GROUP BY o_orderpriority"
    )
    return run_sql(spark, text, {"status": "F", "lo": 50000, "hi": 200000}, orders=table(spark, sf, "orders"))


@query("question_config", "SELECT DISTINCT p_size % 12 + 1 AS question_no, CASE WHEN p_size % 12 + 1 <= 2 THEN 'Basic Needs' WHEN p_size % 12 + 1 <= 6 THEN 'Individual' WHEN p_size % 12 + 1 <= 10 THEN 'Teamwork' ELSE 'Growth' END AS category, p_size % 12 + 1 = 6 AS is_reverse_scored FROM part")
def question_config_rows(spark, sf):
    return question_config(spark, sf)
