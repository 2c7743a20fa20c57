"""Dimensional queries: star and snowflake aggregates, grain, distributions, ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions.columns import (
    clamp, lcg, likert_band, path_label, period_label, publish, reverse_scale, simple_case,
)
from tallyhouse.operators import aggregate as agg
from tallyhouse.operators import joins, ranking, warehouse
from tallyhouse.operators.compare import consistency_check
from tallyhouse.operators.privacy import suppress
from tallyhouse.operators.rollup import reduction
from tallyhouse.plans.catalog import pub, query, with_survey
from tallyhouse.plans.inputs import question_config, survey_bronze
from tallyhouse.session import scratch_path
from tallyhouse.sources.files import materialize
from tallyhouse.sources.generate import generate_facts
from tallyhouse.sources.survey import question_items, respondents, survey, table, teams


def _mean_and_rows():
    return [publish(F.avg(F.col("score").cast("double"))).alias("mean_score"), F.count(F.lit(1)).alias("response_count")]


def answers(spark, sf):
    """Response facts with dimension keys only."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("respondent_id"))
    quantity = F.col("l_quantity").cast("int")
    return (
        table(spark, sf, "lineitem")
        .select(F.col("l_partkey").alias("p_partkey"), F.col("l_orderkey").alias("o_orderkey"), (quantity % 5 + 1).alias("score"))
        .join(orders, "o_orderkey")
        .select("respondent_id", "p_partkey", "score")
    )


@query("star_mean_by_team", with_survey(f"SELECT team_name, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey GROUP BY team_name"))
def star_mean_by_team(spark, sf):
    return joins.star_query(answers(spark, sf), [(respondents(spark, sf), "respondent_id")], ["team_name"], _mean_and_rows())


@query("star_mean_by_category", with_survey(f"SELECT category, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey GROUP BY category"))
def star_mean_by_category(spark, sf):
    return joins.star_query(answers(spark, sf), [(question_items(spark, sf), "p_partkey")], ["category"], _mean_and_rows())


@query("star_department_category", with_survey(
    f"SELECT department, category, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey WHERE division = 'WEST' GROUP BY department, category"))
def star_department_category(spark, sf):
    dims = [(respondents(spark, sf), "respondent_id"), (question_items(spark, sf), "p_partkey")]
    return joins.star_query(answers(spark, sf), dims, ["department", "category"], _mean_and_rows(), where=F.col("division") == "WEST")


FLAGSHIP_SQL = with_survey(f"""
SELECT team_name, category,
       CASE WHEN COUNT(DISTINCT respondent_id) >= 4 THEN {pub('AVG(score)')} END AS mean_score,
       COUNT(DISTINCT respondent_id) AS n, COUNT(DISTINCT respondent_id) < 4 AS is_suppressed
FROM survey GROUP BY team_name, category""")


@query("star_suppressed_team_category", FLAGSHIP_SQL)
def star_suppressed_team_category(spark, sf):
    rows = survey(spark, sf).groupBy("team_name", "category").agg(_mean_and_rows()[0], F.countDistinct("respondent_id").alias("n"))
    return suppress(rows, "n", ["mean_score"], 4)


def _team_chain(spark, sf):
    """The team dimension normalised to team -> department -> division."""
    flat = teams(spark, sf).select("team_id", "team_name", "department", "division")
    return warehouse.normalize_dim(
        flat, [("team_id", ["team_name"]), ("department_key", ["department"]), ("division_key", ["division"])]
    )


@query("snowflake_division_rollup", with_survey(
    f"SELECT division, department, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey GROUP BY division, department"))
def snowflake_division_rollup(spark, sf):
    facts = answers(spark, sf).join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("respondent_id"), F.col("c_nationkey").alias("team_id")), "respondent_id")
    return joins.snowflake_query(facts, _team_chain(spark, sf), "team_id", ["division", "department"], _mean_and_rows())


@query("star_equals_snowflake", with_survey(
    "SELECT division, 0.0::DOUBLE AS delta_mean_score, 0.0::DOUBLE AS delta_response_count, 'MATCH' AS status FROM survey GROUP BY division"))
def star_equals_snowflake(spark, sf):
    facts = answers(spark, sf).join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("respondent_id"), F.col("c_nationkey").alias("team_id")), "respondent_id")
    star = joins.star_query(facts, [(teams(spark, sf), "team_id")], ["division"], _mean_and_rows())
    snow = joins.snowflake_query(facts, _team_chain(spark, sf), "team_id", ["division"], _mean_and_rows())
    return consistency_check(star, snow, ["division"], ["mean_score", "response_count"])


@query("dimension_hierarchy", """
SELECT n.n_nationkey AS team_id, n.n_name AS team_name, r.r_name AS department, r.r_name || ' > ' || n.n_name AS full_path,
       CASE WHEN r.r_name IN ('AMERICA', 'EUROPE') THEN 'WEST' ELSE 'EAST' END AS division
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def dimension_hierarchy(spark, sf):
    """Normalise the team dimension and flatten it back, with its path label."""
    flat = warehouse.flatten_dim(_team_chain(spark, sf))
    return flat.select("team_id", "team_name", "department", "division", path_label(["department", "team_name"]).alias("full_path"))


@query("build_star", with_survey("""
, keyed AS (
  SELECT DENSE_RANK() OVER (ORDER BY team_id, team_name, department) AS team_key,
         DENSE_RANK() OVER (ORDER BY question_no, category) AS question_key,
         DENSE_RANK() OVER (ORDER BY year, quarter) AS period_key, score
  FROM survey)
SELECT team_key, question_key, period_key, CAST(SUM(score) AS BIGINT) AS score_sum, COUNT(*) AS response_count
FROM keyed GROUP BY team_key, question_key, period_key"""))
def build_star(spark, sf):
    columns = ["team_id", "team_name", "department", "question_no", "category", "year", "quarter", "score"]
    flat = materialize(survey(spark, sf).select(*columns), scratch_path(spark, "flat"))
    star = warehouse.build_star(
        flat,
        {"team_key": ["team_id", "team_name", "department"], "question_key": ["question_no", "category"], "period_key": ["year", "quarter"]},
        ["score"],
    )
    return star.fact.groupBy("team_key", "question_key", "period_key").agg(
        F.sum("score").alias("score_sum"), F.count(F.lit(1)).alias("response_count")
    )


@query("surrogate_keys", "SELECT ROW_NUMBER() OVER (ORDER BY p_name, p_brand, p_partkey) AS row_key, p_partkey, p_name, p_brand FROM part")
def surrogate_keys(spark, sf):
    return ranking.surrogate_key(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), ["p_name", "p_brand", "p_partkey"])


@query("assign_new_keys", """
WITH known AS (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key FROM customer WHERE c_mktsegment <> 'BUILDING'),
fresh AS (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) + (SELECT MAX(customer_key) FROM known) AS customer_key FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT c_custkey, customer_key FROM known UNION ALL SELECT c_custkey, customer_key FROM fresh""")
def assign_new_keys(spark, sf):
    """Known members keep their keys; members met for the first time continue after the largest."""
    members = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    existing = warehouse.assign_keys(members.filter("c_mktsegment <> 'BUILDING'").select("c_custkey"), ["c_custkey"], "customer_key")
    return warehouse.assign_keys(members.select("c_custkey"), ["c_custkey"], "customer_key", existing)


@query("generate_facts", """
WITH years AS (SELECT DISTINCT CAST(YEAR(o_orderdate) AS INT) AS year FROM orders),
questions AS (SELECT DISTINCT p_size % 12 + 1 AS question_no FROM part),
cells AS (SELECT s_suppkey, question_no, year,
                 ROW_NUMBER() OVER (ORDER BY s_suppkey, question_no, year) - 1 AS cell_no
          FROM supplier CROSS JOIN questions CROSS JOIN years),
facts AS (SELECT c.*, CAST(r AS INT) AS respondent_no, cell_no * 2 + r AS response_id FROM cells c CROSS JOIN (VALUES (1), (2)) v(r))
SELECT s_suppkey, question_no, year, respondent_no, CAST(response_id AS BIGINT) AS response_id,
       CAST(ROUND(CAST(GREATEST(1.0, LEAST(5.0, 3.5 + (((response_id % 1000003) * 48271 + 7930) % 1000003 % 31 - 15) / 10.0)) AS DECIMAL(18,6)), 1) AS DOUBLE) AS score
FROM facts""")
def generated_facts(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    questions = question_config(spark, sf).select("question_no")
    suppliers = table(spark, sf, "supplier").select("s_suppkey")
    return generate_facts([suppliers, questions, years], [["s_suppkey"], ["question_no"], ["year"]], 2)


@query("dimension_product", """
SELECT s.s_suppkey, b.p_brand FROM supplier s CROSS JOIN (SELECT DISTINCT p_brand FROM part) b""")
def dimension_product(spark, sf):
    brands = table(spark, sf, "part").select("p_brand").distinct()
    suppliers = table(spark, sf, "supplier").select("s_suppkey")
    return joins.cross_cells([suppliers, brands], [["s_suppkey"], ["p_brand"]]).drop("cell_no")


@query("group_summary", with_survey(f"""
SELECT category, project, {pub('AVG(score)')} AS mean_score, CAST(MIN(score) AS DOUBLE) AS min_score, CAST(MAX(score) AS DOUBLE) AS max_score,
       {pub('STDDEV_SAMP(score)')} AS stddev_samp, {pub('STDDEV_POP(score)')} AS stddev_pop, COUNT(*) AS response_count
FROM survey GROUP BY category, project"""))
def group_summary(spark, sf):
    return agg.group_summary(survey(spark, sf), ["category", "project"], "score")


@query("distinct_counts", with_survey("""
SELECT department, COUNT(*) AS row_count, COUNT(DISTINCT respondent_id) AS distinct_respondent_id,
       COUNT(DISTINCT response_id) AS distinct_response_id, COUNT(DISTINCT question_no) AS distinct_question_no
FROM survey GROUP BY department"""))
def distinct_counts(spark, sf):
    return agg.distinct_counts(survey(spark, sf), ["department"], ["respondent_id", "response_id", "question_no"])


@query("sparsity", with_survey(f"""
, w AS (SELECT project, CASE WHEN raw_score BETWEEN 1 AND 5 THEN raw_score END AS valid_score,
               CASE WHEN category = 'Growth' THEN score END AS growth_score,
               CASE WHEN division = 'WEST' AND question_no = 1 THEN score END AS west_q1 FROM survey)
SELECT project, COUNT(*) AS row_count,
       COUNT(valid_score) AS filled_valid_score, {pub('100.0 * COUNT(valid_score) / COUNT(*)', 1)} AS pct_valid_score,
       COUNT(growth_score) AS filled_growth_score, {pub('100.0 * COUNT(growth_score) / COUNT(*)', 1)} AS pct_growth_score,
       COUNT(west_q1) AS filled_west_q1, {pub('100.0 * COUNT(west_q1) / COUNT(*)', 1)} AS pct_west_q1
FROM w GROUP BY project"""))
def sparsity(spark, sf):
    wide = survey(spark, sf).select(
        "project",
        F.when(F.col("raw_score").between(1, 5), F.col("raw_score")).alias("valid_score"),
        F.when(F.col("category") == "Growth", F.col("score")).alias("growth_score"),
        F.when((F.col("division") == "WEST") & (F.col("question_no") == 1), F.col("score")).alias("west_q1"),
    )
    return agg.sparsity(wide, ["valid_score", "growth_score", "west_q1"], ["project"])


@query("global_means", f"""
SELECT {pub('AVG(l_quantity)')} AS mean_l_quantity, {pub('AVG(l_extendedprice)')} AS mean_l_extendedprice, {pub('AVG(l_tax)')} AS mean_l_tax FROM lineitem""")
def global_means(spark, sf):
    return agg.global_means(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])


@query("filtered_mean", f"""
SELECT {pub('AVG(l_extendedprice)')} AS mean_score, COUNT(*) AS response_count FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_quantity >= 10 AND l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'""")
def filtered_mean(spark, sf):
    rows = table(spark, sf, "lineitem").filter(
        F.col("l_returnflag").isin("A", "R") & (F.col("l_quantity") >= 10) & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    )
    return agg.group_means(rows, [], "l_extendedprice")


@query("weighted_mean", with_survey(f"""
, g AS (SELECT department, category, AVG(score) AS m, COUNT(*) AS n FROM survey GROUP BY department, category)
SELECT department, {pub('SUM(m * n) / SUM(n)')} AS weighted_mean FROM g GROUP BY department"""))
def weighted_mean(spark, sf):
    cells = survey(spark, sf).groupBy("department", "category").agg(F.avg("score").alias("m"), F.count(F.lit(1)).alias("n"))
    return agg.weighted_mean(cells, "m", "n", ["department"])


@query("grain_check", with_survey(f"""
, g AS (SELECT team_id, project, location, AVG(score) AS m, SUM(score) AS s, COUNT(*) AS n FROM survey GROUP BY team_id, project, location)
SELECT {pub('AVG(m)')} AS avg_of_avgs, {pub('SUM(m * n) / SUM(n)')} AS weighted_mean, {pub('CAST(SUM(s) AS DOUBLE) / SUM(n)')} AS raw_mean FROM g"""))
def grain_check(spark, sf):
    return agg.grain_check(survey(spark, sf), ["team_id", "project", "location"], "score")


@query("additivity_report", with_survey(f"""
, g AS (SELECT team_id, AVG(score) AS m, COUNT(*) AS n, QUANTILE_CONT(CAST(score AS DOUBLE), 0.9) AS p FROM survey GROUP BY team_id)
SELECT CAST(SUM(n) AS BIGINT) AS total_responses, {pub('AVG(m)')} AS unweighted_mean, {pub('SUM(m * n) / SUM(n)')} AS weighted_mean,
       {pub('AVG(p)')} AS avg_of_percentiles, (SELECT {pub('QUANTILE_CONT(CAST(score AS DOUBLE), 0.9)')} FROM survey) AS raw_percentile FROM g"""))
def additivity_report(spark, sf):
    return agg.additivity_report(survey(spark, sf), ["team_id"], "score")


@query("percentiles", f"""
SELECT l_returnflag, {pub('QUANTILE_CONT(l_extendedprice, 0.25)', 4)} AS p25, {pub('QUANTILE_CONT(l_extendedprice, 0.5)', 4)} AS p50,
       {pub('QUANTILE_CONT(l_extendedprice, 0.9)', 4)} AS p90 FROM lineitem GROUP BY l_returnflag""")
def percentiles(spark, sf):
    out = agg.percentiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.9])
    return out.select("l_returnflag", *[publish(p, 4).alias(p) for p in ("p25", "p50", "p90")])


@query("order_stat_quantiles", """
WITH r AS (SELECT event_type, value, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value) - 1 AS pos,
                  COUNT(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, n AS response_count, MAX(CASE WHEN pos = n // 4 THEN value END) AS p25,
       MAX(CASE WHEN pos = n // 2 THEN value END) AS median, MAX(CASE WHEN pos = 3 * n // 4 THEN value END) AS p75
FROM r GROUP BY event_type, n""")
def order_stat_quantiles(spark, sf):
    return agg.order_stat_quantiles(table(spark, sf, "events"), ["event_type"], "value")


@query("score_distribution", with_survey("""
SELECT question_no, score AS value, COUNT(*) AS n FROM survey GROUP BY question_no, score"""))
def score_distribution(spark, sf):
    dist = agg.distribution(survey(spark, sf), ["question_no"], "score", [1, 2, 3, 4, 5])
    return dist.select("question_no", F.explode("distribution").alias("v", "n")).select("question_no", F.col("v").cast("int").alias("value"), "n").filter("n > 0")


@query("favorability", with_survey(f"""
SELECT question_no, COUNT(score) AS response_count, {pub('100.0 * COUNT(CASE WHEN score >= 4 THEN 1 END) / COUNT(score)', 1)} AS favorable_pct,
       {pub('100.0 * COUNT(CASE WHEN score <= 2 THEN 1 END) / COUNT(score)', 1)} AS unfavorable_pct FROM survey GROUP BY question_no"""))
def favorability(spark, sf):
    return agg.favorability(survey(spark, sf), ["question_no"], "score")


QUESTION_METRICS_SQL = with_survey(f"""
, r AS (SELECT team_id, question_no, score, ROW_NUMBER() OVER (PARTITION BY team_id, question_no ORDER BY score) - 1 AS pos,
               COUNT(*) OVER (PARTITION BY team_id, question_no) AS n FROM survey)
SELECT team_id, question_no, n AS response_count, {pub('AVG(score)')} AS mean_score, {pub('STDDEV_POP(score)')} AS std_dev,
       MIN(score) AS min_score, MAX(score) AS max_score,
       {pub('100.0 * COUNT(CASE WHEN score >= 4 THEN 1 END) / COUNT(score)', 1)} AS favorable_pct,
       {pub('100.0 * COUNT(CASE WHEN score <= 2 THEN 1 END) / COUNT(score)', 1)} AS unfavorable_pct,
       MAX(CASE WHEN pos = n // 4 THEN score END) AS p25, MAX(CASE WHEN pos = n // 2 THEN score END) AS median,
       MAX(CASE WHEN pos = 3 * n // 4 THEN score END) AS p75,
       {', '.join(f'COUNT(CASE WHEN score = {v} THEN 1 END) AS n_{v}' for v in range(1, 6))}
FROM r GROUP BY team_id, question_no, n""")


@query("question_metrics", QUESTION_METRICS_SQL)
def question_metrics(spark, sf):
    return agg.question_metrics(survey(spark, sf), ["team_id", "question_no"], "score").drop("distribution")


@query("dimension_slices", with_survey(f"""
, long AS (
  SELECT question_no, score, 'department' AS dimension, department AS value FROM survey UNION ALL
  SELECT question_no, score, 'project', project FROM survey UNION ALL
  SELECT question_no, score, 'location', location FROM survey)
SELECT question_no, dimension, value, {pub('AVG(score)')} AS mean_score, COUNT(score) AS response_count,
       {', '.join(f'COUNT(CASE WHEN score = {v} THEN 1 END) AS n_{v}' for v in range(1, 6))}
FROM long GROUP BY question_no, dimension, value"""))
def dimension_slices(spark, sf):
    return agg.dimension_slices(survey(spark, sf), ["department", "project", "location"], ["question_no"], "score")


_PROFILED = ["o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate"]


@query("cardinality_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_values FROM orders" for c in _PROFILED))
def cardinality_profile(spark, sf):
    return agg.cardinality_profile(table(spark, sf, "orders"), _PROFILED)


_GROWTH = ["team_id", "question_no", "project", "location", "year", "quarter"]


@query("cell_growth", with_survey(" UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INT) AS dimensions, CAST({' * '.join(f'COUNT(DISTINCT {d})' for d in _GROWTH[: i + 1])} AS BIGINT) AS potential_cells, "
    f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(_GROWTH[: i + 1])} FROM survey)) AS actual_cells FROM survey" for i in range(len(_GROWTH)))))
def cell_growth(spark, sf):
    return agg.cell_growth(survey(spark, sf), _GROWTH)


@query("benchmark_gap", with_survey(f"""
, g AS (SELECT team_name, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey GROUP BY team_name),
b AS (SELECT {pub('AVG(score)')} AS benchmark FROM survey)
SELECT team_name, mean_score, response_count, benchmark, {pub('mean_score - benchmark')} AS gap FROM g CROSS JOIN b"""))
def benchmark_gap(spark, sf):
    return agg.with_benchmark(survey(spark, sf), ["team_name"], "score")


@query("response_rate", f"""
SELECT c_nationkey AS team_id, COUNT(DISTINCT c_custkey) AS invited, COUNT(DISTINCT o_custkey) AS responded,
       {pub('CAST(COUNT(DISTINCT o_custkey) AS DOUBLE) / COUNT(DISTINCT c_custkey)', 4)} AS response_rate
FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON o_custkey = c_custkey GROUP BY c_nationkey""")
def response_rate(spark, sf):
    roster = table(spark, sf, "customer").select(F.col("c_custkey").alias("respondent_id"), F.col("c_nationkey").alias("team_id"))
    answered = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("respondent_id"))
    return agg.response_rate(answered.join(roster, "respondent_id"), roster, ["team_id"], "respondent_id")


@query("drill_down", with_survey(f"""
SELECT team_name, question_no, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey
WHERE department = 'ASIA' AND location IN ('1-URGENT', '2-HIGH') AND category = 'Teamwork' GROUP BY team_name, question_no"""))
def drill_down(spark, sf):
    filters = {"department": "ASIA", "location": ["1-URGENT", "2-HIGH"], "category": "Teamwork"}
    return agg.drill_down(survey(spark, sf), filters, ["team_name", "question_no"], "score")


@query("hot_dimension_sets", f"""
WITH log AS (SELECT CASE event_type WHEN 'view' THEN 'period,team' WHEN 'click' THEN 'category,department'
                    WHEN 'purchase' THEN 'category,period,team'
                    ELSE CASE WHEN user_id % 4 = 0 THEN 'location,team' ELSE 'period,team' END END AS dimension_set FROM events),
c AS (SELECT dimension_set, COUNT(*) AS queries FROM log GROUP BY dimension_set)
SELECT dimension_set, queries,
       {pub('100.0 * SUM(queries) OVER (ORDER BY queries DESC, dimension_set ROWS UNBOUNDED PRECEDING) / SUM(queries) OVER ()', 1)} AS cumulative_pct
FROM c""")
def hot_dimension_sets(spark, sf):
    """Events read as a query log: each event type asks for a set of dimensions, named in any order."""
    asked = (
        F.when(F.col("event_type") == "view", F.array(F.lit("team"), F.lit("period")))
        .when(F.col("event_type") == "click", F.array(F.lit("department"), F.lit("category")))
        .when(F.col("event_type") == "purchase", F.array(F.lit("team"), F.lit("category"), F.lit("period")))
        .when(F.col("user_id") % 4 == 0, F.array(F.lit("team"), F.lit("location")))
        .otherwise(F.array(F.lit("period"), F.lit("team")))
    )
    return agg.hot_dimension_sets(table(spark, sf, "events").select(asked.alias("dims")))


@query("top_k_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k_orders(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return agg.top_k(rows, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()], 10)


@query("distinct_groups", with_survey("SELECT DISTINCT team_name, location FROM survey"))
def distinct_groups(spark, sf):
    return agg.distinct_groups(survey(spark, sf), ["team_name", "location"])


@query("inline_lookup", """
SELECT category, COUNT(*) AS order_count FROM orders
JOIN (VALUES ('1-URGENT', 'hot'), ('2-HIGH', 'hot'), ('3-MEDIUM', 'warm'), ('5-LOW', 'cold')) v(o_orderpriority, category) USING (o_orderpriority)
GROUP BY category""")
def inline_lookup(spark, sf):
    mapping = {"1-URGENT": "hot", "2-HIGH": "hot", "3-MEDIUM": "warm", "5-LOW": "cold"}
    return joins.categorize(table(spark, sf, "orders"), mapping, "o_orderpriority").groupBy("category").agg(F.count(F.lit(1)).alias("order_count"))


@query("label_lookup", """
SELECT s.s_nationkey, COALESCE(n.n_name, CAST(s.s_nationkey AS VARCHAR)) AS n_name, COUNT(*) AS supplier_count
FROM supplier s LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON s.s_nationkey = n.n_nationkey GROUP BY 1, 2""")
def label_lookup(spark, sf):
    """Suppliers by nation name; nations missing from the lookup show their key."""
    labels = table(spark, sf, "nation").filter("n_regionkey <> 2").withColumnRenamed("n_nationkey", "s_nationkey")
    counts = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("supplier_count"))
    return joins.label_lookup(counts, labels, "s_nationkey", "n_name")


@query("expression_columns", """
SELECT o_orderkey, CAST(YEAR(o_orderdate) AS VARCHAR) || '-Q' || CAST(QUARTER(o_orderdate) AS VARCHAR) AS period_label,
       GREATEST(1.0, LEAST(5.0, o_totalprice / 100000.0)) AS clamped,
       CASE WHEN o_custkey % 5 + 1 >= 4 THEN 'favorable' WHEN o_custkey % 5 + 1 <= 2 THEN 'unfavorable' ELSE 'neutral' END AS band,
       CASE WHEN o_orderstatus = 'F' THEN 6 - (o_custkey % 5 + 1) ELSE o_custkey % 5 + 1 END AS reversed,
       CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'other' END AS state,
       o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' AS is_pressing,
       ((o_orderkey % 1000003) * 48271 + 23768) % 1000003 AS noise,
       CAST(ROUND(CAST(3.0 + SIN(o_orderkey % 100) AS DECIMAL(18,6)), 1) AS DOUBLE) AS wave,
       (['low', 'mid', 'high'])[CAST(o_custkey % 3 + 1 AS INT)] AS pick
FROM orders""")
def expression_columns(spark, sf):
    score = F.col("o_custkey") % 5 + 1
    return table(spark, sf, "orders").select(
        "o_orderkey",
        period_label("o_orderdate").alias("period_label"),
        clamp(F.col("o_totalprice") / 100000.0, 1.0, 5.0).alias("clamped"),
        likert_band(score).alias("band"),
        reverse_scale(score, F.col("o_orderstatus") == "F").alias("reversed"),
        simple_case("o_orderstatus", {"F": "closed", "O": "open"}, "other").alias("state"),
        (F.col("o_orderpriority").like("1%") | F.col("o_orderpriority").startswith("2")).alias("is_pressing"),
        lcg("o_orderkey", salt=3).alias("noise"),
        publish(F.lit(3.0) + F.sin(F.col("o_orderkey") % 100), 1).alias("wave"),
        F.element_at(F.array(F.lit("low"), F.lit("mid"), F.lit("high")), (F.col("o_custkey") % 3 + 1).cast("int")).alias("pick"),
    )


@query("reduction", with_survey(f"""
, g AS (SELECT DISTINCT team_id, category FROM survey)
SELECT (SELECT COUNT(*) FROM survey) AS raw_rows, COUNT(*) AS gold_rows, {pub('CAST((SELECT COUNT(*) FROM survey) AS DOUBLE) / COUNT(*)')} AS reduction_factor FROM g"""))
def volume_reduction(spark, sf):
    rows = survey(spark, sf)
    return reduction(rows, agg.group_means(rows, ["team_id", "category"], "score"))


@query("rank_teams", with_survey(f"""
SELECT team_name, {pub('SUM(score) * 1.0 / COUNT(score)', 4)} AS mean_score, RANK() OVER (ORDER BY SUM(score) * 1.0 / COUNT(score) DESC) AS rnk
FROM survey GROUP BY team_name"""))
def rank_teams(spark, sf):
    return ranking.rank_groups(survey(spark, sf), ["team_name"], "score")


@query("rank_respondents", with_survey(f"""
SELECT respondent_id, {pub('SUM(score) * 1.0 / COUNT(score)', 4)} AS mean_score, RANK() OVER (ORDER BY SUM(score) * 1.0 / COUNT(score) DESC) AS rnk
FROM survey GROUP BY respondent_id"""))
def rank_respondents(spark, sf):
    return ranking.rank_groups(survey(spark, sf), ["respondent_id"], "score")


@query("percent_rank_departments", with_survey(f"""
SELECT category, team_name, {pub('SUM(score) * 1.0 / COUNT(score)', 4)} AS mean_score,
       {pub('PERCENT_RANK() OVER (PARTITION BY category ORDER BY SUM(score) * 1.0 / COUNT(score) DESC)', 4)} AS pct_rank
FROM survey GROUP BY category, team_name"""))
def percent_rank_departments(spark, sf):
    return ranking.percent_rank_groups(survey(spark, sf), ["category"], ["team_name"], "score")


@query("period_trend", with_survey(f"""
, g AS (SELECT team_name, year, quarter, {pub('AVG(score)')} AS mean_score FROM survey GROUP BY team_name, year, quarter),
l AS (SELECT *, LAG(mean_score) OVER (PARTITION BY team_name ORDER BY year, quarter) AS prev_mean FROM g)
SELECT *, {pub('mean_score - prev_mean')} AS change FROM l"""))
def period_trend(spark, sf):
    return ranking.period_trend(survey(spark, sf), ["team_name"], ["year", "quarter"], "score")


@query("group_sizes", "SELECT o_orderkey, o_orderpriority, COUNT(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS group_size FROM orders")
def group_sizes(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return joins.with_group_size(rows, ["o_custkey", "o_orderpriority"]).drop("o_custkey")


@query("distinct_group_size", """
SELECT o_orderkey, g.group_size FROM orders JOIN
(SELECT o_orderpriority, o_orderstatus, COUNT(DISTINCT o_custkey) AS group_size FROM orders GROUP BY 1, 2) g USING (o_orderpriority, o_orderstatus)""")
def distinct_group_size(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    out = joins.with_distinct_group_size(rows, ["o_orderpriority", "o_orderstatus"], "o_custkey")
    return out.select("o_orderkey", "group_size")


@query("dedup_latest", """
SELECT * EXCLUDE (rn) FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,
 ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_latest(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return ranking.dedup_latest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])


@query("bronze_row_count", "SELECT COUNT(*) AS row_count, COUNT(DISTINCT l_orderkey * 10 + l_linenumber) AS response_ids FROM lineitem")
def bronze_row_count(spark, sf):
    return survey_bronze(spark, sf).agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("response_id").alias("response_ids"))
