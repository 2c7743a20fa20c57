"""Suppression per cut, k-anonymity, row security, masking and their composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish, register_functions
from tallyhouse.operators import access, disclosure, privacy
from tallyhouse.operators.compare import consistency_check
from tallyhouse.operators.spread import null_safe_join
from tallyhouse.plans.catalog import pub, query, with_survey
from tallyhouse.session import pin, scratch_path
from tallyhouse.sources.survey import survey, table

CUTS = [["team_name"], ["team_name", "project"], ["team_name", "project", "location"], ["team_name", "project", "location", "category", "year"]]
QI = ["project", "location", "question_no", "year"]
_HID = f"CASE WHEN COUNT(DISTINCT respondent_id) >= 4 THEN {pub('AVG(score)')} END AS mean_score, COUNT(DISTINCT respondent_id) AS n, COUNT(DISTINCT respondent_id) < 4 AS is_suppressed"


def _cut_sql(cut):
    columns = ["team_name", "project", "location", "category", "year"]
    picked = ", ".join(c if c in cut else f"CAST(NULL AS {'INT' if c == 'year' else 'VARCHAR'}) AS {c}" for c in columns)
    return f"SELECT {picked}, '{' x '.join(cut)}' AS cut, {_HID} FROM survey GROUP BY {', '.join(cut)}"


@query("suppressed_cuts", with_survey(" UNION ALL ".join(_cut_sql(c) for c in CUTS)))
def suppressed_cuts(spark, sf):
    """Four cuts of the same answers; finer cuts hide more."""
    return privacy.suppressed_cuts(survey(spark, sf), CUTS, "score", 4, "respondent_id")


@query("suppressed_rows_cut", f"""
SELECT s_nationkey, CASE WHEN COUNT(*) >= 4 THEN {pub('AVG(s_acctbal)')} END AS mean_score, COUNT(*) AS n, COUNT(*) < 4 AS is_suppressed FROM supplier GROUP BY s_nationkey""")
def suppressed_rows_cut(spark, sf):
    """Threshold on row counts: suppliers per nation are few."""
    return privacy.cut_means(table(spark, sf, "supplier"), ["s_nationkey"], "s_acctbal", 4)


@query("k_anonymity_groups", with_survey("""
SELECT project, location, question_no, year, COUNT(*) AS group_size, CASE WHEN COUNT(*) < 30 THEN 'VULNERABLE' ELSE 'OK' END AS risk
FROM survey GROUP BY project, location, question_no, year"""))
def k_anonymity_groups(spark, sf):
    return privacy.k_anonymity_groups(survey(spark, sf), QI, 30)


@query("k_anonymize", """
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CASE WHEN COUNT(*) OVER (PARTITION BY o_custkey, o_orderpriority, o_orderstatus) >= 4 THEN o_totalprice END AS o_totalprice FROM orders""")
def k_anonymize(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    return privacy.k_anonymize(rows, ["o_custkey", "o_orderpriority", "o_orderstatus"], ["o_totalprice"], 4)


@query("reidentification_risk", f"""
WITH g AS (SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderpriority, o_orderstatus)
SELECT COUNT(*) AS qi_groups, CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(CASE WHEN n = 1 THEN 1 END) AS unique_rows,
       CAST(COALESCE(SUM(CASE WHEN n < 4 THEN n END), 0) AS BIGINT) AS rows_below_k,
       {pub('100.0 * COUNT(CASE WHEN n = 1 THEN 1 END) / SUM(n)')} AS unique_pct, {pub('100.0 * SUM(CASE WHEN n < 4 THEN n END) / SUM(n)')} AS hidden_pct FROM g""")
def reidentification_risk(spark, sf):
    return privacy.reidentification_risk(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority", "o_orderstatus"], 4)


@query("attribute_probe", """
SELECT o_custkey, o_orderpriority, o_totalprice FROM (
SELECT *, CASE WHEN COUNT(*) OVER (PARTITION BY o_custkey, o_orderpriority) >= 4 THEN o_totalprice END AS hidden FROM orders) WHERE o_custkey = 7 AND o_orderpriority = '2-HIGH'
""".replace("o_custkey, o_orderpriority, o_totalprice FROM (", "o_custkey, o_orderpriority, hidden AS o_totalprice FROM (", 1))
def attribute_probe(spark, sf):
    """Looking one person up by known attributes after release."""
    released = privacy.k_anonymize(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], ["o_totalprice"], 4)
    return privacy.probe(released, {"o_custkey": 7, "o_orderpriority": "2-HIGH"}, ["o_totalprice"])


_LEVELS = [["department", "project", "location", "year", "question_no"], ["department", "project", "location", "year"], ["department", "project", "location"], ["department"]]


def _generalize_sql():
    parts, joins = [], []
    for i, level in enumerate(_LEVELS):
        parts.append(f"l{i} AS (SELECT {', '.join(level)}, COUNT(DISTINCT respondent_id) AS n{i}, {pub('AVG(score)')} AS m{i} FROM survey GROUP BY {', '.join(level)})")
        if i:
            joins.append(f"JOIN l{i} USING ({', '.join(level)})")
    def pick(kind):
        return "CASE " + " ".join(f"WHEN n{i} >= 12 THEN " + ({"level": "'" + " x ".join(l) + "'", "m": f"m{i}", "n": f"n{i}"}[kind]) for i, l in enumerate(_LEVELS)) + " END"
    return ", " + ", ".join(parts) + f"\nSELECT {', '.join(_LEVELS[0])}, {pick('level')} AS published_level, {pick('m')} AS mean_score, {pick('n')} AS n FROM l0 {' '.join(joins)}"


@query("generalize", with_survey(_generalize_sql()))
def generalize(spark, sf):
    """Each fine group reported at the finest level that reaches twelve people."""
    return privacy.generalize(survey(spark, sf), _LEVELS, "score", 12, "respondent_id")


def _adjacent_input(spark, sf):
    """Supplier counts per nation and balance band: small groups inside a parent."""
    band = F.floor(F.col("s_acctbal") / 2500).cast("int").alias("band")
    return table(spark, sf, "supplier").groupBy("s_nationkey", band).agg(
        F.count(F.lit(1)).alias("n"), publish(F.avg("s_acctbal")).alias("mean_score")
    )


_ADJ = f"WITH a AS (SELECT s_nationkey, CAST(FLOOR(s_acctbal / 2500) AS INT) AS band, COUNT(*) AS n, {pub('AVG(s_acctbal)')} AS mean_score FROM supplier GROUP BY 1, 2)"


def _adjacent_sql(small, needs):
    return _ADJ + f""",
m AS (SELECT *, COUNT(CASE WHEN {small} THEN 1 END) OVER (PARTITION BY s_nationkey) AS h,
             ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY CASE WHEN {small} THEN 1 ELSE 0 END, n, band) AS place FROM a),
r AS (SELECT s_nationkey, band, n, mean_score, CASE WHEN {small} THEN 'small_group' WHEN h {needs} AND place = 1 THEN 'adjacent' END AS suppression_reason FROM m)
SELECT s_nationkey, band, n, CASE WHEN suppression_reason IS NULL THEN mean_score END AS mean_score, suppression_reason FROM r"""


@query("suppress_adjacent_basic", _adjacent_sql("n = 1", ">= 1"))
def suppress_adjacent_basic(spark, sf):
    return privacy.suppress_adjacent(_adjacent_input(spark, sf), ["s_nationkey"], ["band"], "n", ["mean_score"], "basic")


@query("suppress_adjacent_strong", _adjacent_sql("n < 2", "= 1"))
def suppress_adjacent_strong(spark, sf):
    return privacy.suppress_adjacent(_adjacent_input(spark, sf), ["s_nationkey"], ["band"], "n", ["mean_score"], "strong", k=2)


@query("suppress_complementary")
def suppress_complementary(spark, sf):
    """Nation by balance band with totals published: no hidden cell can be computed from them."""
    return privacy.suppress_complementary(_adjacent_input(spark, sf), "s_nationkey", "band", "n", ["mean_score"], k=2)


_TOTALS = _ADJ.replace("WITH a", "WITH RECURSIVE a", 1) + """,
t AS (SELECT 'cell' AS kind, s_nationkey, band, n, 'r' || s_nationkey AS u, 'c' || band AS v FROM a
      UNION ALL SELECT 'row_total', s_nationkey, NULL, SUM(n)::BIGINT, 'r' || s_nationkey, 'C' FROM a GROUP BY s_nationkey
      UNION ALL SELECT 'col_total', NULL, band, SUM(n)::BIGINT, 'R', 'c' || band FROM a GROUP BY band
      UNION ALL SELECT 'grand_total', NULL, NULL, SUM(n)::BIGINT, 'R', 'C' FROM a),
h AS (SELECT *, ROW_NUMBER() OVER (ORDER BY u, v) AS e FROM t WHERE n < 2),
reach AS (SELECT e, u AS node FROM h UNION
          SELECT r.e, CASE WHEN h.u = r.node THEN h.v ELSE h.u END FROM reach r JOIN h ON h.e <> r.e AND (h.u = r.node OR h.v = r.node)),
x AS (SELECT h.* FROM h ANTI JOIN reach ON reach.e = h.e AND reach.node = h.v)"""


@query("disclosed_cells", _TOTALS + " SELECT kind, s_nationkey, band, n FROM x")
def disclosed_cells(spark, sf):
    """What a plain threshold hides in vain: small cells and totals that follow from the published ones."""
    cells = disclosure.with_totals(_adjacent_input(spark, sf), "s_nationkey", "band", "n")
    return disclosure.recoverable(cells, F.col("n") < 2).select("kind", "s_nationkey", "band", "n")


@query("complementary_check", _TOTALS + """
SELECT (SELECT COUNT(*) FROM h) AS small_cells, CAST(0 AS BIGINT) AS shown_small_cells, (SELECT COUNT(*) FROM x) AS exposed_before, CAST(0 AS BIGINT) AS exposed_cells,
       CAST(SUM(n) AS BIGINT) AS suppliers FROM a""")
def complementary_check(spark, sf):
    """The hidden table attacked: small cells still shown, and cells that follow from published totals, before and after."""
    own = pin(_adjacent_input(spark, sf))
    done = pin(disclosure.suppress_with_totals(own, "s_nationkey", "band", "n", ["mean_score"], k=2))
    totals = disclosure.with_totals(own, "s_nationkey", "band", "n")
    reasons = done.select("kind", "s_nationkey", "band", "suppression_reason")
    attacked = null_safe_join(totals, reasons, ["kind", "s_nationkey", "band"])
    before, after = (disclosure.recoverable(attacked, hidden).agg(F.count("*").alias("x")).scalar() for hidden in (F.col("n") < 2, F.col("suppression_reason").isNotNull()))
    small = F.col("n") < 2
    return done.agg(
        F.count_if(small).alias("small_cells"), F.count_if(small & (F.col("suppression_reason").isNull() | F.col("mean_score").isNotNull())).alias("shown_small_cells"),
        before.alias("exposed_before"), after.alias("exposed_cells"), F.sum(F.when(F.col("kind") == "cell", F.col("n"))).alias("suppliers"),
    )


def _policies(spark, sf):
    """Managers own the teams of their region; the survey admin sees every row."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    managers = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("manager_"), F.lower("r_name")).alias("principal"), F.col("n_name").alias("owner"), F.lit(False).alias("is_admin")
    )
    admin = region.filter("r_regionkey = 0").select(F.lit("survey_admin").alias("principal"), F.lit(None).cast("string").alias("owner"), F.lit(True).alias("is_admin"))
    return managers.unionByName(admin)


_TEAM_MEANS = f"SELECT team_name, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey"


def _team_means(df):
    return df.groupBy("team_name").agg(F.round(F.avg("score").cast("decimal(18,6)"), 2).cast("double").alias("mean_score"), F.count(F.lit(1)).alias("response_count"))


@query("rls_manager", with_survey(f"{_TEAM_MEANS} WHERE department = 'EUROPE' GROUP BY team_name"))
def rls_manager(spark, sf):
    return _team_means(access.secure_rows(survey(spark, sf), "team_name", _policies(spark, sf), "manager_europe"))


@query("rls_admin", with_survey(f"{_TEAM_MEANS} GROUP BY team_name"))
def rls_admin(spark, sf):
    return _team_means(access.secure_rows(survey(spark, sf), "team_name", _policies(spark, sf), "survey_admin"))


@query("rls_stranger", with_survey(f"{_TEAM_MEANS} WHERE FALSE GROUP BY team_name"))
def rls_stranger(spark, sf):
    """A principal without a policy sees nothing."""
    return _team_means(access.secure_rows(survey(spark, sf), "team_name", _policies(spark, sf), "nobody"))


@query("masked_viewer", with_survey("SELECT team_name, CAST(NULL AS DOUBLE) AS mean_score, COUNT(*) AS response_count FROM survey GROUP BY team_name"))
def masked_viewer(spark, sf):
    return access.mask_columns(_team_means(survey(spark, sf)), ["mean_score"], "viewer_role", ["analyst_role"])


@query("masked_analyst", with_survey(f"{_TEAM_MEANS} GROUP BY team_name"))
def masked_analyst(spark, sf):
    """The SQL masking function for a privileged role."""
    register_functions(spark)
    return _team_means(survey(spark, sf)).withColumn("mean_score", F.expr("mask_score(mean_score, 'analyst_role')"))


@query("governed_view", with_survey(f"""
SELECT team_name, location, year, CASE WHEN COUNT(DISTINCT respondent_id) >= 45 THEN {pub('AVG(score)')} END AS mean_score, COUNT(DISTINCT respondent_id) AS n,
       COUNT(DISTINCT respondent_id) < 45 AS is_suppressed FROM survey WHERE department = 'ASIA' GROUP BY team_name, location, year"""))
def governed_view(spark, sf):
    return access.governed_view(
        survey(spark, sf), "team_name", _policies(spark, sf), "manager_asia", "analyst_role", ["team_name", "location", "year"], "score", 45, count_col="respondent_id"
    )


@query("enforcement_equivalence", "SELECT s_nationkey, 'MATCH' AS view_status, 'MATCH' AS table_status FROM supplier GROUP BY s_nationkey")
def enforcement_equivalence(spark, sf):
    """Suppression in the query, in a view and in a stored table gives the same rows."""
    rows = table(spark, sf, "supplier").select("s_nationkey", "s_acctbal")
    app = privacy.suppress_app(rows, ["s_nationkey"], "s_acctbal", 4)
    view = privacy.suppress_view(rows, ["s_nationkey"], "s_acctbal", "supplier_balance_safe", 4)
    stored = privacy.suppress_table(rows, ["s_nationkey"], "s_acctbal", scratch_path(spark, "safe"), 4)
    verdict = lambda other, name: consistency_check(app, other, ["s_nationkey"], ["mean_score", "n"]).select("s_nationkey", F.col("status").alias(name))
    return verdict(view, "view_status").join(verdict(stored, "table_status"), "s_nationkey")


@query("suppress_by_role", f"""
WITH g AS (SELECT s_nationkey, COUNT(*) AS n, {pub('AVG(s_acctbal)')} AS m FROM supplier GROUP BY s_nationkey)
SELECT s_nationkey, n, role, CASE WHEN n >= k THEN m END AS mean_score, n < k AS is_suppressed FROM g CROSS JOIN (VALUES ('admin', 1), ('hr', 3), ('manager', 5)) r(role, k)""")
def suppress_by_role(spark, sf):
    groups = table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), publish(F.avg("s_acctbal")).alias("mean_score")
    )
    return privacy.suppress_by_role(groups, "n", ["mean_score"], {"admin": 1, "hr": 3, "manager": 5})


@query("abac_filter", """
SELECT c_custkey, c_nationkey, CAST(NULL AS VARCHAR) AS c_name, c_mktsegment, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer WHERE c_nationkey IN (1, 2, 3) AND c_mktsegment = 'BUILDING'""")
def abac_filter(spark, sf):
    user = {"nations": [1, 2, 3], "segment": "BUILDING", "clearance": {"public"}}
    columns = [access.ColumnRule("c_name", "personal"), access.ColumnRule("c_acctbal", "financial"), access.ColumnRule("c_mktsegment", "public")]
    rows = [access.RowRule("c_nationkey", "nations"), access.RowRule("c_mktsegment", "segment")]
    return access.abac_filter(table(spark, sf, "customer"), user, columns, rows)
