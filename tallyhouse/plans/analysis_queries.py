"""Statistics and models, and streaming runs checked against their batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators import stats
from tallyhouse.plans.catalog import pub, query, with_survey
from tallyhouse.session import scratch_path
from tallyhouse.sources.schemas import EVENTS
from tallyhouse.sources.survey import survey, table
from tallyhouse.streaming import ingest

# ---- statistics -------------------------------------------------------------


@query("pearson", f"SELECT l_returnflag, {pub('CORR(l_quantity, l_extendedprice)', 4)} AS r, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag")
def pearson(spark, sf):
    return stats.pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])


DRIVERS = ["basic_needs", "individual", "teamwork", "growth"]
_WIDE = """
, wide AS (SELECT department, respondent_id, AVG(score) AS engagement,
  AVG(CASE WHEN category = 'Basic Needs' THEN score END) AS basic_needs, AVG(CASE WHEN category = 'Individual' THEN score END) AS individual,
  AVG(CASE WHEN category = 'Teamwork' THEN score END) AS teamwork, AVG(CASE WHEN category = 'Growth' THEN score END) AS growth
  FROM survey GROUP BY department, respondent_id)
"""


def respondent_means(spark, sf):
    """Per person: overall mean as engagement, and the mean of each category."""
    means = [F.avg(F.when(F.lower(F.replace("category", F.lit(" "), F.lit("_"))) == d, F.col("score"))).alias(d) for d in DRIVERS]
    return survey(spark, sf).groupBy("department", "respondent_id").agg(F.avg("score").alias("engagement"), *means)


@query("driver_correlations", with_survey(_WIDE + ", scored AS (" + " UNION ALL ".join(
    f"SELECT department, '{d}' AS driver, COUNT({d}) AS n, {pub(f'CORR(engagement, {d})', 4)} AS r, {pub(f'CORR(engagement, {d}) * CORR(engagement, {d})', 4)} AS r_squared FROM wide GROUP BY department"
    for d in DRIVERS) + ") SELECT *, ROW_NUMBER() OVER (PARTITION BY department ORDER BY r_squared DESC, driver) AS driver_rank FROM scored"))
def driver_correlations(spark, sf):
    return stats.driver_analysis(respondent_means(spark, sf), "engagement", DRIVERS, ["department"])


def _regression_sql() -> str:
    """Normal equations in SQL: the covariance matrix swept once per driver; the target is the last row."""
    columns = [*DRIVERS, "engagement"]
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    cells = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, COVAR_POP({a}, {b}) AS v FROM whole" for i, a in enumerate(columns) for j, b in enumerate(columns))
    steps = [f"whole AS (SELECT * FROM wide WHERE {whole})", f"a0 AS ({cells})"]
    for k in range(len(DRIVERS)):
        steps.append(f"""a{k + 1} AS (SELECT x.i, x.j, CASE WHEN x.i = {k} AND x.j = {k} THEN -1 / d.v WHEN x.i = {k} OR x.j = {k} THEN x.v / d.v ELSE x.v - r.v * c.v / d.v END AS v
          FROM a{k} x JOIN a{k} d ON d.i = {k} AND d.j = {k} JOIN a{k} r ON r.i = x.i AND r.j = {k} JOIN a{k} c ON c.i = {k} AND c.j = x.j)""")
    n = len(DRIVERS)
    names = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DRIVERS))
    fit = f"1 - (SELECT v FROM a{n} WHERE i = {n} AND j = {n}) / (SELECT v FROM a0 WHERE i = {n} AND j = {n})"
    return with_survey(_WIDE + ", " + ", ".join(steps) + f" SELECT CASE i {names} END AS driver, {pub('v', 4)} AS coefficient, {pub(fit, 4)} AS r_squared FROM a{n} WHERE j = {n} AND i < {n}")


@query("driver_regression", _regression_sql())
def driver_regression(spark, sf):
    """Weight of each category in a regression of engagement on all four."""
    model = stats.multi_driver_regression(respondent_means(spark, sf), "engagement", DRIVERS)
    rows = [(d, round(float(c), 4), round(model.summary.r2, 4)) for d, c in zip(DRIVERS, model.coefficients, strict=True)]
    return spark.createDataFrame(rows, "driver string, coefficient double, r_squared double")


@query("segment_drivers", f"""
WITH r AS (SELECT l_returnflag AS g, CAST(l_extendedprice AS DOUBLE) AS y, CAST(l_quantity AS DOUBLE) AS a, CAST(l_discount AS DOUBLE) AS b FROM lineitem
  WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL),
m AS (SELECT g, COUNT(*) AS n, VAR_POP(a) AS aa, COVAR_POP(a, b) AS ab, VAR_POP(b) AS bb, COVAR_POP(a, y) AS ay, COVAR_POP(b, y) AS by_, VAR_POP(y) AS yy FROM r GROUP BY g),
c AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS ka, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS kb FROM m),
s AS (SELECT g, n, 'l_quantity' AS driver, ka AS k, ka * ay / yy AS share FROM c UNION ALL SELECT g, n, 'l_discount', kb, kb * by_ / yy FROM c)
SELECT g AS l_returnflag, driver, n, {pub('k', 4)} AS coefficient, {pub('share', 4)} AS share, {pub('SUM(share) OVER (PARTITION BY g)', 4)} AS r_squared,
       ROW_NUMBER() OVER (PARTITION BY g ORDER BY share DESC, driver) AS driver_rank FROM s""")
def segment_drivers(spark, sf):
    """Price explained by quantity and discount together, per return flag, ranked by their share."""
    return stats.segment_regression(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"], ["l_returnflag"])


def _t_tail(t: str, dof: str) -> str:
    """Two-sided probability of t by Simpson's rule over the density."""
    steps = 20000
    return f"""(SELECT 1 - 2 * SUM(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
      * EXP(LGAMMA((v + 1) / 2) - LGAMMA(v / 2) - 0.5 * LN(v * PI()) - (v + 1) / 2 * LN(1 + (x * i / {steps}) * (x * i / {steps}) / v))) * x / {3 * steps}
      FROM (SELECT ABS({t}) AS x, {dof} AS v), range({steps + 1}) r(i) GROUP BY x, v)"""


_T = "(a.m - b.m) / SQRT(a.v / a.n + b.v / b.n)"
_DOF = "(a.v / a.n + b.v / b.n) * (a.v / a.n + b.v / b.n) / ((a.v / a.n) * (a.v / a.n) / (a.n - 1) + (b.v / b.n) * (b.v / b.n) / (b.n - 1))"


@query("t_statistic", f"""
WITH g AS (SELECT o_orderstatus AS g, COUNT(*) AS n, AVG(o_totalprice) AS m, VAR_SAMP(o_totalprice) AS v FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1),
a AS (SELECT * FROM g WHERE g = 'F'), b AS (SELECT * FROM g WHERE g = 'O')
SELECT a.g AS group_a, b.g AS group_b, {pub(_T, 4)} AS t,
 {pub(_DOF)} AS dof, {pub(_t_tail(_T, _DOF), 6)} AS p_value FROM a CROSS JOIN b""")
def t_statistic(spark, sf):
    return stats.t_statistic(table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "O")), "o_orderstatus", "o_totalprice")


_F = """(SELECT SUM(n * (m - gm) * (m - gm)) / (COUNT(*) - 1) FROM g) / (SELECT SUM((n - 1) * v) / (SUM(n) - COUNT(*)) FROM g)"""
_ANOVA = """WITH g0 AS (SELECT o_orderpriority, COUNT(*) AS n, AVG(o_totalprice) AS m, VAR_SAMP(o_totalprice) AS v FROM orders GROUP BY 1),
g AS (SELECT *, (SELECT SUM(n * m) / SUM(n) FROM g0) AS gm FROM g0)"""


# with five groups the F tail has a closed form: I_y(w / 2, 2) = y^(w / 2) * (1 + w / 2 * (1 - y)), y = w / (w + 4 F)
_F_TAIL = f"""(SELECT POWER(y, w / 2) * (1 + w / 2 * (1 - y)) FROM (SELECT w, w / (w + 4 * f) AS y FROM (SELECT (SELECT SUM(n) - COUNT(*) FROM g)::DOUBLE AS w, {_F} AS f)))"""


@query("anova_f", f"{_ANOVA} SELECT COUNT(*) - 1 AS df_between, CAST(SUM(n) - COUNT(*) AS BIGINT) AS df_within, {pub(_F, 4)} AS f, {pub(_F_TAIL, 6)} AS p_value FROM g")
def anova_f(spark, sf):
    return stats.anova_f(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")


_CHI = """WITH c AS (SELECT o_orderpriority AS a, o_orderstatus AS b, COUNT(*) AS o FROM orders GROUP BY 1, 2),
e AS (SELECT c.*, CAST(SUM(o) OVER (PARTITION BY a) AS DOUBLE) * SUM(o) OVER (PARTITION BY b) / SUM(o) OVER () AS x FROM c)"""


# eight degrees of freedom: the tail is a finite sum
_CHI2 = "SUM((o - x) * (o - x) / x)"
_CHI_TAIL = f"EXP(-{_CHI2} / 2) * (1 + {_CHI2} / 2 + POWER({_CHI2} / 2, 2) / 2 + POWER({_CHI2} / 2, 3) / 6)"


@query("chi_squared", f"{_CHI} SELECT {pub(_CHI2)} AS chi2, (COUNT(DISTINCT a) - 1) * (COUNT(DISTINCT b) - 1) AS dof, CAST(SUM(o) AS BIGINT) AS n, {pub(_CHI_TAIL, 6)} AS p_value FROM e")
def chi_squared(spark, sf):
    return stats.chi_squared(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


_R_TAIL = _t_tail("r * SQRT((n - 2) / (1 - r * r))", "n - 2")


@query("auto_test", f"""
SELECT 'pearson' AS test, {pub('r', 4)} AS statistic, {pub(_R_TAIL, 6)} AS p_value FROM (SELECT CORR(o_custkey, o_totalprice) AS r, COUNT(*)::DOUBLE AS n FROM orders)
UNION ALL SELECT 'anova', * FROM ({_ANOVA} SELECT {pub(_F, 4)}, {pub(_F_TAIL, 6)})
UNION ALL SELECT 'chi_squared', * FROM ({_CHI} SELECT {pub(_CHI2)}, {pub(_CHI_TAIL, 6)} FROM e)""")
def auto_test(spark, sf):
    """The test for three column pairs, chosen from their types and cardinality."""
    rows = table(spark, sf, "orders")
    pairs = [("o_custkey", "o_totalprice"), ("o_orderpriority", "o_totalprice"), ("o_orderpriority", "o_orderstatus")]
    out = None
    for a, b in pairs:
        one = stats.auto_test(rows, a, b)
        out = one if out is None else out.unionByName(one)
    return out


@query("attrition_model")
def attrition_model(spark, sf):
    """Risk per customer from order behaviour; a customer with a negative balance counts as lost."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), (F.avg("o_totalprice") / 1000).alias("mean_price"), F.avg((F.col("o_orderpriority") == "1-URGENT").cast("double")).alias("urgent_share")
    )
    people = table(spark, sf, "customer").join(orders, "c_custkey", "left").na.fill(0).withColumn("left_us", F.col("c_acctbal") < 0)
    features = ["orders", "mean_price", "urgent_share"]
    model = stats.attrition_model(people, features, "left_us")
    return stats.attrition_scores(model, people, ["c_custkey"], features)


# ---- streams ----------------------------------------------------------------


def _at(day: str):
    return F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz")


def _stage(rows, cuts) -> str:
    """Files written one arrival after the other, so the stream reads them in that order."""
    path = scratch_path(rows.sparkSession, "arrivals")
    for condition in cuts:
        rows.filter(condition).repartitionByRange(4, "ts").write.mode("append").parquet(path)
    return path


@query("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events WHERE NOT (ts < TIMESTAMP '2024-01-05 00:00:00' AND event_id % 10 = 0)")
def stream_dedup(spark, sf):
    """Two arrivals that overlap by five days, and a third of old events, sent again or for the first time: each
    event is kept once, and what comes behind the watermark is rejected."""
    old = F.col("ts") < _at("05")
    held = old & (F.col("event_id") % 10 == 0)
    path = _stage(table(spark, sf, "events"), [(F.col("ts") < _at("18")) & ~held, F.col("ts") >= _at("13"), held | (old & (F.col("event_id") % 3 == 0))])
    source = ingest.stream_bronze(spark, path, EVENTS, "ts", files_per_batch=4)
    unique = ingest.stream_dedup(source, ["event_id"], "ts", "6 days")
    return ingest.drain(unique, scratch_path(spark, "unique"), scratch_path(spark, "ckpt")).select("event_id", "user_id", "event_type", "value")


@query("stream_dedup_hot", "SELECT event_id AS key, COUNT(*) AS rows_kept FROM (SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN -1 ELSE event_id END AS event_id FROM events) GROUP BY 1")
def stream_dedup_hot(spark, sf):
    """A feed in which one key is half of all rows: its copies are thinned in many tasks before they meet in one."""
    hot = table(spark, sf, "events").withColumn("event_id", F.when(F.col("event_id") % 2 == 0, -1).otherwise(F.col("event_id")))
    path = _stage(hot, [F.col("ts") < _at("18"), F.col("ts") >= _at("18")])
    source = ingest.stream_bronze(spark, path, EVENTS, "ts", files_per_batch=4, arrival="_arrival")
    unique = ingest.stream_dedup(source, ["event_id"], "ts", "40 days", arrival="_arrival")
    kept = ingest.drain(unique, scratch_path(spark, "unique"), scratch_path(spark, "ckpt"))
    return kept.groupBy(F.col("event_id").alias("key")).agg(F.count("*").alias("rows_kept"))


@query("stream_gold", f"""
SELECT DATE_TRUNC('day', ts)::TIMESTAMP AS window_start, event_type, {pub('SUM(CAST(value AS DECIMAL(18,4)))::DOUBLE / COUNT(*)')} AS mean_value, COUNT(*) AS n FROM events
WHERE NOT (ts < TIMESTAMP '2024-01-05 00:00:00' AND event_id % 10 = 0) GROUP BY 1, 2""")
def stream_gold(spark, sf):
    """Daily means per event type kept by the stream over several arrivals, compacted in between; windows behind the watermark are closed."""
    held = (F.col("ts") < _at("05")) & (F.col("event_id") % 10 == 0)
    path = _stage(table(spark, sf, "events"), [(F.col("ts") < _at("12")) & ~held, (F.col("ts") >= _at("12")) & (F.col("ts") < _at("22"))])
    source = ingest.stream_bronze(spark, path, EVENTS, "ts", files_per_batch=4)
    out = scratch_path(spark, "gold")
    checkpoint = scratch_path(spark, "ckpt")
    ingest.stream_gold(source, "ts", "1 day", ["event_type"], "value", "3 days", out, checkpoint).awaitTermination()
    ingest.compact_gold(spark, out, ["event_type"])
    table(spark, sf, "events").filter((F.col("ts") >= _at("22")) | held).repartitionByRange(4, "ts").write.mode("append").parquet(path)
    ingest.stream_gold(source, "ts", "1 day", ["event_type"], "value", "3 days", out, checkpoint).awaitTermination()
    means = ingest.published_means(ingest.read_gold(spark, out, ["event_type"]), ["event_type"])
    return means.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_late_rows", """
WITH first_arrival AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00' AND event_type <> 'error')
SELECT event_id, event_type = 'error' AND ts < TIMESTAMP '2024-01-25 00:00:00' AND ts <= (SELECT MAX(ts) FROM first_arrival) - INTERVAL 3 DAY AS is_late FROM events""")
def stream_late_rows(spark, sf):
    """Early error events arrive with the second delivery; those past the margin are kept apart."""
    first = (F.col("ts") < _at("25")) & (F.col("event_type") != "error")
    path = _stage(table(spark, sf, "events"), [first, ~first])
    source = ingest.stream_bronze(spark, path, EVENTS, "ts", files_per_batch=4)
    out = scratch_path(spark, "arrived")
    ingest.stream_split_late(source, "ts", "3 days", out, scratch_path(spark, "ckpt")).awaitTermination()
    side = lambda name, late: spark.read.option("recursiveFileLookup", True).schema(source.schema).parquet(f"{out}/{name}").select("event_id", F.lit(late).alias("is_late"))
    return side("on_time", False).unionByName(side("late", True))


@query("batch_windows", f"SELECT DATE_TRUNC('day', ts)::TIMESTAMP AS window_start, user_id, {pub('SUM(CAST(value AS DECIMAL(18,4)))::DOUBLE / COUNT(*)')} AS mean_value, COUNT(*) AS n FROM events GROUP BY 1, 2")
def batch_windows(spark, sf):
    rows = table(spark, sf, "events")
    return ingest.published_means(ingest.windowed_means(rows, "ts", "1 day", ["user_id"], "value"), ["user_id"])


@query("team_attrition_signal", with_survey(f"""
, p AS (SELECT team_name, respondent_id, AVG(CASE WHEN year < 1998 THEN score END) AS early, AVG(CASE WHEN year >= 1998 THEN score END) AS late FROM survey GROUP BY team_name, respondent_id)
SELECT team_name, {pub('CORR(early, late)', 4)} AS r, COUNT(*) AS n FROM p WHERE early IS NOT NULL AND late IS NOT NULL GROUP BY team_name"""))
def team_attrition_signal(spark, sf):
    """Correlation of people's early and late means per team."""
    halves = survey(spark, sf).groupBy("team_name", "respondent_id").agg(
        F.avg(F.when(F.col("year") < 1998, F.col("score"))).alias("early"), F.avg(F.when(F.col("year") >= 1998, F.col("score"))).alias("late")
    )
    return stats.pearson(halves, "early", "late", ["team_name"])
