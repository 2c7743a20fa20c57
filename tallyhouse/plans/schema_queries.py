"""EAV, slot, JSON and wide forms; versioned dimensions; layout and pruning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions.columns import json_has_key, json_value, publish
from tallyhouse.operators import history, joins, layout, reshape
from tallyhouse.operators.aggregate import pivot_eav
from tallyhouse.plans.catalog import pub, query, with_eav, with_survey
from tallyhouse.plans.inputs import STANDARD, event_eav
from tallyhouse.session import scratch_path
from tallyhouse.sources.files import write_parquet
from tallyhouse.sources.survey import survey, table

IDS = ["entity_id", "project", "team"]
_STD = ", ".join(f"'{s}'" for s in STANDARD)
N_SLOTS = 8

# ---- encodings --------------------------------------------------------------


@query("eav_pivot", with_eav(f"SELECT team, {', '.join(pub(f'''AVG(CASE WHEN attribute = '{a}' THEN value END)''') + f' AS {a}_avg' for a in STANDARD)} FROM eav GROUP BY team"))
def eav_pivot(spark, sf):
    return pivot_eav(event_eav(spark, sf), ["team"], list(STANDARD))


@query("eav_from_wide", """
SELECT o_orderkey, a AS attribute, v AS value FROM (
 SELECT o_orderkey, 'price' AS a, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v FROM orders UNION ALL
 SELECT o_orderkey, 'year', CAST(YEAR(o_orderdate) AS DOUBLE) FROM orders UNION ALL
 SELECT o_orderkey, 'rush', CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE END FROM orders) WHERE v IS NOT NULL""")
def eav_from_wide(spark, sf):
    wide = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).alias("rush"),
    )
    return reshape.wide_to_eav(wide, ["o_orderkey"], ["price", "year", "rush"])


@query("wide_from_eav", with_eav(f"SELECT entity_id, project, team, {', '.join(f'''MAX(CASE WHEN attribute = '{a}' THEN value END) AS {a}''' for a in STANDARD)} FROM eav GROUP BY entity_id, project, team"))
def wide_from_eav(spark, sf):
    return reshape.eav_to_wide(event_eav(spark, sf), IDS, list(STANDARD))


@query("wide_from_eav_discovered", with_eav("SELECT entity_id, " + ", ".join(
    f"MAX(CASE WHEN attribute = '{a}' THEN value END) AS {a}" for a in (*STANDARD, *[f"x{p}_{i}" for p in range(3) for i in range(3)])) + " FROM eav GROUP BY entity_id"))
def wide_from_eav_discovered(spark, sf):
    """Every attribute found in the data becomes a column."""
    return reshape.eav_to_wide(event_eav(spark, sf), ["entity_id"])


@query("eav_to_json", with_eav("SELECT entity_id, attribute, value FROM eav"))
def eav_to_json(spark, sf):
    """Answers packed to one object per entity, then unpacked again."""
    packed = reshape.eav_to_json(event_eav(spark, sf), ["entity_id"])
    return reshape.json_to_eav(packed, ["entity_id"], "responses")


@query("json_to_eav", "SELECT event_id, 'k' AS attribute, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events")
def json_to_eav(spark, sf):
    return reshape.json_to_eav(table(spark, sf, "events").select("event_id", "props"), ["event_id"], "props")


@query("json_columns", """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(json_extract_string(props, '$.absent') AS DOUBLE) AS absent,
       CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS computed FROM events""")
def json_columns(spark, sf):
    """Static paths, an absent key, and a path that depends on the row."""
    rows = table(spark, sf, "events").select("event_id", "event_type", "props")
    typed = reshape.json_columns(rows, "props", {"k": "int", "absent": "double"})
    path = F.when(F.col("event_type") == "view", "k").otherwise("none")
    return typed.withColumn("computed", json_value("props", path)).drop("props")


@query("json_key_listing", "SELECT json_keys.attribute, COUNT(*) AS n FROM (SELECT UNNEST(json_keys(props)) AS attribute FROM events) json_keys GROUP BY 1")
def json_key_listing(spark, sf):
    return reshape.explode_keys(table(spark, sf, "events"), ["event_id"], "props").groupBy("attribute").agg(F.count(F.lit(1)).alias("n"))


@query("json_has_key", with_eav("SELECT entity_id FROM eav WHERE attribute = 'x1_2'"))
def json_with_key(spark, sf):
    packed = reshape.eav_to_json(event_eav(spark, sf), ["entity_id"])
    return reshape.json_has_key(packed, "responses", "x1_2").select("entity_id")


_MAPPING = f"""
, mapping AS (
  SELECT project, CAST(ROW_NUMBER() OVER (PARTITION BY project ORDER BY CASE WHEN attribute IN ({_STD}) THEN 0 ELSE 1 END, attribute) AS INT) AS slot_number,
         attribute AS question_id FROM (SELECT DISTINCT project, attribute FROM eav))
, slotted AS (SELECT e.entity_id, e.project, e.team, m.slot_number, e.value FROM eav e JOIN mapping m ON e.project = m.project AND e.attribute = m.question_id)
"""


@query("slots_from_eav", with_eav("SELECT entity_id, project, team, " + ", ".join(
    f"MAX(CASE WHEN slot_number = {i} THEN value END) AS slot_{i}" for i in range(1, N_SLOTS + 1)) + " FROM slotted GROUP BY entity_id, project, team", _MAPPING))
def slots_from_eav(spark, sf):
    return reshape.eav_to_slots(event_eav(spark, sf), IDS, "project", STANDARD, N_SLOTS)[0]


@query("slot_meaning", with_eav("SELECT project, slot_number, question_id FROM mapping WHERE slot_number IN (1, 5, 6, 8)", _MAPPING))
def slot_meaning(spark, sf):
    mapping = reshape.slot_mapping(event_eav(spark, sf), "project", STANDARD)
    return reshape.slot_meaning(mapping, "project", [1, 5, 6, 8])


@query("slot_overflow", with_eav("SELECT project, slot_number, question_id FROM mapping WHERE slot_number > 6", _MAPPING))
def slot_overflow(spark, sf):
    """Questions left over when only six slots exist."""
    return reshape.slot_overflow(reshape.slot_mapping(event_eav(spark, sf), "project", STANDARD), 6)


@query("slots_mean", with_eav(f"SELECT project, attribute AS question_id, {pub('AVG(value)')} AS mean_score, COUNT(*) AS response_count FROM eav GROUP BY project, attribute"))
def slots_mean(spark, sf):
    slots, mapping = reshape.eav_to_slots(event_eav(spark, sf), IDS, "project", STANDARD, N_SLOTS)
    return reshape.decode_slots(slots, mapping, IDS, "project", N_SLOTS)


@query("encoding_equivalence", with_eav(f"""
SELECT team, {pub("AVG(CASE WHEN attribute = 'click' THEN value END)")} AS click_avg, {pub("AVG(CASE WHEN attribute = 'view' THEN value END)")} AS view_avg,
       'MATCH' AS wide_status, 'MATCH' AS json_status, 'MATCH' AS slots_status FROM eav GROUP BY team"""))
def encoding_equivalence(spark, sf):
    return reshape.encoding_equivalence(event_eav(spark, sf), ["entity_id", "project"], "project", "team", ["click", "view"])


@query("eav_category_means", with_eav(f"""
SELECT category, {pub('AVG(value)')} AS mean_score, COUNT(*) AS response_count FROM eav
JOIN (VALUES ('click', 'Engage'), ('view', 'Engage'), ('purchase', 'Convert'), ('signup', 'Convert'), ('error', 'Trouble')) v(attribute, category) USING (attribute) GROUP BY category"""))
def eav_category_means(spark, sf):
    mapping = {"click": "Engage", "view": "Engage", "purchase": "Convert", "signup": "Convert", "error": "Trouble"}
    return reshape.eav_category_means(event_eav(spark, sf), mapping)


@query("questions_per_project", with_eav("SELECT project, COUNT(DISTINCT attribute) AS questions FROM eav GROUP BY project"))
def questions_per_project(spark, sf):
    return reshape.questions_per_project(event_eav(spark, sf), "project")


@query("add_attribute", with_eav("SELECT project, COUNT(DISTINCT attribute) + CASE WHEN project = 'P1' THEN 1 ELSE 0 END AS questions FROM eav GROUP BY project"))
def add_attribute(spark, sf):
    """One project asks a new question: rows are added, the schema stays."""
    eav = event_eav(spark, sf)
    new = eav.filter("project = 'P1'").select(*IDS, F.lit("new_question").alias("attribute"), F.col("value"))
    return reshape.questions_per_project(reshape.add_attribute(eav, new), "project")


@query("add_json_key", "SELECT event_id, CASE WHEN event_type = 'signup' THEN CAST(4.5 AS DOUBLE) END AS new_question, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def add_json_key(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "props")
    added = reshape.add_json_key(rows, "props", "new_question", F.when(F.col("event_type") == "signup", 4.5))
    return added.select("event_id", json_value("props", "new_question").alias("new_question"), json_value("props", "k").alias("k"))


@query("add_column", with_eav("SELECT entity_id, MAX(CASE WHEN attribute = 'click' THEN value END) AS click, CAST(NULL AS DOUBLE) AS new_question FROM eav GROUP BY entity_id"))
def add_column(spark, sf):
    return reshape.add_column(reshape.eav_to_wide(event_eav(spark, sf), ["entity_id"], ["click"]), "new_question")


@query("typed_flatten", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(json_extract_string(props, '$.comment') AS VARCHAR) AS comment FROM events")
def typed_flatten(spark, sf):
    meta = {
        "k": {"type": "int", "text": "How many?", "category": "Volume", "scale": "0-99"},
        "comment": {"type": "string", "text": "Anything else?", "category": "Open", "scale": "text"},
    }
    return reshape.typed_flatten(table(spark, sf, "events"), ["event_id"], "props", meta)


# ---- versioned dimensions ---------------------------------------------------

_LOG = """
WITH last_of_day AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, o_orderpriority,
         ROW_NUMBER() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn FROM orders),
seen AS (SELECT o_custkey, valid_from, o_orderpriority, LAG(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS prev FROM last_of_day WHERE rn = 1),
starts AS (SELECT * FROM seen WHERE prev IS NULL OR prev <> o_orderpriority),
versions AS (SELECT o_custkey, o_orderpriority, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY valid_from) AS version_no, valid_from,
         COALESCE(CAST(LEAD(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to,
         LEAD(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) IS NULL AS is_current FROM starts)
"""


def _versions(spark, sf):
    log = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return history.scd2_from_log(log, "o_custkey", "o_orderpriority", "o_orderdate", ["o_orderkey"])


@query("scd2_from_log", _LOG + "SELECT o_custkey, o_orderpriority, version_no, valid_from, valid_to, is_current FROM versions")
def scd2_from_log(spark, sf):
    """Each customer's priority over time as versions."""
    return _versions(spark, sf)


@query("scd2_overlaps", _LOG + "SELECT o_custkey, valid_from, valid_to, valid_from AS next_valid_from FROM versions WHERE valid_to < valid_from")
def scd2_overlaps(spark, sf):
    return history.version_overlaps(_versions(spark, sf), "o_custkey")


_ASOF = _LOG + ", facts AS (SELECT o_orderkey, o_custkey, o_orderdate + INTERVAL 45 DAY AS asked_on, o_totalprice FROM orders)"


@query("scd2_asof_join", _ASOF + """
SELECT f.o_orderkey, v.o_orderpriority, v.version_no, v.is_current FROM facts f JOIN versions v
ON f.o_custkey = v.o_custkey AND CAST(f.asked_on AS DATE) BETWEEN v.valid_from AND v.valid_to""")
def scd2_asof_join(spark, sf):
    """The priority in force 45 days after each order."""
    facts = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.expr("o_orderdate + INTERVAL 45 DAY").alias("asked_on"))
    joined = history.scd2_asof_join(facts, _versions(spark, sf), "o_custkey", "asked_on")
    return joined.select("o_orderkey", "o_orderpriority", "version_no", "is_current")


@query("scd2_history", _ASOF + f"""
SELECT f.o_custkey, CAST(v.valid_from AS VARCHAR) || ' to ' || CAST(v.valid_to AS VARCHAR) AS valid_range,
       CASE WHEN v.is_current THEN 'CURRENT' ELSE 'HISTORICAL' END AS version_status, {pub('AVG(f.o_totalprice)')} AS mean_score, COUNT(*) AS response_count
FROM facts f JOIN versions v ON f.o_custkey = v.o_custkey AND CAST(f.asked_on AS DATE) BETWEEN v.valid_from AND v.valid_to
GROUP BY f.o_custkey, v.valid_from, v.valid_to, v.is_current""")
def scd2_history(spark, sf):
    facts = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.expr("o_orderdate + INTERVAL 45 DAY").alias("asked_on"), "o_totalprice")
    joined = history.scd2_asof_join(facts, _versions(spark, sf), "o_custkey", "asked_on")
    return history.scd2_history(joined, ["o_custkey"], "o_totalprice")


@query("scd2_key_join", """
WITH dim AS (SELECT c_custkey * 10 + v AS customer_key, c_custkey, c_mktsegment || '-' || CAST(v AS VARCHAR) AS structure FROM customer, (VALUES (1), (2)) t(v)),
facts AS (SELECT o_custkey * 10 + CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 2 END AS customer_key FROM orders)
SELECT d.structure, COUNT(*) AS n FROM facts f JOIN dim d USING (customer_key) GROUP BY d.structure""")
def scd2_key_join(spark, sf):
    """Facts that carry the key of the version they were recorded under."""
    dim = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.explode(F.array(F.lit(1), F.lit(2))).alias("v")).select(
        (F.col("c_custkey") * 10 + F.col("v")).alias("customer_key"), F.concat("c_mktsegment", F.lit("-"), F.col("v").cast("string")).alias("structure")
    )
    era = F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), 1).otherwise(2)
    facts = table(spark, sf, "orders").select((F.col("o_custkey") * 10 + era).alias("customer_key"))
    return history.scd2_key_join(facts, dim, "customer_key").groupBy("structure").agg(F.count(F.lit(1)).alias("n"))


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")


def _moves(spark, sf):
    """A change feed: customers with a negative balance move to BUILDING."""
    return table(spark, sf, "customer").filter("c_acctbal < 0").select("c_custkey", F.lit("BUILDING").alias("c_mktsegment"))


@query("json_answers", """
SELECT event_id, k AS attribute, TRY_CAST(v AS DOUBLE) AS value, v AS answer FROM (
  SELECT event_id, UNNEST(['k', 'comment', 'site.visit']) AS k, UNNEST([json_extract_string(props, '$.k'), 'said ' || event_type, CAST(event_id % 7 AS VARCHAR)]) AS v FROM events)
WHERE v IS NOT NULL""")
def json_answers(spark, sf):
    """Objects get a text answer and a key with a dot, and every answer comes back as a row."""
    rows = table(spark, sf, "events").select("event_id", "event_type", "props")
    added = reshape.add_json_key(rows, "props", "comment", F.concat(F.lit("said "), "event_type"))
    added = reshape.add_json_key(added, "props", "site.visit", F.col("event_id") % 7)
    return reshape.json_to_eav(added, ["event_id"], "props", text="answer")


@query("scd1_apply", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'BUILDING' ELSE c_mktsegment END AS c_mktsegment FROM customer
UNION ALL SELECT -c_custkey - 1, NULL, 'NEW' FROM customer WHERE c_acctbal > 9000""")
def scd1_apply(spark, sf):
    added = table(spark, sf, "customer").filter("c_acctbal > 9000").select((-F.col("c_custkey") - 1).alias("c_custkey"), F.lit("NEW").alias("c_mktsegment"))
    return history.scd1_apply(_customers(spark, sf), _moves(spark, sf).unionByName(added), "c_custkey")


@query("scd2_apply", """
WITH log AS (
  SELECT c_custkey, DATE '2020-01-01' AS d, c_mktsegment AS s FROM customer
  UNION ALL SELECT c_custkey, DATE '2024-07-01', 'BUILDING' FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey, DATE '2024-09-15', CASE WHEN c_custkey % 2 = 0 THEN 'MACHINERY' ELSE 'BUILDING' END FROM customer WHERE c_acctbal < 0),
seen AS (SELECT *, LAG(s) OVER (PARTITION BY c_custkey ORDER BY d) AS before FROM log),
v AS (SELECT *, LEAD(d) OVER (PARTITION BY c_custkey ORDER BY d) AS next FROM seen WHERE before IS NULL OR before <> s),
added AS (SELECT *, ROW_NUMBER() OVER (ORDER BY c_custkey, d) AS i FROM v WHERE before IS NOT NULL)
SELECT c_custkey + 1 AS customer_key, c_custkey, s AS c_mktsegment, d AS valid_from, COALESCE(CAST(next - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to, next IS NULL AS is_current FROM v WHERE before IS NULL
UNION ALL SELECT (SELECT MAX(c_custkey) + 1 FROM customer) + i, c_custkey, s, d, COALESCE(CAST(next - INTERVAL 1 DAY AS DATE), DATE '9999-12-31'), next IS NULL FROM added""")
def scd2_apply(spark, sf):
    dim = table(spark, sf, "customer").select(
        (F.col("c_custkey") + 1).alias("customer_key"), "c_custkey", "c_mktsegment",
        F.lit("2020-01-01").cast("date").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"), F.lit(True).alias("is_current"),
    )
    first = _moves(spark, sf).withColumn("changed_on", F.lit("2024-07-01").cast("date"))
    even = F.when(F.col("c_custkey") % 2 == 0, "MACHINERY").otherwise("BUILDING")
    changes = first.unionByName(first.select("c_custkey", even.alias("c_mktsegment"), F.lit("2024-09-15").cast("date").alias("changed_on")))
    return history.scd2_apply(dim, changes, "c_custkey", ["c_mktsegment"], "changed_on", "customer_key")


@query("scd3_apply", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'BUILDING' ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_acctbal < 0 AND c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS previous_c_mktsegment FROM customer""")
def scd3_apply(spark, sf):
    return history.scd3_apply(_customers(spark, sf), _moves(spark, sf), "c_custkey", "c_mktsegment")


# ---- layout -----------------------------------------------------------------


def _two_copies(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    root = scratch_path(spark, "copies")
    rows.repartition(8, "l_orderkey").write.parquet(f"{root}/unsorted")
    layout.cluster_by(rows, ["l_suppkey"], f"{root}/sorted", files=8)
    return root


@query("clustered_read", "SELECT l_suppkey, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem WHERE l_suppkey BETWEEN 3 AND 5 GROUP BY l_suppkey")
def clustered_read(spark, sf):
    root = _two_copies(spark, sf)
    rows = spark.read.parquet(f"{root}/sorted").filter(F.col("l_suppkey").between(3, 5))
    return rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


_ENCODED = ["o_orderstatus", "o_orderpriority", "clerk"]


@query("encoding_profile", "WITH o AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 50 END AS clerk FROM orders), p AS (SELECT o_orderstatus, o_orderpriority, clerk, "
       + ", ".join(f"LAG({c}) OVER w AS prev_{c}" for c in _ENCODED)
       + ", ROW_NUMBER() OVER w AS rn FROM o WINDOW w AS (ORDER BY o_orderstatus, o_orderdate, o_orderkey)) "
       + " UNION ALL ".join(
           f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_values, COUNT(CASE WHEN rn = 1 OR {c} IS DISTINCT FROM prev_{c} THEN 1 END) AS runs, "
           f"{pub(f'100.0 * COUNT(CASE WHEN {c} IS NULL THEN 1 END) / COUNT(*)', 1)} AS null_pct FROM p" for c in _ENCODED))
def encoding_profile(spark, sf):
    """Distinct values, runs and NULL share when orders are stored by status and date."""
    rows = table(spark, sf, "orders").withColumn("clerk", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_custkey") % 50))
    return layout.encoding_profile(rows, _ENCODED, ["o_orderstatus", "o_orderdate", "o_orderkey"])


@query("partition_pruned", with_survey(f"SELECT year, category, {pub('AVG(score)')} AS mean_score, COUNT(*) AS response_count FROM survey WHERE year = 1997 GROUP BY year, category"))
def partition_pruned(spark, sf):
    """Facts stored by year; one year is read."""
    path = scratch_path(spark, "by-year")
    write_parquet(survey(spark, sf).select("response_id", "category", "score", "year"), path, partition_by=["year"])
    rows = layout.pruned(spark.read.parquet(path), "year", [1997])
    return rows.groupBy("year", "category").agg(publish(F.avg("score")).alias("mean_score"), F.count(F.lit(1)).alias("response_count"))


@query("json_filter", "SELECT event_type, COUNT(*) AS n FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY event_type")
def json_filter(spark, sf):
    return table(spark, sf, "events").filter(json_has_key("props", "k")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("orphan_categories", with_eav("SELECT entity_id, attribute FROM eav WHERE attribute NOT IN ('click', 'view', 'purchase', 'signup', 'error')"))
def orphan_categories(spark, sf):
    """Answers to questions the shared questionnaire does not know."""
    known = joins.literal_rows(spark, [(s,) for s in STANDARD], "attribute string")
    return joins.orphans(event_eav(spark, sf), "attribute", known.withColumnRenamed("attribute", "question"), "question").select("entity_id", "attribute")
