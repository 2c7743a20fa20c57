"""The given order tables read as survey responses: one row per answered question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import bounded_tasks, stored_size
from tallyhouse.sources.schemas import TABLES

CATEGORIES = ("Basic Needs", "Individual", "Teamwork", "Growth")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with its declared schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team dimension: nation as team, region as department, two divisions."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("team_id"),
        F.col("n_name").alias("team_name"),
        F.col("r_name").alias("department"),
        F.when(F.col("r_name").isin("AMERICA", "EUROPE"), "WEST").otherwise("EAST").alias("division"),
    )


def category_of(question_no):
    """Fixed block structure of the twelve-question instrument: 2, 4, 4 and 2 questions."""
    return (
        F.when(question_no <= 2, "Basic Needs")
        .when(question_no <= 6, "Individual")
        .when(question_no <= 10, "Teamwork")
        .otherwise("Growth")
    )


def question_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part as the asked item; each item carries one of twelve questions."""
    number = F.col("p_size") % 12 + 1
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey"),
        number.alias("question_no"),
        category_of(number).alias("category"),
        (number == 6).alias("is_reverse_scored"),
    )


def respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.join(teams(spark, sf_dir), customer.c_nationkey == F.col("team_id")).select(
        F.col("c_custkey").alias("respondent_id"),
        "team_id",
        "team_name",
        "department",
        "division",
        F.col("c_mktsegment").alias("project"),
    )


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey view. Dimensions are joined to each other first, so the fact moves only twice."""
    lines = table(spark, sf_dir, "lineitem")
    bounded_tasks(spark, stored_size(lines))
    orders = table(spark, sf_dir, "orders")
    people = respondents(spark, sf_dir)
    sessions = orders.join(people, orders.o_custkey == people.respondent_id).select(
        "o_orderkey",
        "respondent_id",
        "team_id",
        "team_name",
        "department",
        "division",
        "project",
        F.col("o_orderpriority").alias("location"),
        F.year("o_orderdate").alias("year"),
        F.quarter("o_orderdate").alias("quarter"),
    )
    items = question_items(spark, sf_dir)
    answers = lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    quantity = F.col("l_quantity").cast("int")
    return (
        answers.join(items, answers.l_partkey == items.p_partkey)
        .join(sessions, F.col("l_orderkey") == sessions.o_orderkey)
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("response_id"),
            "respondent_id",
            "team_id",
            "team_name",
            "department",
            "division",
            "project",
            "location",
            "question_no",
            "category",
            "is_reverse_scored",
            (quantity % 7).alias("raw_score"),
            (quantity % 5 + 1).alias("score"),
            "year",
            "quarter",
            F.col("l_shipdate").alias("submitted_at"),
        )
    )


SURVEY_SQL = """
SELECT l.l_orderkey * 10 + l.l_linenumber               AS response_id,
       o.o_custkey                                      AS respondent_id,
       c.c_nationkey                                    AS team_id,
       n.n_name                                         AS team_name,
       r.r_name                                         AS department,
       CASE WHEN r.r_name IN ('AMERICA', 'EUROPE') THEN 'WEST' ELSE 'EAST' END AS division,
       c.c_mktsegment                                   AS project,
       o.o_orderpriority                                AS location,
       p.p_size % 12 + 1                                AS question_no,
       CASE WHEN p.p_size % 12 + 1 <= 2  THEN 'Basic Needs'
            WHEN p.p_size % 12 + 1 <= 6  THEN 'Individual'
            WHEN p.p_size % 12 + 1 <= 10 THEN 'Teamwork'
            ELSE 'Growth' END                           AS category,
       p.p_size % 12 + 1 = 6                            AS is_reverse_scored,
       CAST(l.l_quantity AS INT) % 7                    AS raw_score,
       CAST(l.l_quantity AS INT) % 5 + 1                AS score,
       CAST(YEAR(o.o_orderdate) AS INT)                 AS year,
       CAST(QUARTER(o.o_orderdate) AS INT)              AS quarter,
       l.l_shipdate                                     AS submitted_at
FROM lineitem l
JOIN orders o   ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n   ON c.c_nationkey = n.n_nationkey
JOIN region r   ON n.n_regionkey = r.r_regionkey
JOIN part p     ON l.l_partkey = p.p_partkey
"""
