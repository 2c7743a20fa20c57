"""Inputs shared by the named queries: survey bronze and silver, the event answers as EAV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.columns import json_value, publish
from tallyhouse.plans.medallion import silver_responses
from tallyhouse.sources.survey import question_items, survey, table

STANDARD = ("click", "error", "purchase", "signup", "view")
LATEST = ("submitted_at", "score", "question_no", "respondent_id")


def survey_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return survey(spark, sf).select(
        "response_id", "respondent_id", "team_id", "project", "location", "question_no",
        F.col("raw_score").alias("score"), "year", "quarter", "submitted_at",
    )


def question_config(spark: SparkSession, sf: str) -> DataFrame:
    return question_items(spark, sf).select("question_no", "category", "is_reverse_scored").distinct()


def survey_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_responses(
        survey_bronze(spark, sf), question_config(spark, sf), question_key="question_no", latest=LATEST
    )


def event_eav(spark: SparkSession, sf: str) -> DataFrame:
    """Answers per user: five shared questions and three of the user's own project."""
    k = json_value("props", "k", "int")
    number = lambda n: (F.col("user_id") % n).cast("string")
    own = F.concat(F.lit("x"), number(3), F.lit("_"), (k % 3).cast("string"))
    return (
        table(spark, sf, "events")
        .groupBy(
            F.col("user_id").alias("entity_id"),
            F.concat(F.lit("P"), number(3)).alias("project"),
            F.concat(F.lit("T"), number(10)).alias("team"),
            F.when(k < 60, F.col("event_type")).otherwise(own).alias("attribute"),
        )
        .agg(publish(F.avg("value")).alias("value"))
    )
