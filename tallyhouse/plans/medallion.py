"""Bronze, silver and gold layers as DataFrame functions, and a runner with contract gates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.columns import cast_columns, path_label, publish, reverse_scale
from tallyhouse.operators.aggregate import mean
from tallyhouse.operators.quality import CheckSpec, gate, run_suite
from tallyhouse.operators.ranking import dedup_latest


def bronze_responses(raw: DataFrame) -> DataFrame:
    """Types only: no dedup, no rules. A score that is not a number is kept for silver to reject."""
    return raw.withColumns({"score": F.col("score").try_cast("int"), "submitted_at": F.col("submitted_at").cast("timestamp")})


def bronze_questions(raw: DataFrame) -> DataFrame:
    return cast_columns(raw, {"is_reverse_scored": "boolean"})


def bronze_teams(raw: DataFrame) -> DataFrame:
    return raw.select("team_id", "team_name", "department", "division")


def silver_responses(
    bronze: DataFrame,
    questions: DataFrame,
    key: str = "response_id",
    question_key: str = "question_id",
    latest: Sequence[str] = ("submitted_at",),
    lo: int = 1,
    hi: int = 5,
) -> DataFrame:
    """Latest row per response, question attached, scores outside the scale dropped, reversed scores mirrored.

    The question lookup is joined after dedup; the range filter does not move
    before dedup, since the latest row decides whether a response is valid.
    """
    unique = dedup_latest(bronze, [key], list(latest))
    valid = unique.filter(F.col("score").between(lo, hi))
    named = valid.withColumnRenamed("score", "raw_score").join(questions, question_key)
    return named.withColumn("score", reverse_scale("raw_score", "is_reverse_scored", lo, hi))


def silver_teams(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("full_path", path_label(["department", "team_name"]))


def suppression_flags(silver: DataFrame, k: int = 4, team: str = "team_id", person: str = "respondent_id") -> DataFrame:
    return silver.groupBy(team).agg(F.countDistinct(person).alias("respondent_count")).withColumn(
        "is_suppressed", F.col("respondent_count") < k
    )


def team_overview_metrics(
    silver: DataFrame, teams: DataFrame, flags: DataFrame, mode: str = "null", team: str = "team_id"
) -> DataFrame:
    """Team x category means. `mode='null'` hides the mean of suppressed teams; 'flag' only marks them.

    Facts are aggregated on their own keys first; the team and flag lookups join
    the small result, not the fact rows.
    """
    cells = silver.groupBy(team, "category").agg(
        publish(mean("score")).alias("mean_score"),
        F.count(F.lit(1)).alias("response_count"),
        F.countDistinct("respondent_id").alias("respondent_count"),
    )
    out = cells.join(teams.select(team, "team_name", "department"), team).join(flags.select(team, "is_suppressed"), team)
    if mode == "null":
        out = out.withColumn("mean_score", F.when(~F.col("is_suppressed"), F.col("mean_score")))
    return out


def category_summary(silver: DataFrame, team: str = "team_id") -> DataFrame:
    return silver.groupBy("category").agg(
        publish(mean("score")).alias("mean_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.count(F.lit(1)).alias("total_responses"),
        F.countDistinct(team).alias("teams_represented"),
    )


def reject_reasons(
    bronze: DataFrame, key: str, score: str, latest: Sequence[str], lo: int = 1, hi: int = 5
) -> DataFrame:
    """Every bronze row's fate: kept, duplicate, not a number, or out of range, with counts.

    `latest` must contain the score column.

    One aggregation per key finds the winner and counts its copies; copies
    combine on the map side and never meet in one task.
    """
    per_key = bronze.groupBy(key).agg(F.max(F.struct(*latest)).alias("_w"), F.count(F.lit(1)).alias("_n"))
    value = F.col(f"_w.{score}").try_cast("int")
    fate = F.when(value.isNull(), "not_a_number").when(~value.between(lo, hi), "out_of_range").otherwise("kept")
    counts = per_key.groupBy(fate.alias("reason")).agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("_n") - 1).alias("_copies"))
    copies = F.struct(F.lit("duplicate").alias("reason"), F.col("_copies").alias("row_count"))
    lines = counts.select(F.inline(F.array(F.struct("reason", "row_count"), copies)))
    return lines.groupBy("reason").agg(F.sum("row_count").alias("row_count")).filter("row_count > 0")


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named layer."""
    out = None
    for name, df in layers.items():
        line = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        out = line if out is None else out.unionByName(line)
    return out


@dataclass
class Model:
    """One table of the warehouse: its layer, inputs, builder and contract checks."""

    name: str
    layer: str
    inputs: Sequence[str]
    build: Callable[..., DataFrame]
    checks: Sequence[CheckSpec] = field(default_factory=tuple)
    stored: bool = False


def build_order(models: Sequence[Model]) -> list[Model]:
    """Models after everything they read; a cycle is an error."""
    by_name, done, order = {m.name: m for m in models}, set(), []

    def visit(model: Model, trail: tuple[str, ...]) -> None:
        if model.name in trail:
            raise ValueError("models read each other: " + " -> ".join([*trail, model.name]))
        if model.name in done:
            return
        for needed in model.inputs:
            if needed in by_name:
                visit(by_name[needed], (*trail, model.name))
        done.add(model.name)
        order.append(model)

    for m in models:
        visit(m, ())
    return order


def run_layers(
    spark: SparkSession,
    models: Sequence[Model],
    sources: Mapping[str, DataFrame],
    path: str,
    select: str | None = None,
    gated: bool = True,
    only: str | None = None,
) -> dict[str, DataFrame]:
    """Build the models in order. Stored models go to parquet; each layer's checks must pass first.

    `select` stops after the named layer. `only` builds and checks that layer alone: stored models of
    earlier layers are read as an earlier run left them. A failed check raises before anything
    downstream is built.
    """
    ready: dict[str, DataFrame] = dict(sources)
    ordered = build_order(models)
    layers = list(dict.fromkeys(m.layer for m in ordered))
    if only is not None and only not in layers:
        raise ValueError(f"unknown layer {only}")
    select = only or select
    for layer in layers:
        built = [m for m in ordered if m.layer == layer]
        specs: list[CheckSpec] = []
        for model in built:
            if only is not None and layer != only:
                stored = f"{path}/{layer}/{model.name}"
                ready[model.name] = spark.read.parquet(stored) if model.stored else model.build(*[ready[name] for name in model.inputs])
                continue
            df = model.build(*[ready[name] for name in model.inputs])
            if model.stored:
                df.write.mode("overwrite").parquet(f"{path}/{layer}/{model.name}")
                df = spark.read.parquet(f"{path}/{layer}/{model.name}")
            ready[model.name] = df
            specs += list(model.checks)
        if gated and specs:
            gate(run_suite(ready, specs))
        if layer == select:
            break
    return ready


def engagement_models(k: int = 4) -> list[Model]:
    """The engagement warehouse: three staged tables, three silver tables, two gold tables."""
    cats = ("Basic Needs", "Individual", "Teamwork", "Growth")
    c = CheckSpec
    return [
        Model("stg_survey_responses", "bronze", ["raw_survey_responses"], bronze_responses, [
            c("stg_survey_responses", "not_null", "response_id"),
            c("stg_survey_responses", "not_null", "score"),
            c("stg_survey_responses", "not_null", "question_id"),
        ]),
        Model("stg_team_hierarchy", "bronze", ["raw_team_hierarchy"], bronze_teams, [
            c("stg_team_hierarchy", "unique", "team_id"),
            c("stg_team_hierarchy", "not_null", "team_id"),
        ]),
        Model("stg_question_config", "bronze", ["raw_question_config"], bronze_questions, [
            c("stg_question_config", "unique", "question_id"),
            c("stg_question_config", "not_null", "question_id"),
            c("stg_question_config", "accepted_values", "category", cats),
        ]),
        Model("survey_responses_cleaned", "silver", ["stg_survey_responses", "stg_question_config"], silver_responses, [
            c("survey_responses_cleaned", "unique", "response_id"),
            c("survey_responses_cleaned", "not_null", "response_id"),
            c("survey_responses_cleaned", "not_null", "score"),
            c("survey_responses_cleaned", "accepted_values", "score", (1, 2, 3, 4, 5)),
            c("survey_responses_cleaned", "not_null", "team_id"),
            c("survey_responses_cleaned", "not_null", "question_id"),
            c("survey_responses_cleaned", "accepted_values", "category", cats),
        ], stored=True),
        Model("team_hierarchy_scd", "silver", ["stg_team_hierarchy"], silver_teams, [
            c("team_hierarchy_scd", "unique", "team_id"),
            c("team_hierarchy_scd", "not_null", "team_id"),
        ], stored=True),
        Model("suppression_flags", "silver", ["survey_responses_cleaned"], lambda s: suppression_flags(s, k), [
            c("suppression_flags", "unique", "team_id"),
            c("suppression_flags", "not_null", "team_id"),
            c("suppression_flags", "not_null", "is_suppressed"),
            c("suppression_flags", "assertion", "is_suppressed", failing=lambda df: df.filter((F.col("respondent_count") < k) & ~F.col("is_suppressed"))),
        ], stored=True),
        Model("team_overview_metrics", "gold", ["survey_responses_cleaned", "team_hierarchy_scd", "suppression_flags"],
              lambda s, t, f: team_overview_metrics(s, t, f, mode="flag"), [
            c("team_overview_metrics", "not_null", "team_id"),
            c("team_overview_metrics", "accepted_values", "category", cats),
            c("team_overview_metrics", "not_null", "mean_score"),
        ], stored=True),
        Model("category_summary", "gold", ["survey_responses_cleaned"], category_summary, [
            c("category_summary", "unique", "category"),
            c("category_summary", "not_null", "category"),
            c("category_summary", "not_null", "mean_score"),
        ], stored=True),
    ]
