"""Governed results: team overviews, request status, default scopes, response shapes and their size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish
from tallyhouse.operators.aggregate import dimension_slices, mean, question_metrics
from tallyhouse.operators.joins import label_lookup

SCOPE = ("team_id", "project_id", "time_period")


def team_overview(
    scores: DataFrame, teams: DataFrame, projects: DataFrame, freshness: Column | None = None, k: int = 4, mode: str = "null"
) -> DataFrame:
    """One nested record per team, project and period from category scores.

    The overall score weights categories by their question count. `mode='flag'`
    keeps the scores of suppressed scopes and only marks them.
    """
    category = F.struct(
        F.col("category"), publish("mean_score").alias("mean_score"), F.col("question_count").alias("question_count")
    )
    # one entry per category: the list is as short as the questionnaire has categories
    records = scores.groupBy(*SCOPE).agg(
        publish(F.coalesce(F.try_divide(F.sum(publish("mean_score") * F.col("question_count")), F.sum("question_count")), F.lit(0.0))).alias("overall_score"),
        F.sort_array(F.collect_list(category)).alias("category_scores"),
        F.max("response_count").alias("response_count"),
        publish(F.max("response_rate"), 4).alias("response_rate"),
        publish(F.max("benchmark")).alias("benchmark"),
    )
    named = label_lookup(label_lookup(records, teams, "team_id", "team_name"), projects, "project_id", "project_name")
    hide = F.col("response_count") < k
    out = named.withColumns(
        {
            "freshness": freshness if freshness is not None else F.lit(None).cast("timestamp"),
            "suppressed": hide,
            "status": F.when(hide, "suppressed").otherwise("ok"),
        }
    )
    if mode == "null":
        out = out.withColumns(
            {
                "overall_score": F.when(~hide, F.col("overall_score")),
                "category_scores": F.when(~hide, F.col("category_scores")),
            }
        )
    return out


def resolve_status(
    requests: DataFrame, overviews: DataFrame, entitlements: DataFrame, now: Column, max_age: str | None = None
) -> DataFrame:
    """Status of each requested scope: not_entitled, no_data, suppressed, stale_cache or ok, in that order."""
    entitled = entitlements.select(F.col("user_id").alias("_u"), F.col("team_id").alias("_t"), F.lit(True).alias("_may")).distinct()
    found = overviews.select(
        *[F.col(c).alias(f"_o_{c}") for c in SCOPE],
        F.col("overall_score"),
        F.col("response_count"),
        F.col("suppressed").alias("_suppressed"),
        F.col("freshness").alias("_fresh"),
        F.lit(True).alias("_has"),
    )
    on = None
    for c in SCOPE:
        term = F.col(c).eqNullSafe(F.col(f"_o_{c}"))
        on = term if on is None else on & term
    joined = requests.join(entitled, (F.col("user_id") == F.col("_u")) & (F.col("team_id") == F.col("_t")), "left").join(found, on, "left")
    stale = F.lit(False) if max_age is None else F.col("_fresh") < now - F.expr(f"INTERVAL {max_age}")
    status = (
        F.when(F.col("_may").isNull(), "not_entitled")
        .when(F.col("_has").isNull(), "no_data")
        .when(F.col("_suppressed"), "suppressed")
        .when(stale, "stale_cache")
        .otherwise("ok")
    )
    readable = F.col("status").isin("ok", "stale_cache")
    out = joined.withColumn("status", status).withColumns(
        {
            "overall_score": F.when(readable, F.col("overall_score")),
            "response_count": F.when(F.col("status") != "not_entitled", F.coalesce("response_count", F.lit(0))),
        }
    )
    return out.select(*requests.columns, "status", "overall_score", "response_count")


def latest_project(projects: DataFrame) -> DataFrame:
    """The project with the newest period, one row; ties go by project id."""
    return projects.agg(F.max_by(F.struct("project_id", "project_name", "latest_period"), F.struct("latest_period", "project_id")).alias("p"))


def resolve_scopes(memberships: DataFrame, projects: DataFrame) -> DataFrame:
    """Default scope per user: the only managed team, else the only team, else none."""
    team = F.struct("team_id", "team_name")
    managed = F.col("role") == "manager"
    per_user = memberships.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_teams"),
        F.count_if(managed).alias("n_managed"),
        F.max(F.when(managed, team)).alias("_managed"),
        F.max(team).alias("_any"),
    )
    choice = F.when(F.col("n_managed") == 1, F.col("_managed")).when(F.col("n_teams") == 1, F.col("_any"))
    resolved = per_user.withColumn("_team", choice).withColumn("_p", latest_project(projects).scalar())
    clear = F.col("_team").isNotNull()
    return resolved.select(
        "user_id",
        F.col("_team.team_id").alias("team_id"),
        F.col("_team.team_name").alias("team_name"),
        F.when(clear, F.col("_p.project_id")).alias("project_id"),
        F.when(clear, F.col("_p.project_name")).alias("project_name"),
        F.when(clear, F.col("_p.latest_period")).alias("time_period"),
        (clear & F.col("_p").isNotNull()).alias("is_resolved"),
    )


def user_teams(memberships: DataFrame, user_id: str) -> DataFrame:
    return memberships.filter(F.col("user_id") == user_id).select("team_id", "team_name", "role").orderBy("team_id")


def active_projects(projects: DataFrame) -> DataFrame:
    return projects.orderBy(F.col("latest_period").desc_nulls_last(), "project_id")


def shape_overview(df: DataFrame, keys: Sequence[str], question: str, category: str, measure: str) -> DataFrame:
    """Category and question means, nested per key. Overall is weighted by question count."""
    per_q = df.groupBy(*keys, category, question).agg(publish(mean(measure)).alias("mean_score"))
    q = F.struct(F.col(question).alias("question"), F.col("mean_score"))
    per_c = per_q.groupBy(*keys, category).agg(
        publish(F.avg("mean_score")).alias("cat_mean"), F.count(F.lit(1)).alias("n_q"), F.sort_array(F.collect_list(q)).alias("questions")
    )
    c = F.struct(F.col(category).alias("category"), F.col("cat_mean").alias("mean_score"), F.col("questions"))
    return per_c.groupBy(*keys).agg(
        publish(F.sum(F.col("cat_mean") * F.col("n_q")) / F.sum("n_q")).alias("overall_score"),
        F.sort_array(F.collect_list(c)).alias("categories"),
    )


def shape_detailed(df: DataFrame, keys: Sequence[str], question: str, category: str, measure: str) -> DataFrame:
    """Full metrics of every question, nested per key."""
    metrics = question_metrics(df, [*keys, category, question], measure)
    fields = [
        "mean_score", "median", "std_dev", "p25", "p75", "min_score", "max_score",
        "favorable_pct", "unfavorable_pct", "response_count", "distribution",
    ]
    entry = F.struct(F.col(category).alias("category"), F.col(question).alias("question"), *fields)
    by_name = lambda a, b: F.when(a.question < b.question, -1).when(a.question > b.question, 1).otherwise(0)
    return metrics.groupBy(*keys).agg(F.array_sort(F.collect_list(entry), by_name).alias("questions"))


def shape_dimensional(
    df: DataFrame, keys: Sequence[str], question: str, category: str, measure: str, dims: Sequence[str], domain: Sequence = (1, 2, 3, 4, 5)
) -> DataFrame:
    """Each question broken out by each value of each dimension, one row per key and question."""
    slices = dimension_slices(df, dims, [*keys, category, question], measure, domain)
    entries = []
    for v in domain:
        entries += [F.lit(str(v)), F.col(f"n_{v}")]
    one = F.struct("dimension", "value", "mean_score", "response_count", F.create_map(*entries).alias("distribution"))
    ordered = lambda a, b: F.when(
        F.struct(a.dimension, a.value) < F.struct(b.dimension, b.value), -1
    ).otherwise(1)
    return slices.groupBy(*keys, category, question).agg(F.array_sort(F.collect_list(one), ordered).alias("slices"))


def shape_raw(df: DataFrame, keys: Sequence[str], person: str, dims: Sequence[str], question: str, measure: str, questions: Sequence) -> DataFrame:
    """One record per respondent with an answer per question; never nested per team, since teams are unbounded."""
    return df.groupBy(*keys, person, *dims).agg(
        *[F.max(F.when(F.col(question) == q, F.col(measure))).alias(f"q{q}") for q in questions]
    )


def _by_category(rows: DataFrame, keys: Sequence[str], category: str, entry: Column) -> DataFrame:
    """`categories` per key, each with its `questions` in order. `entry` begins with the question."""
    per_category = rows.groupBy(*keys, category).agg(F.sort_array(F.collect_list(entry)).alias("questions"))
    one = F.struct(F.col(category).alias("category"), "questions")
    return per_category.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("categories"))


def whole_documents(
    df: DataFrame, scopes: DataFrame, keys: Sequence[str], question: str, category: str, measure: str, dims: Sequence[str], domain: Sequence = (1, 2, 3, 4, 5)
) -> dict[str, DataFrame]:
    """The four response documents, one row per key, each under the head of its scope.

    `scopes` has a row per key with `team`, `project`, `period`, `response_count`, `response_rate` and
    `benchmark`. Lists are as long as the questionnaire and the dimensions have values. Raw answers are
    as many as a scope has people, so their document has an empty list, and `shape_raw` its members.
    """
    counts = lambda of: F.struct(*[of(v).alias(str(v)) for v in domain]).alias("distribution")
    head = ["team", "project", "period"]
    nested = shape_overview(df, keys, question, category, measure)
    detail = F.struct(
        F.col(question).alias("question"), F.col("mean_score").alias("mean"), "median", "std_dev", "p25", "p75", F.col("min_score").alias("min"), F.col("max_score").alias("max"),
        counts(lambda v: F.element_at("distribution", F.lit(str(v)))), "favorable_pct", "unfavorable_pct",
    )
    detailed = _by_category(question_metrics(df, [*keys, category, question], measure, domain), keys, category, detail)
    one = F.struct("dimension", "value", F.col("mean_score").alias("mean"), F.col("response_count").alias("count"), counts(lambda v: F.col(f"n_{v}")))
    slices = dimension_slices(df, dims, [*keys, category, question], measure, domain).groupBy(*keys, category, question).agg(F.sort_array(F.collect_list(one)).alias("slices"))
    crossed = _by_category(slices, keys, category, F.struct(F.col(question).alias("question"), "slices"))
    under = lambda body, *more: scopes.join(body, list(keys)).select(*[F.col(k).alias(f"_{k}") for k in keys], *head, *more)
    named = {
        "A overview": under(nested, "overall_score", "response_count", "response_rate", "benchmark", "categories"),
        "B detailed": under(detailed, "response_count", "categories"),
        "C dimensional": under(crossed, "response_count", "categories"),
        "D raw": scopes.select(*[F.col(k).alias(f"_{k}") for k in keys], *head, F.array().cast("array<string>").alias("responses")),
    }
    return named


def payload_sizes(shape: DataFrame, keys: Sequence[str], name: str, members: DataFrame | None = None) -> DataFrame:
    """Compact JSON size per key. Shapes with several rows per key are summed, not assembled.

    `members` are the records of the shape's one list, which is empty there: their sizes and the commas
    between them are summed per key, so no list of unbounded length is built.
    """
    def measured(df: DataFrame) -> DataFrame:
        body = F.to_json(F.struct(*[c for c in df.columns if c not in keys]), {"ignoreNullFields": "false"})
        return df.groupBy(*keys).agg(
            F.sum(F.octet_length(body)).cast("bigint").alias("size_bytes"), F.sum(F.length(body)).cast("bigint").alias("chars"), F.count(F.lit(1)).alias("_n")
        )

    out = measured(shape)
    if members is not None:
        listed = measured(members).select(*keys, F.col("size_bytes").alias("_bytes"), F.col("chars").alias("_chars"), (F.col("_n") - 1).alias("_commas"))
        added = lambda own, more: (F.col(own) + F.coalesce(F.col(more) + F.col("_commas"), F.lit(0))).alias(own)
        out = out.join(listed, list(keys), "left").select(*keys, added("size_bytes", "_bytes"), added("chars", "_chars"))
    return out.select(*keys, "size_bytes", "chars", F.lit(name).alias("shape"))


def payload_report(shapes: Mapping[str, DataFrame], keys: Sequence[str], members: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Size, token estimate (four characters each) and rating per shape and key; `members` as in `payload_sizes`, by shape."""
    out = None
    for name, shape in shapes.items():
        one = payload_sizes(shape, keys, name, (members or {}).get(name))
        out = one if out is None else out.unionByName(one)
    tokens = F.expr("chars div 4")
    rating = (
        F.when(tokens < 1000, "Excellent").when(tokens < 3000, "Good").when(tokens < 15000, "Degrades").otherwise("Poor")
    )
    return out.select("shape", *keys, "size_bytes", tokens.alias("est_tokens"), rating.alias("rating"))
