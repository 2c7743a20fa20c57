"""Threshold suppression per cut, k-anonymity, generalisation, adjacent and complementary hiding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish, suppress_below
from tallyhouse.operators.disclosure import suppress_with_totals
from tallyhouse.operators.spread import null_safe_join
from tallyhouse.session import pin


def suppress(agg: DataFrame, n: str, measures: Sequence[str], k: int = 4) -> DataFrame:
    """NULL the measures of groups below k and say so in `is_suppressed`."""
    hidden = {m: suppress_below(m, n, k) for m in measures}
    return agg.withColumns({**hidden, "is_suppressed": F.col(n) < k})


def cut_means(df: DataFrame, cut: Sequence[str], measure: str, k: int = 4, count_col: str | None = None) -> DataFrame:
    """Mean per cut with suppression on rows, or on distinct `count_col`."""
    n = F.count(F.lit(1)) if count_col is None else F.countDistinct(count_col)
    agg = df.groupBy(*cut).agg(publish(F.avg(F.col(measure).cast("double"))).alias("mean_score"), n.alias("n"))
    return suppress(agg, "n", ["mean_score"], k)


def suppressed_cuts(
    df: DataFrame, cuts: Sequence[Sequence[str]], measure: str, k: int = 4, count_col: str | None = None
) -> DataFrame:
    """The same data under several groupings, each group judged by its own count.

    Rows collapse to the finest cells (per person when people are counted) before
    the groupings multiply them. A column outside a cut is NULL; `cut` names it.
    """
    dims = list(dict.fromkeys(c for cut in cuts for c in cut))
    fine = [*dims, *([count_col] if count_col else [])]
    base = df.groupBy(*fine).agg(
        F.sum(F.col(measure).cast("double")).alias("_s"), F.count(measure).alias("_m"), F.count(F.lit(1)).alias("_n")
    )
    n = F.sum("_n") if count_col is None else F.countDistinct(count_col)
    sets = [[F.col(c) for c in cut] for cut in cuts]
    cells = base.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        F.grouping_id().alias("_gid"), publish(F.sum("_s") / F.sum("_m")).alias("mean_score"), n.alias("n")
    )
    label = None
    for cut in cuts:
        gid = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in cut)
        name = F.lit(" x ".join(cut) or "all")
        label = F.when(F.col("_gid") == gid, name) if label is None else label.when(F.col("_gid") == gid, name)
    return suppress(cells.withColumn("cut", label).drop("_gid"), "n", ["mean_score"], k)


def k_anonymity_groups(df: DataFrame, qi: Sequence[str], k: int = 4) -> DataFrame:
    """Quasi-identifier groups with size and VULNERABLE or OK."""
    sizes = df.groupBy(*qi).agg(F.count(F.lit(1)).alias("group_size"))
    return sizes.withColumn("risk", F.when(F.col("group_size") < k, "VULNERABLE").otherwise("OK"))


def k_anonymize(df: DataFrame, qi: Sequence[str], sensitive: Sequence[str], k: int = 4) -> DataFrame:
    """Every row, with sensitive values hidden where the row's group is below k.

    Only the small groups are looked up, so large groups never form a join group on the lookup side.
    """
    small = df.groupBy(*qi).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < k).select(*qi, F.lit(True).alias("_hide"))
    joined = null_safe_join(df, small, qi, "left")
    return joined.withColumns({s: F.when(F.col("_hide").isNull(), F.col(s)) for s in sensitive}).drop("_hide")


def reidentification_risk(df: DataFrame, qi: Sequence[str], k: int = 4) -> DataFrame:
    """How many rows a person who knows the quasi-identifiers can single out, before and after release at k."""
    sizes = df.groupBy(*qi).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    return sizes.agg(
        F.count(F.lit(1)).alias("qi_groups"),
        total.alias("total_rows"),
        F.count_if(F.col("n") == 1).alias("unique_rows"),
        F.coalesce(F.sum(F.when(F.col("n") < k, F.col("n"))), F.lit(0)).alias("rows_below_k"),
        publish(F.lit(100.0) * F.count_if(F.col("n") == 1) / total).alias("unique_pct"),
        publish(F.lit(100.0) * F.coalesce(F.sum(F.when(F.col("n") < k, F.col("n"))), F.lit(0)) / total).alias("hidden_pct"),
    )


def probe(df: DataFrame, known: Mapping[str, object], sensitive: Sequence[str]) -> DataFrame:
    """What a lookup by known attributes reveals."""
    out = df
    for column, value in known.items():
        out = out.filter(F.col(column).eqNullSafe(F.lit(value)))
    return out.select(*known, *sensitive)


def generalize(
    df: DataFrame, hierarchy: Sequence[Sequence[str]], measure: str, k: int = 4, count_col: str | None = None
) -> DataFrame:
    """For each finest group, the mean at the finest level whose group reaches k.

    `hierarchy` lists the levels' columns, finest first; each level's columns are
    a subset of the one before. Above the last level nothing is published. The
    finest cells are pinned, since every level is aggregated from them.
    """
    finest = list(hierarchy[0])
    person = [count_col] if count_col else []
    base = pin(
        df.groupBy(*finest, *person).agg(
            F.sum(F.col(measure).cast("double")).alias("_s"), F.count(measure).alias("_m"), F.count(F.lit(1)).alias("_n")
        )
    )
    out = base.select(*finest).distinct()
    for i, level in enumerate(hierarchy):
        n = F.sum("_n") if count_col is None else F.countDistinct(count_col)
        cells = base.groupBy(*level).agg(F.struct(n.alias("n"), publish(F.sum("_s") / F.sum("_m")).alias("mean")).alias(f"_l{i}"))
        out = null_safe_join(out, cells, level) if level else out.withColumn(f"_l{i}", cells.scalar())
    fits = [F.col(f"_l{i}.n") >= k for i in range(len(hierarchy))]
    pick = lambda value: F.coalesce(*[F.when(fit, value(i)) for i, fit in enumerate(fits)])
    return out.select(
        *finest,
        pick(lambda i: F.lit(" x ".join(hierarchy[i]) or "all")).alias("published_level"),
        pick(lambda i: F.col(f"_l{i}.mean")).alias("mean_score"),
        pick(lambda i: F.col(f"_l{i}.n")).alias("n"),
    )


def suppress_adjacent(
    agg: DataFrame, parent: Sequence[str], key: Sequence[str], n: str, measures: Sequence[str], mode: str = "basic", k: int = 4
) -> DataFrame:
    """Hide small groups and, against subtraction from the parent's total, a neighbour.

    basic: groups of one participant are hidden, and with them the parent's
    next-smallest group. strong: every group below k is hidden and, when exactly
    one is, the next-smallest too. Ties go by group key.
    """
    if mode not in ("basic", "strong"):
        raise ValueError(f"unknown mode {mode}")
    small = F.col(n) == 1 if mode == "basic" else F.col(n) < k
    smallest_open = F.min(F.when(~small, F.struct(F.col(n).alias("n"), *key)))
    per_parent = agg.groupBy(*parent).agg(F.count_if(small).alias("_small"), smallest_open.alias("_next"))
    needs = F.col("_small") >= 1 if mode == "basic" else F.col("_small") == 1
    is_next = F.col("_next").isNotNull()
    for c in key:
        is_next = is_next & F.col(c).eqNullSafe(F.col(f"_next.{c}"))
    marked = null_safe_join(agg, per_parent, parent).withColumn(
        "suppression_reason", F.when(small, "small_group").when(needs & is_next, "adjacent")
    )
    open_ = F.col("suppression_reason").isNull()
    return marked.withColumns({m: F.when(open_, F.col(m)) for m in measures}).drop("_small", "_next")


def suppress_complementary(
    cells: DataFrame, row: str, col: str, n: str, measures: Sequence[str], k: int = 4
) -> DataFrame:
    """Hide cells of a two-way table until its published totals give no hidden one away.

    The totals are published as `disclosure.suppress_with_totals` says, which returns them too.
    """
    table = suppress_with_totals(cells, row, col, n, measures, k)
    return table.filter("kind = 'cell'").select(*cells.columns, "suppression_reason")


def suppress_by_role(agg: DataFrame, n: str, measures: Sequence[str], thresholds: Mapping[str, int]) -> DataFrame:
    """One copy of each group per role, hidden below that role's threshold."""
    roles = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(k).alias("k")) for r, k in thresholds.items()])
    per_role = agg.select("*", F.inline(roles))
    return per_role.withColumns(
        {**{m: suppress_below(m, n, F.col("k")) for m in measures}, "is_suppressed": F.col(n) < F.col("k")}
    ).drop("k")


def suppress_app(df: DataFrame, cut: Sequence[str], measure: str, k: int = 4) -> DataFrame:
    """Enforcement in the caller's own query."""
    return cut_means(df, cut, measure, k)


def suppress_view(df: DataFrame, cut: Sequence[str], measure: str, view: str, k: int = 4) -> DataFrame:
    """Enforcement in a view that consumers select from."""
    df.createOrReplaceTempView(f"{view}_base")
    names = ", ".join(f"`{c}`" for c in cut)
    df.sparkSession.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {names}, "
        f"CASE WHEN COUNT(*) >= {int(k)} THEN CAST(ROUND(CAST(AVG(CAST(`{measure}` AS DOUBLE)) AS DECIMAL(18,6)), 2) AS DOUBLE) END AS mean_score, "
        f"COUNT(*) AS n, COUNT(*) < {int(k)} AS is_suppressed FROM {view}_base GROUP BY {names}"
    )
    return df.sparkSession.table(view)


def suppress_table(df: DataFrame, cut: Sequence[str], measure: str, path: str, k: int = 4) -> DataFrame:
    """Enforcement in the transformation: only hidden-safe rows are stored."""
    cut_means(df, cut, measure, k).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


