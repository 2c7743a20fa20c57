"""Tests and models from grouped moments, so one aggregation serves each statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import publish
from tallyhouse.functions.distributions import chi_squared_tail, f_tail, t_two_sided

P_DIGITS = 6


def correlation(x: Column, y: Column) -> Column:
    """Pearson's r from moments over the pairs without NULL; NULL where a side is constant or missing."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def pearson(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.groupBy(*keys).agg(
        publish(correlation(F.col(x), F.col(y)), 4).alias("r"), F.count(F.lit(1)).alias("n")
    )


def driver_analysis(df: DataFrame, target: str, drivers: Sequence[str], segment: Sequence[str] = ()) -> DataFrame:
    """Per segment and driver: correlation with the target, R squared and rank by it.

    All drivers are measured in one grouped pass; ranks run over the short driver list.
    """
    y = F.col(target).cast("double")
    wide = df.groupBy(*segment).agg(
        *[correlation(F.col(d), y).alias(f"r_{d}") for d in drivers],
        *[F.count_if(F.col(d).isNotNull() & y.isNotNull()).alias(f"n_{d}") for d in drivers],
    )
    entries = F.array(
        *[F.struct(F.lit(d).alias("driver"), F.col(f"r_{d}").alias("_r"), F.col(f"n_{d}").alias("n")) for d in drivers]
    )
    long = wide.select(*segment, F.inline(entries))
    scored = long.select(
        *segment, "driver", "n", publish("_r", 4).alias("r"), publish(F.col("_r") * F.col("_r"), 4).alias("r_squared")
    )
    w = Window.partitionBy(*segment).orderBy(F.col("r_squared").desc_nulls_last(), "driver")
    return scored.withColumn("driver_rank", F.row_number().over(w).cast("bigint"))


def segment_regression(df: DataFrame, target: str, drivers: Sequence[str], segment: Sequence[str]) -> DataFrame:
    """Joint least squares per segment: each driver's coefficient and its share of the explained variance.

    The shares (coefficient times covariance with the target over the target's variance) add up to R
    squared, and rank the drivers. Rows with a NULL do not count. One grouped pass gives the moments, and
    the small equations are solved on one row per segment. Segments whose drivers depend on each other
    linearly, or whose target is constant, have NULLs. Filter `df` to refit.
    """
    names = [*drivers, target]
    whole = df.select(*segment, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(names)]).dropna(subset=[f"_v{i}" for i in range(len(names))])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    moments = whole.groupBy(*segment).agg(F.count(F.lit(1)).alias("n"), *[F.covar_pop(f"_v{i}", f"_v{j}").alias(f"_c{i}_{j}") for i, j in pairs])
    count, keys, labels = len(drivers), list(segment), list(drivers)

    def solve(parts):
        import numpy as np

        for part in parts:
            out = []
            for row in part.to_dict("records"):
                both = np.array([[row[f"_c{min(i, j)}_{max(i, j)}"] for j in range(count + 1)] for i in range(count + 1)], dtype=float)
                spread = np.sqrt(np.diag(both))
                scaled = both / np.where(spread > 0, np.outer(spread, spread), 1)
                fits = spread.min() > 0 and np.linalg.eigvalsh(scaled[:count, :count]).min() > 1e-9
                beta = np.linalg.solve(both[:count, :count], both[:count, count]) if fits else [None] * count
                for i, label in enumerate(labels):
                    share = beta[i] * both[i, count] / both[count, count] if fits else None
                    out.append([*(row[k] for k in keys), label, row["n"], beta[i], share])
            yield part.iloc[:0][keys].reindex(range(len(out))).assign(**{c: [r[i] for r in out] for i, c in enumerate([*keys, "driver", "n", "coefficient", "share"])})

    schema = T.StructType([*(moments.schema[k] for k in keys), *(T.StructField(c, t) for c, t in (("driver", T.StringType()), ("n", T.LongType()), ("coefficient", T.DoubleType()), ("share", T.DoubleType())))])
    solved = moments.mapInPandas(solve, schema)
    of = Window.partitionBy(*keys)
    return solved.select(
        *keys, "driver", "n", publish("coefficient", 4).alias("coefficient"), publish("share", 4).alias("share"),
        publish(F.sum("share").over(of), 4).alias("r_squared"),
        F.row_number().over(of.orderBy(F.col("share").desc_nulls_last(), "driver")).cast("bigint").alias("driver_rank"),
    )


def multi_driver_regression(df: DataFrame, target: str, drivers: Sequence[str]):
    """Least squares on all drivers together; returns the fitted model."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = df.select(F.col(target).cast("double").alias("label"), *[F.col(d).cast("double").alias(d) for d in drivers]).dropna()
    features = VectorAssembler(inputCols=list(drivers), outputCol="features").transform(rows)
    return LinearRegression(solver="normal").fit(features.select("features", "label"))


def _moments(df: DataFrame, group: str, x: str) -> DataFrame:
    v = F.col(x).cast("double")
    return (
        df.filter(F.col(group).isNotNull() & v.isNotNull())
        .groupBy(F.col(group).alias("g"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("m"), F.var_samp(v).alias("v"))
    )


def t_statistic(df: DataFrame, group: str, x: str, labels: Sequence | None = None) -> DataFrame:
    """Welch's t of the first group against the second, in label order, with degrees of freedom.

    `labels` names the two groups of a column with more. Without it, more than two fail the job, and
    fewer give no row. Groups without spread have no statistic: t and dof are NULL.
    """
    g = _moments(df.filter(F.col(group).isin(list(labels))) if labels else df, group, x)
    side = lambda f, a: f(F.struct("n", "m", "v"), F.col("g")).alias(a)
    pair = g.agg(side(F.min_by, "a"), side(F.max_by, "b"), F.min("g").alias("group_a"), F.max("g").alias("group_b"), F.count(F.lit(1)).alias("groups"))
    sa, sb = F.col("a.v") / F.col("a.n"), F.col("b.v") / F.col("b.n")
    t = F.try_divide(F.col("a.m") - F.col("b.m"), F.sqrt(sa + sb))
    dof = F.try_divide((sa + sb) * (sa + sb), F.try_divide(sa * sa, F.col("a.n") - 1) + F.try_divide(sb * sb, F.col("b.n") - 1))
    two = F.when(F.col("groups") > 2, F.raise_error("more than two groups: name two labels").cast("boolean")).otherwise(F.col("groups") == 2)
    return pair.filter(two).select("group_a", "group_b", publish(t, 4).alias("t"), publish(dof, 2).alias("dof"), publish(t_two_sided(t, dof), P_DIGITS).alias("p_value"))


def anova_f(df: DataFrame, group: str, x: str) -> DataFrame:
    """One-way F from group sizes, means and variances."""
    g = _moments(df, group, x)
    grand = g.agg(F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("gm")).scalar()
    sums = g.withColumn("gm", grand).agg(
        F.sum(F.col("n") * (F.col("m") - F.col("gm")) * (F.col("m") - F.col("gm"))).alias("ssb"),
        F.sum((F.col("n") - 1) * F.coalesce("v", F.lit(0.0))).alias("ssw"),
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
    )
    f = F.try_divide(F.try_divide("ssb", F.col("k") - 1), F.try_divide("ssw", F.col("n") - F.col("k")))
    between, within = F.col("k") - 1, F.col("n") - F.col("k")
    return sums.select(between.alias("df_between"), within.alias("df_within"), publish(f, 4).alias("f"), publish(f_tail(f, between, within), P_DIGITS).alias("p_value"))


def chi_squared(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-squared of independence from the contingency table.

    Uses n * (sum over filled cells of o^2 / (row * column) - 1), which needs no
    cross product of the two value sets to reach the empty cells.
    """
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy(a).agg(F.sum("o").alias("r"))
    cols = cells.groupBy(b).agg(F.sum("o").alias("c"))
    o = F.col("o").cast("double")
    sums = cells.join(rows, a).join(cols, b).agg(
        F.sum(o * o / (F.col("r").cast("double") * F.col("c").cast("double"))).alias("q"),
        F.sum("o").alias("n"),
        F.countDistinct(a).alias("ra"),
        F.countDistinct(b).alias("cb"),
    )
    chi2, dof = F.col("n") * (F.col("q") - 1), (F.col("ra") - 1) * (F.col("cb") - 1)
    return sums.select(publish(chi2, 2).alias("chi2"), dof.alias("dof"), "n", publish(chi_squared_tail(chi2, dof), P_DIGITS).alias("p_value"))


def chosen_test(df: DataFrame, a: str, b: str) -> str:
    """Test for a pair of columns from their types and, for a grouping column, its cardinality."""
    numeric = [isinstance(df.schema[c].dataType, T.NumericType) for c in (a, b)]
    if all(numeric):
        return "pearson"
    if not any(numeric):
        return "chi_squared"
    group = b if numeric[0] else a
    levels = df.agg(F.countDistinct(group)).first()[0]
    return "t_statistic" if levels == 2 else "anova"


def auto_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Run the chosen test; one row with its name, statistic and p-value."""
    name = chosen_test(df, a, b)
    a_is_group = not isinstance(df.schema[a].dataType, T.NumericType)
    group, x = (a, b) if a_is_group else (b, a)
    if name == "pearson":
        both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        r = correlation(F.col(a), F.col(b))
        t = r * F.sqrt(F.try_divide(F.count(F.lit(1)) - 2, 1 - r * r))
        own = both.agg(r.alias("raw"), t.alias("t"), (F.count(F.lit(1)) - 2).alias("dof"))
        out, stat = own.select(publish(F.col("raw"), 4).alias("r"), publish(t_two_sided(F.col("t"), F.col("dof")), P_DIGITS).alias("p_value")), "r"
    elif name == "chi_squared":
        out, stat = chi_squared(df, a, b), "chi2"
    elif name == "t_statistic":
        out, stat = t_statistic(df, group, x), "t"
    else:
        out, stat = anova_f(df, group, x), "f"
    return out.select(F.lit(name).alias("test"), F.col(stat).alias("statistic"), "p_value")


def attrition_model(df: DataFrame, features: Sequence[str], label: str, iterations: int = 20):
    """Logistic regression on standardised features; returns the fitted pipeline model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = df.select(F.col(label).cast("double").alias("label"), *[F.col(f).cast("double").alias(f) for f in features]).dropna()
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        LogisticRegression(maxIter=iterations, regParam=0.01, standardization=True),
    ]
    return Pipeline(stages=stages).fit(rows)


def attrition_scores(model, df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Risk per row from a fitted model; NULL for rows that lack a feature."""
    from pyspark.ml.functions import vector_to_array

    known = F.lit(True)
    for f in features:
        known = known & F.col(f).isNotNull()
    typed = df.select(*keys, known.alias("_known"), *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    scored = model.transform(typed)
    return scored.select(
        *keys,
        F.when(F.col("_known"), publish(vector_to_array("probability")[1], 4)).alias("risk"),
        F.when(F.col("_known"), F.col("prediction") == 1.0).alias("at_risk"),
    )
