"""Grouped measures, grain rules, distributions and quantiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish
from tallyhouse.operators.spread import null_safe_join, running_total
from tallyhouse.session import pin

def mean(measure: str) -> Column:
    """Mean as double whatever the measure's numeric type."""
    return F.avg(F.col(measure).cast("double"))


def group_means(df: DataFrame, keys: Sequence[str], measure: str, digits: int = 2) -> DataFrame:
    return df.groupBy(*keys).agg(
        publish(mean(measure), digits).alias("mean_score"), F.count(F.lit(1)).alias("response_count")
    )


def global_means(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    return df.agg(*[publish(mean(c), digits).alias(f"mean_{c}") for c in columns])


def group_summary(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    x = F.col(measure).cast("double")
    return df.groupBy(*keys).agg(
        publish(F.avg(x)).alias("mean_score"),
        F.min(x).alias("min_score"),
        F.max(x).alias("max_score"),
        publish(F.stddev_samp(x)).alias("stddev_samp"),
        publish(F.stddev_pop(x)).alias("stddev_pop"),
        F.count(F.lit(1)).alias("response_count"),
    )


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Several distinct counts next to the row count, in one read of the input.

    Each (keys, value) pair is combined on the map side and counted in a second
    step, so no task holds the distinct values of a whole group.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), *[F.countDistinct(c).alias(f"distinct_{c}") for c in columns])


def sparsity(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Filled cells and percent filled per column."""
    total = F.count(F.lit(1))
    aggs = [total.alias("row_count")]
    for c in columns:
        aggs.append(F.count(c).alias(f"filled_{c}"))
        aggs.append(publish(F.lit(100.0) * F.count(c) / total, 1).alias(f"pct_{c}"))
    return df.groupBy(*keys).agg(*aggs)


def pivot_eav(df: DataFrame, keys: Sequence[str], attrs: Sequence[str], attr: str = "attribute", value: str = "value"):
    """One mean per attribute as a conditional aggregate."""
    x = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        *[publish(F.avg(F.when(F.col(attr) == a, x))).alias(f"{a}_avg") for a in attrs]
    )


def weighted_mean(df: DataFrame, mean_col: str, n_col: str, keys: Sequence[str] = ()) -> DataFrame:
    weighted = F.try_divide(F.sum(F.col(mean_col) * F.col(n_col)), F.sum(n_col))
    return df.groupBy(*keys).agg(publish(weighted).alias("weighted_mean"))


def grain_check(df: DataFrame, group: Sequence[str], measure: str) -> DataFrame:
    """One row: mean of group means (wrong), count-weighted mean, and the mean at raw grain."""
    x = F.col(measure).cast("double")
    per_group = df.groupBy(*group).agg(F.avg(x).alias("m"), F.sum(x).alias("s"), F.count(x).alias("n"))
    return per_group.agg(
        publish(F.avg("m")).alias("avg_of_avgs"),
        publish(F.try_divide(F.sum(F.col("m") * F.col("n")), F.sum("n"))).alias("weighted_mean"),
        publish(F.try_divide(F.sum("s"), F.sum("n"))).alias("raw_mean"),
    )


def additivity_report(df: DataFrame, group: Sequence[str], measure: str, p: float = 0.9) -> DataFrame:
    """Which measures survive re-aggregation: counts add, means need weights, percentiles need the value counts.

    Everything is derived from one histogram per group.
    """
    hist = value_counts(df, group, measure)
    x = F.col("value").cast("double")
    cells = hist.groupBy(*group).agg(F.try_divide(F.sum(x * F.col("n")), F.sum("n")).alias("m"), F.sum("n").alias("n"))
    rolled = cells.agg(
        F.sum("n").alias("total_responses"),
        publish(F.avg("m")).alias("unweighted_mean"),
        publish(F.try_divide(F.sum(F.col("m") * F.col("n")), F.sum("n"))).alias("weighted_mean"),
    )
    name = f"p{round(p * 100)}"
    per_group = percentiles(hist, group, "value", [p], weight="n")
    averaged = per_group.agg(publish(F.avg(name)).alias("avg_of_percentiles"))
    exact = percentiles(hist, [], "value", [p], weight="n").select(publish(name).alias("raw_percentile"))
    return rolled.withColumns(
        {"avg_of_percentiles": averaged.scalar(), "raw_percentile": exact.scalar()}
    )


def value_counts(df: DataFrame, keys: Sequence[str], column: str, weight: str | None = None) -> DataFrame:
    """(keys, value, n): equal values collapse on the map side before anything is ordered."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.filter(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("value")).agg(n.alias("n"))


def _ranked_values(df: DataFrame, keys: Sequence[str], column: str, weight: str | None = None) -> DataFrame:
    """Value counts with running totals. The distinct (keys, value) rows are cut into slices of about equal
    size by range, whatever the values are, and one row per slice and key carries the totals across."""
    counts = value_counts(df, keys, column, weight)
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pin(counts.repartitionByRange(slices, *[F.col(k) for k in keys], F.col("value")).withColumn("_slice", F.spark_partition_id()))
    ranked = running_total(placed, keys, ["value"], "n", F.col("_slice"), out="upto", total="total")
    return ranked.drop("_slice").withColumn("first_pos", F.col("upto") - F.col("n"))


def _value_at(position: Column) -> Column:
    """The value that covers a 0-based position in the sorted group."""
    return F.max(F.when((F.col("first_pos") <= position) & (position < F.col("upto")), F.col("value")))


def percentiles(
    df: DataFrame, keys: Sequence[str], column: str, ps: Sequence[float], weight: str | None = None
) -> DataFrame:
    """Exact linearly interpolated percentiles p<100p>, from cumulative value counts.

    `weight` names a count column when the input already is a histogram.
    """
    ranked = _ranked_values(df, keys, column, weight)
    aggs = []
    for p in ps:
        place = (F.col("total") - 1) * F.lit(float(p))
        aggs.append(_value_at(F.floor(place)).cast("double").alias(f"_lo{p}"))
        aggs.append(_value_at(F.ceil(place)).cast("double").alias(f"_hi{p}"))
    wide = ranked.groupBy(*keys, "total").agg(*aggs)
    outs = []
    for p in ps:
        place = (F.col("total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"`_lo{p}`"), F.col(f"`_hi{p}`")
        outs.append((lo + (hi - lo) * (place - F.floor(place))).alias(f"p{round(p * 100)}"))
    return wide.select(*keys, *outs)


def order_stat_quantiles(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Order statistics at 0-based n//4, n//2 and 3n//4."""
    ranked = _ranked_values(df, keys, column)
    n = F.col("total")
    return (
        ranked.groupBy(*keys, "total")
        .agg(
            _value_at(F.floor(n / 4)).alias("p25"),
            _value_at(F.floor(n / 2)).alias("median"),
            _value_at(F.floor(n * 3 / 4)).alias("p75"),
        )
        .withColumnRenamed("total", "response_count")
    )


def distribution(df: DataFrame, keys: Sequence[str], column: str, domain: Sequence) -> DataFrame:
    """Map of value -> count over the whole domain, zeros included."""
    entries: list[Column] = []
    for v in domain:
        entries += [F.lit(str(v)), F.count_if(F.col(column) == v)]
    return df.groupBy(*keys).agg(F.create_map(*entries).alias("distribution"))


def favorability(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    x = F.col(column)
    pct = lambda cond: publish(F.try_divide(F.lit(100.0) * F.count_if(cond), F.count(x)), 1)
    return df.groupBy(*keys).agg(
        F.count(x).alias("response_count"),
        pct(x >= 4).alias("favorable_pct"),
        pct(x <= 2).alias("unfavorable_pct"),
    )


def question_metrics(df: DataFrame, keys: Sequence[str], column: str, domain: Sequence = (1, 2, 3, 4, 5)) -> DataFrame:
    """Mean, deviation, order statistics, range, distribution and favourability in one grouped pass.

    The order statistics come from the value histogram, which on a fixed answer
    scale has at most len(domain) entries, so no ordering of rows is needed.
    """
    x = F.col(column)
    hist = [F.count_if(x == v) for v in domain]
    n = F.count(x)
    base = df.groupBy(*keys).agg(
        n.alias("response_count"),
        publish(F.avg(x.cast("double"))).alias("mean_score"),
        publish(F.stddev_pop(x.cast("double"))).alias("std_dev"),
        F.min(x).alias("min_score"),
        F.max(x).alias("max_score"),
        publish(F.try_divide(F.lit(100.0) * F.count_if(x >= 4), n), 1).alias("favorable_pct"),
        publish(F.try_divide(F.lit(100.0) * F.count_if(x <= 2), n), 1).alias("unfavorable_pct"),
        *[h.alias(f"n_{v}") for h, v in zip(hist, domain, strict=True)],
    )

    def at(position: Column) -> Column:
        upto, out = F.lit(0), None
        for v in domain:
            upto = upto + F.col(f"n_{v}")
            out = F.when(position < upto, F.lit(v)) if out is None else out.when(position < upto, F.lit(v))
        return out

    total = F.col("response_count")
    entries = reduce(lambda acc, v: acc + [F.lit(str(v)), F.col(f"n_{v}")], domain, [])
    return base.withColumns(
        {
            "p25": at(F.floor(total / 4)),
            "median": at(F.floor(total / 2)),
            "p75": at(F.floor(total * 3 / 4)),
            "distribution": F.create_map(*entries),
        }
    )


def dimension_slices(df: DataFrame, dims: Sequence[str], keys: Sequence[str], measure: str, domain=(1, 2, 3, 4, 5)):
    """Each question broken out by one dimension at a time. Rows combine to cells of all dimensions and the
    value before they are listed once per dimension."""
    cells = df.groupBy(*dict.fromkeys([*keys, *dims, measure])).agg(F.count(F.lit(1)).alias("_n"))
    long = cells.select(
        *keys,
        measure,
        "_n",
        F.explode(
            F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])
        ).alias("_d"),
    ).select(*keys, measure, "_n", "_d.dimension", "_d.value")
    x = F.col(measure)
    filled = F.coalesce(F.sum(F.when(x.isNotNull(), F.col("_n"))), F.lit(0))
    return long.groupBy(*keys, "dimension", "value").agg(
        publish(F.try_divide(F.sum(x.cast("double") * F.col("_n")), filled)).alias("mean_score"),
        filled.alias("response_count"),
        *[F.coalesce(F.sum(F.when(x == v, F.col("_n"))), F.lit(0)).alias(f"n_{v}") for v in domain],
    )


def cardinality_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column as rows. Exact counts collapse (column, value) pairs first."""
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return wide.unpivot([], list(columns), "column_name", "distinct_values")
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
        ).alias("_p")
    ).select("_p.column_name", "_p.v")
    return pairs.groupBy("column_name", "v").agg(F.lit(1).alias("_one")).groupBy("column_name").agg(
        F.count("v").alias("distinct_values")
    )


def cell_growth(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Possible (product of cardinalities) and actual cells as dimensions are added one by one.

    The finest combination is aggregated once; every shorter prefix is derived
    from it, so only the first step reads the fact rows.
    """
    finest = df.select(*dims).distinct()
    singles = finest.agg(*[F.countDistinct(d).alias(d) for d in dims])
    prefix_rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("dimensions"),
                F.array(*[F.when(F.lit(j <= i), F.coalesce(F.col(d).cast("string"), F.lit("\0"))) for j, d in enumerate(dims)]).alias("cell"),
            )
            for i in range(len(dims))
        ]
    )
    actual = (
        finest.select(F.explode(prefix_rows).alias("_p"))
        .select("_p.dimensions", "_p.cell")
        .distinct()
        .groupBy("dimensions")
        .agg(F.count(F.lit(1)).alias("actual_cells"))
    )
    potential = singles.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("dimensions"),
                        reduce(lambda a, b: a * b, [F.col(d) for d in dims[: i + 1]]).alias("potential_cells"),
                    )
                    for i in range(len(dims))
                ]
            )
        ).alias("_p")
    ).select("_p.dimensions", "_p.potential_cells")
    return potential.join(actual, "dimensions")


def with_benchmark(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Group means with the organisation mean and the gap to it, both from the groups' sums."""
    x = F.col(measure).cast("double")
    parts = df.groupBy(*keys).agg(F.sum(x).alias("_s"), F.count(x).alias("_m"), F.count(F.lit(1)).alias("response_count"))
    org = parts.agg(publish(F.sum("_s") / F.sum("_m")).alias("m"))
    return parts.select(
        *keys, publish(F.col("_s") / F.col("_m")).alias("mean_score"), "response_count", org.scalar().alias("benchmark")
    ).withColumn("gap", publish(F.col("mean_score") - F.col("benchmark")))


def response_rate(responses: DataFrame, roster: DataFrame, keys: Sequence[str], person: str) -> DataFrame:
    """Distinct responders over people invited, per group of the roster."""
    invited = roster.groupBy(*keys).agg(F.countDistinct(person).alias("invited"))
    answered = responses.groupBy(*keys).agg(F.countDistinct(person).alias("responded"))
    joined = null_safe_join(invited, answered, keys, "left").withColumn(
        "responded", F.coalesce("responded", F.lit(0)).cast("bigint")
    )
    return joined.withColumn("response_rate", publish(F.col("responded") / F.col("invited"), 4))


def drill_down(fact: DataFrame, filters: dict, by: Sequence[str], measure: str) -> DataFrame:
    """Filter to given dimension values (a scalar or a list), then group by any dimensions."""
    out = fact
    for column, wanted in filters.items():
        values = list(wanted) if isinstance(wanted, list | tuple | set) else [wanted]
        out = out.filter(F.col(column).isin(values))
    return group_means(out, by, measure)


def hot_dimension_sets(query_log: DataFrame, dims_col: str = "dims") -> DataFrame:
    """Usage count of each dimension set, most used first, with cumulative share."""
    counts = query_log.groupBy(F.concat_ws(",", F.array_sort(dims_col)).alias("dimension_set")).agg(
        F.count(F.lit(1)).alias("queries")
    )
    # one row per combination of declared dimensions, far fewer than the log
    w = Window.orderBy(F.col("queries").desc(), "dimension_set").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("running", F.sum("queries").over(w)).select(
        "dimension_set",
        "queries",
        publish(F.lit(100.0) * F.col("running") / F.sum("queries").over(Window.partitionBy()), 1).alias("cumulative_pct"),
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Ordered LIMIT: each task keeps k rows, the driver never sees the rest."""
    return df.orderBy(*order).limit(k)


def distinct_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
