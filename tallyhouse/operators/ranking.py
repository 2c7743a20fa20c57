"""Latest-row dedup, ranks over aggregates and period trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish
from tallyhouse.operators.aggregate import mean
from tallyhouse.operators.spread import dense_index, ranks


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest by `order`, then by the remaining columns.

    A struct maximum combines on the map side, so thousands of copies of one key
    shrink to one row per task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    winner = F.max(F.struct(*order, *rest)).alias("_w")
    return df.groupBy(*keys).agg(winner).select(*keys, "_w.*").select(*df.columns)


def surrogate_key(df: DataFrame, order: Sequence[str], out: str = "row_key") -> DataFrame:
    """Consecutive keys from 1 in a total order, assigned without a single-task sort."""
    return dense_index(df, order, out=out, start=1)


def _mean_cell(step: float = 1000.0) -> Column:
    return F.floor(F.col("mean_score") * step)


def rank_groups(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """RANK of group means, best first. The exact means are ranked, and rounded for output."""
    groups = df.groupBy(*keys).agg(mean(measure).alias("mean_score"))
    ranked = ranks(groups, [], "mean_score", _mean_cell(), descending=True).drop("group_rows")
    return ranked.withColumn("mean_score", publish("mean_score", 4))


def percent_rank_groups(
    df: DataFrame, part: Sequence[str], keys: Sequence[str], measure: str, descending: bool = True
) -> DataFrame:
    """PERCENT_RANK of exact group means inside each partition, best first unless told otherwise."""
    groups = df.groupBy(*part, *keys).agg(mean(measure).alias("mean_score"))
    ranked = ranks(groups, part, "mean_score", _mean_cell(), descending=descending)
    share = F.when(F.col("group_rows") > 1, (F.col("rnk") - 1) / (F.col("group_rows") - 1)).otherwise(F.lit(0.0))
    return ranked.select(*part, *keys, publish("mean_score", 4).alias("mean_score"), publish(share, 4).alias("pct_rank"))


def period_trend(df: DataFrame, keys: Sequence[str], period: Sequence[str], measure: str) -> DataFrame:
    """Group mean per period with the change from the period before.

    The window sees one row per key and period, after aggregation.
    """
    w = Window.partitionBy(*keys).orderBy(*period)
    groups = df.groupBy(*keys, *period).agg(publish(mean(measure)).alias("mean_score"))
    return groups.withColumn("prev_mean", F.lag("mean_score").over(w)).withColumn(
        "change", publish(F.col("mean_score") - F.col("prev_mean"))
    )
