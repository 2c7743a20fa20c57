"""Clustered copies, partition pruning and encoding reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish
from tallyhouse.operators.aggregate import cardinality_profile
from tallyhouse.operators.spread import dense_index, neighbour
from tallyhouse.sources.files import range_sorted


def cluster_by(df: DataFrame, columns: Sequence[str], path: str, files: int | None = None) -> DataFrame:
    """A copy whose files hold neighbouring key ranges, sorted inside each file."""
    range_sorted(df, columns, files).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def encoding_profile(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per column: distinct values, runs of equal values in the given order, and NULL share.

    Equal rows lie side by side and start no run, so they collapse first. The
    others get their place in a distributed sort; a run starts where a value
    differs from its predecessor. Places are cut into blocks, so no single task
    sees the whole order.
    """
    names = list(dict.fromkeys([*order, *columns]))
    placed = dense_index(df.select(*names).distinct(), names, out="_pos")
    seen = neighbour(placed, [], ["_pos"], [*columns, "_pos"], F.expr("_pos div 1000000"))
    starts = [
        F.count_if(F.col("prev__pos").isNull() | ~F.col(c).eqNullSafe(F.col(f"prev_{c}"))).alias(c) for c in columns
    ]
    runs = seen.agg(*starts).unpivot([], list(columns), "column_name", "runs")
    total = F.count(F.lit(1))
    nulls = df.agg(*[publish(F.lit(100.0) * F.count_if(F.col(c).isNull()) / total, 1).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "null_pct"
    )
    return cardinality_profile(df, columns).join(runs, "column_name").join(nulls, "column_name")


def pruned(df: DataFrame, column: str, wanted: Sequence) -> DataFrame:
    """Read only the partitions named; the filter is on the partition column itself."""
    return df.filter(F.col(column).isin(list(wanted)))


