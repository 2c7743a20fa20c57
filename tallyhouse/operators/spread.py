"""Ordered computations whose groups may be too large for one task.

A plain window puts a whole key into one task. Here every key is cut into
cells by a `cell` column that grows with the order (a month, a value bucket).
Windows run per (key, cell); one summary row per (key, cell) carries what
crosses a cell border. Only the summaries are windowed per key. Cells are
computed from the row itself, so a lost and recomputed task gives equal rows.

Key and cell travel as one struct column. Structs compare NULL fields as equal,
so NULL keys form a group like any other, and the window and the join back to
the summaries share one partitioning: the rows are shuffled once.

The input is read twice, for the rows and for the narrow summary. Pin or store
an input that is expensive to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import as_col
from tallyhouse.session import pin

_AT = "_at"  # struct of the keys and the cell


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match, keeping the key columns of the left side once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def _tag(df: DataFrame, keys: Sequence[str], cell: Column) -> DataFrame:
    return df.withColumn(_AT, F.struct(*[F.col(k) for k in keys], cell.alias("_cell")))


def _across(keys: Sequence[str]):
    """Window over the summaries of one key, in cell order."""
    return Window.partitionBy(*[F.col(f"{_AT}.{k}") for k in keys]).orderBy(F.col(f"{_AT}._cell"))


def _earlier(value: str, keys: Sequence[str]) -> Column:
    """Sum over the cells before this one."""
    w = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def _whole(value: str, keys: Sequence[str]) -> Column:
    return F.sum(value).over(Window.partitionBy(*[F.col(f"{_AT}.{k}") for k in keys]))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    cell: Column,
    out: str = "running",
    total: str | None = "total",
) -> DataFrame:
    """Cumulative sum of `amount` per key in ascending order, with the key's grand total."""
    tagged = _tag(df, keys, cell)
    sums = tagged.groupBy(_AT).agg(F.sum(amount).alias("_s"))
    offsets = sums.select(_AT, _earlier("_s", keys).alias("_before"), *([_whole("_s", keys).alias(total)] if total else []))
    w = Window.partitionBy(_AT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.withColumn("_local", F.sum(amount).over(w))
    return local.join(offsets, _AT).withColumn(out, F.col("_local") + F.col("_before")).drop("_local", "_before", _AT)


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    cell: Column,
    descending: bool = False,
    rank_col: str = "rnk",
    size_col: str = "group_rows",
) -> DataFrame:
    """SQL RANK of `value` per key and the group's row count.

    Ties collapse to one counted row per value before anything is ordered, so a
    value shared by very many rows costs no more than any other. `cell` is
    computed from `value`. NULLs rank last in descending and first in ascending order.
    """
    at = F.struct(*[F.col(k) for k in keys], F.col(value)).alias("_value_at")
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counts, keys, [value], "_n", cell, out="_upto", total=size_col)
    ahead = F.col(size_col) - F.col("_upto") if descending else F.col("_upto") - F.col("_n")
    lookup = placed.select(at, (ahead + 1).cast("bigint").alias(rank_col), size_col)
    return df.withColumn("_value_at", at).join(lookup, "_value_at").drop("_value_at")


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    cell: Column,
    ahead: bool = False,
    prefix: str | None = None,
) -> DataFrame:
    """The previous (or, with `ahead`, the next) row's columns per key; NULL at the end."""
    prefix = prefix or ("next_" if ahead else "prev_")
    payload = F.struct(*[F.col(c) for c in columns])
    sort_key = F.struct(*[F.col(c) for c in order])
    tagged = _tag(df, keys, cell)
    edge = F.min_by(payload, sort_key) if ahead else F.max_by(payload, sort_key)
    shift = F.lead if ahead else F.lag
    edges = tagged.groupBy(_AT).agg(edge.alias("_edge")).select(_AT, shift("_edge").over(_across(keys)).alias("_outer"))
    local = tagged.withColumn("_inner", shift(payload).over(Window.partitionBy(_AT).orderBy(*order)))
    joined = local.join(edges, _AT).withColumn("_near", F.coalesce("_inner", "_outer"))
    return joined.select(*df.columns, *[F.col(f"_near.{c}").alias(f"{prefix}{c}") for c in columns])


def number_and_next(
    df: DataFrame, keys: Sequence[str], order: str, cell: Column, number: str = "rn", following: str = "next"
) -> DataFrame:
    """1-based position per key and the next row's `order` value, in one pass over the cells."""
    tagged = _tag(df, keys, cell)
    summary = tagged.groupBy(_AT).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    offsets = summary.select(
        _AT, _earlier("_n", keys).alias("_before"), F.lead("_first").over(_across(keys)).alias("_outer")
    )
    w = Window.partitionBy(_AT).orderBy(order)
    local = tagged.withColumns({"_local": F.row_number().over(w), "_inner": F.lead(order).over(w)})
    return local.join(offsets, _AT).select(
        *df.columns,
        (F.col("_local") + F.col("_before")).cast("bigint").alias(number),
        F.coalesce("_inner", "_outer").alias(following),
    )


def dense_index(df: DataFrame, order: Sequence[Column | str], out: str = "idx", start: int = 0) -> DataFrame:
    """Consecutive numbers over the whole table in the given order, which should tell all rows apart.

    Rows are range-partitioned and pinned, so positions are fixed before the
    per-slice offsets are counted. There is one offset per slice, as many as
    shuffle partitions, which is the bound for sending them to every task.
    """
    order = [as_col(c) for c in order]
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local_bits = 33  # monotonically_increasing_id keeps the row's place in the low 33 bits
    placed = pin(
        df.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    slice_id = F.shiftright("_mid", local_bits)
    counts = placed.groupBy(slice_id.alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_slice", slice_id)
        .join(F.broadcast(offsets), "_slice")
        .withColumn(out, F.col("_before") + F.col("_mid") - F.shiftleft(F.col("_slice"), local_bits) + start)
        .drop("_slice", "_mid", "_before")
    )
