"""Diffs and agreement checks between keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish


def _paired(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    left = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(m).alias(f"a_{m}") for m in measures], F.lit(True).alias("_in_a"))
    right = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(m).alias(f"b_{m}") for m in measures], F.lit(True).alias("_in_b"))
    on = None
    for k in keys:
        term = F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
        on = term if on is None else on & term
    joined = left.join(right, on, "full_outer")
    merged = [F.coalesce(F.col(f"_a_{k}"), F.col(f"_b_{k}")).alias(k) for k in keys]
    return joined.select(
        *merged,
        *[f"a_{m}" for m in measures],
        *[f"b_{m}" for m in measures],
        F.coalesce("_in_a", F.lit(False)).alias("_in_a"),
        F.coalesce("_in_b", F.lit(False)).alias("_in_b"),
    )


def metric_diff(
    before: DataFrame, after: DataFrame, keys: Sequence[str], measures: Sequence[str], changed_only: bool = False
) -> DataFrame:
    """Changed, added and removed keys with old and new values. `changed_only` keeps keys on both sides."""
    same = F.lit(True)
    for m in measures:
        same = same & F.col(f"a_{m}").eqNullSafe(F.col(f"b_{m}"))
    status = (
        F.when(~F.col("_in_a"), "added").when(~F.col("_in_b"), "removed").when(~same, "changed").otherwise("same")
    )
    out = _paired(before, after, keys, measures).withColumn("status", status).filter(F.col("status") != "same")
    if changed_only:
        out = out.filter(F.col("status") == "changed")
    return out.select(
        *keys,
        *[F.col(f"a_{m}").alias(f"old_{m}") for m in measures],
        *[F.col(f"b_{m}").alias(f"new_{m}") for m in measures],
        "status",
    )


def consistency_check(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """MATCH or MISMATCH per key, with the absolute delta of every measure."""
    match = F.col("_in_a") & F.col("_in_b")
    for m in measures:
        match = match & F.col(f"a_{m}").eqNullSafe(F.col(f"b_{m}"))
    return _paired(a, b, keys, measures).select(
        *keys,
        *[publish(F.abs(F.col(f"a_{m}") - F.col(f"b_{m}")), 4).alias(f"delta_{m}") for m in measures],
        F.when(match, "MATCH").otherwise("MISMATCH").alias("status"),
    )


def staleness(stored: DataFrame, live: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Stored next to live values per key: FRESH when all agree, else STALE."""
    fresh = F.col("_in_a") & F.col("_in_b")
    for m in measures:
        fresh = fresh & F.col(f"a_{m}").eqNullSafe(F.col(f"b_{m}"))
    return _paired(stored, live, keys, measures).select(
        *keys,
        *[F.col(f"a_{m}").alias(f"stored_{m}") for m in measures],
        *[F.col(f"b_{m}").alias(f"live_{m}") for m in measures],
        F.when(fresh, "FRESH").otherwise("STALE").alias("status"),
    )
