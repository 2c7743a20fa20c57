"""Row-level security, column masking, attribute rules and their composition with suppression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.privacy import cut_means


def secure_rows(df: DataFrame, owner: str, policies: DataFrame, principal: str) -> DataFrame:
    """Rows the principal may see. `policies` has principal, owner, is_admin; unknown principals see nothing."""
    mine = policies.filter(F.col("principal") == principal)
    admin = mine.agg(F.coalesce(F.max("is_admin"), F.lit(False)).alias("a")).scalar()
    owned = mine.filter(F.col("owner").isNotNull()).select(F.col("owner").alias("_owner"), F.lit(True).alias("_mine")).distinct()
    return (
        df.join(owned, F.col(owner) == F.col("_owner"), "left")
        .filter(F.coalesce(F.col("_mine"), F.lit(False)) | admin)
        .select(*df.columns)
    )


def mask_columns(df: DataFrame, columns: Sequence[str], role: str, allowed: Sequence[str]) -> DataFrame:
    """NULL the columns for roles outside `allowed`; types and all rows stay."""
    if role in allowed:
        return df
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns})


def governed_view(
    df: DataFrame,
    owner: str,
    policies: DataFrame,
    principal: str,
    role: str,
    cut: Sequence[str],
    measure: str,
    k: int = 4,
    allowed: Sequence[str] = ("analyst_role",),
    count_col: str | None = None,
) -> DataFrame:
    """Row security, then aggregation with suppression, then masking."""
    visible = secure_rows(df, owner, policies, principal)
    return mask_columns(cut_means(visible, cut, measure, k, count_col), ["mean_score"], role, allowed)


@dataclass(frozen=True)
class ColumnRule:
    """A column's classification; visible to users whose clearance holds it."""

    column: str
    classification: str


@dataclass(frozen=True)
class RowRule:
    """Rows are visible where the column equals (or is in) a user attribute."""

    column: str
    attribute: str


def abac_filter(
    df: DataFrame, user: Mapping[str, object], column_rules: Sequence[ColumnRule], row_rules: Sequence[RowRule]
) -> DataFrame:
    """Apply attribute rules: rows first, then the values of columns the user is not cleared for."""
    out = df
    for rule in row_rules:
        wanted = user.get(rule.attribute)
        values = list(wanted) if isinstance(wanted, list | tuple | set) else [wanted]
        out = out.filter(F.col(rule.column).isin(values)) if wanted is not None else out.filter(F.lit(False))
    cleared = set(user.get("clearance", ()))
    hidden = [r.column for r in column_rules if r.classification not in cleared]
    return out.withColumns({c: F.lit(None).cast(out.schema[c].dataType) for c in hidden})
