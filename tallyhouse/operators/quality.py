"""Data-quality contracts. Every check is a query for failing rows; none means pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.joins import orphans


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-NULL values with their row count."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows outside the list. NULL is left to not_null."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    return orphans(child, fk, parent, pk)


def assertion(failing: DataFrame, name: str) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit(name).alias("test_name"), "failing_rows")


@dataclass(frozen=True)
class CheckSpec:
    """One check: table, kind, column, and the kind's argument."""

    table: str
    kind: str  # not_null | unique | accepted_values | in_range | relationships | assertion
    column: str
    values: Any = ()
    failing: Callable[[DataFrame], DataFrame] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


@dataclass(frozen=True)
class Contract:
    """What a table promises: filled columns, keys, domains and references."""

    table: str
    required: Sequence[str] = ()
    keys: Sequence[str] = ()
    domains: Mapping[str, Sequence] | None = None
    references: Mapping[str, tuple[str, str]] | None = None

    def checks(self) -> list[CheckSpec]:
        specs = [CheckSpec(self.table, "not_null", c) for c in self.required]
        specs += [CheckSpec(self.table, "unique", c) for c in self.keys]
        specs += [CheckSpec(self.table, "accepted_values", c, tuple(v)) for c, v in (self.domains or {}).items()]
        specs += [CheckSpec(self.table, "relationships", c, ref) for c, ref in (self.references or {}).items()]
        return specs


def _row_rule(spec: CheckSpec) -> Column | None:
    """Condition of a failing row for checks that look at one row at a time."""
    c = F.col(spec.column)
    if spec.kind == "not_null":
        return c.isNull()
    if spec.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(spec.values))
    if spec.kind == "in_range":
        lo, hi = spec.values
        return c.isNotNull() & ~c.between(lo, hi)
    return None


def run_suite(tables: Mapping[str, DataFrame], specs: Sequence[CheckSpec]) -> DataFrame:
    """One row per check: name, kind, table, failing rows, status.

    All row-wise checks of a table share one scan; keys, references and custom
    checks run as their own aggregates.
    """
    lines: list[DataFrame] = []
    for table in dict.fromkeys(s.table for s in specs):
        df = tables[table]
        rowwise = [s for s in specs if s.table == table and _row_rule(s) is not None]
        if rowwise:
            counts = df.agg(*[F.count_if(_row_rule(s)).alias(s.name) for s in rowwise])
            entries = [
                F.struct(
                    F.lit(s.name).alias("test_name"),
                    F.lit(s.kind).alias("test_type"),
                    F.lit(s.table).alias("table_name"),
                    F.col(s.name).alias("failing_rows"),
                )
                for s in rowwise
            ]
            lines.append(counts.select(F.inline(F.array(*entries))))
        for s in specs:
            if s.table != table or _row_rule(s) is not None:
                continue
            if s.kind == "unique":
                failing = unique(df, s.column)
            elif s.kind == "relationships":
                parent, pk = s.values
                failing = relationships(df, s.column, tables[parent], pk)
            elif s.failing is not None:
                failing = s.failing(df)
            else:
                raise ValueError(f"check {s.name} has no rule")
            lines.append(
                failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
                    F.lit(s.name).alias("test_name"),
                    F.lit(s.kind).alias("test_type"),
                    F.lit(s.table).alias("table_name"),
                    "failing_rows",
                )
            )
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out.withColumn("status", F.when(F.col("failing_rows") == 0, "PASS").otherwise("FAIL"))


class ContractViolation(RuntimeError):
    """Raised by a gate; carries the failed checks."""


def gate(suite: DataFrame) -> None:
    """Stop when a check failed. The suite has one row per declared check, so it is read on the driver."""
    failed = [f"{r.test_name}: {r.failing_rows} rows" for r in suite.filter("status = 'FAIL'").collect()]
    if failed:
        raise ContractViolation("; ".join(sorted(failed)))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet no rejection rule, and the others with every reason that applies."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    marked = df.withColumn("reject_reasons", hits)
    ok = marked.filter(F.size("reject_reasons") == 0).drop("reject_reasons")
    bad = marked.filter(F.size("reject_reasons") > 0)
    return ok, bad
