"""Column helpers used across the operators. No Python runs per row."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def publish(value: Column | str, digits: int = 2) -> Column:
    """Round half up at the published edge. The decimal step removes binary ties."""
    return F.round(as_col(value).cast("decimal(38,10)"), digits).cast("double")


def reverse_scale(score: Column | str, flag: Column | str, lo: int = 1, hi: int = 5) -> Column:
    """Mirror a score on its scale where the question is worded negatively."""
    return F.when(as_col(flag), F.lit(lo + hi) - as_col(score)).otherwise(as_col(score))


def clamp(value: Column | str, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), as_col(value)))


def likert_band(score: Column | str) -> Column:
    score = as_col(score)
    return (
        F.when(score >= 4, F.lit("favorable"))
        .when(score <= 2, F.lit("unfavorable"))
        .when(score.isNotNull(), F.lit("neutral"))
    )


def period_label(day: Column | str) -> Column:
    """2025-05-14 -> '2025-Q2'."""
    day = as_col(day)
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def path_label(parts: Sequence[Column | str], sep: str = " > ") -> Column:
    """Join the parts; a missing part makes the whole label missing."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(as_col(part).cast("string"))
    return F.concat(*pieces)


def suppress_below(value: Column | str, n: Column | str, k: int | Column = 4) -> Column:
    """The measure where the group is large enough, else NULL."""
    return F.when(as_col(n) >= k, as_col(value))


def lcg(seed: Column | str, salt: int = 0, modulus: int = 1_000_003) -> Column:
    """Repeatable pseudo-random integer in [0, modulus) from plain integer arithmetic."""
    x = as_col(seed).cast("bigint") % modulus
    return (x * F.lit(48271) + F.lit(salt * 7919 + 11)) % modulus


def json_value(doc: Column | str, key: str | Column, as_type: str = "double") -> Column:
    """One key of a JSON object, cast; an absent key gives NULL. The key may be a column, and hold any
    characters. A value that is no such number gives NULL."""
    doc, entries = as_col(doc), lambda: F.from_json(as_col(doc), "map<string,string>")
    if isinstance(key, str):
        text = F.try_element_at(entries(), F.lit(key)) if re.search(r"['?]", key) else F.get_json_object(doc, f"$['{key}']")
    else:
        plain = F.call_function("get_json_object", doc, F.concat(F.lit("$['"), key, F.lit("']")))
        text = F.when(key.rlike("['?]"), F.try_element_at(entries(), key)).otherwise(plain)
    return text.try_cast(as_type)


def json_keys(doc: Column | str) -> Column:
    return F.json_object_keys(as_col(doc))


def json_has_key(doc: Column | str, key: str) -> Column:
    return json_value(doc, key, "string").isNotNull()


def value_bucket(value: Column | str, per_octave: int = 16) -> Column:
    """A coarse order-preserving cell on a log scale, so long tails do not share one cell."""
    v = as_col(value).cast("double")
    level = F.floor(F.log2(F.greatest(F.abs(v), F.lit(1e-9))) * per_octave) + F.lit(100_000)
    return F.when(v == 0, F.lit(0)).when(v > 0, level).otherwise(-level).cast("bigint")


def simple_case(value: Column | str, mapping: Mapping, default=None) -> Column:
    """CASE value WHEN k THEN v ... ELSE default END."""
    value = as_col(value)
    out = None
    for key, result in mapping.items():
        out = F.when(value == F.lit(key), F.lit(result)) if out is None else out.when(value == F.lit(key), F.lit(result))
    return out.otherwise(F.lit(default))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Strict casts; under ANSI mode a bad value raises."""
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def reject_uncastable(df: DataFrame, column: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose text casts to `kind` (cast applied) and the rows whose text does not."""
    ok = F.col(column).try_cast(kind)
    good = df.filter(ok.isNotNull()).withColumn(column, ok)
    bad = df.filter(F.col(column).isNotNull() & ok.isNull())
    return good, bad


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with bound parameters and DataFrame references ({name} in the text)."""
    return spark.sql(text, args=dict(args or {}), **frames)


def register_functions(spark: SparkSession, privileged: Sequence[str] = ("analyst_role",)) -> None:
    """SQL scalar functions for masking, suppression and scale correction."""
    roles = ", ".join("'" + r.replace("'", "''") + "'" for r in privileged)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_score(val DOUBLE, role STRING) RETURNS DOUBLE "
        f"RETURN CASE WHEN role IN ({roles}) THEN val END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION suppress_below(val DOUBLE, n BIGINT, k INT) RETURNS DOUBLE "
        "RETURN CASE WHEN n >= k THEN val END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION reverse_scale(score INT, flag BOOLEAN) RETURNS INT "
        "RETURN CASE WHEN flag THEN 6 - score ELSE score END"
    )
