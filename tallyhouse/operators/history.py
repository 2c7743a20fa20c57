"""Slowly changing dimensions: apply changes, build versions from a log, query history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import path_label, publish
from tallyhouse.operators.aggregate import mean
from tallyhouse.operators.ranking import dedup_latest
from tallyhouse.operators.spread import dense_index, neighbour, number_and_next
from tallyhouse.session import pin

OPEN_END = "9999-12-31"


def month_cell(day: str) -> Column:
    return F.year(day) * 12 + F.month(day)


def last_change(changes: DataFrame, key: str, date: str | None) -> DataFrame:
    """The last change of each key by `date`, then by the remaining columns; the date goes unless it is an attribute."""
    last = dedup_latest(changes, [key], [date] if date else [])
    return last.drop(date) if date else last


def scd1_apply(dim: DataFrame, changes: DataFrame, key: str, date: str | None = None) -> DataFrame:
    """Overwrite attributes of known keys and add new keys, by the last change of each key."""
    changes = last_change(changes, key, date)
    attrs = [c for c in changes.columns if c != key]
    incoming = changes.select(F.col(key).alias("_k"), F.struct(*attrs).alias("_new"))
    joined = dim.join(incoming, F.col(key) == F.col("_k"), "full_outer")
    columns = []
    for c in dim.columns:
        if c == key:
            columns.append(F.coalesce(F.col(key), F.col("_k")).alias(key))
        elif c in attrs:
            columns.append(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns)


def scd2_apply(
    dim: DataFrame, changes: DataFrame, key: str, attrs: Sequence[str], date: str, version_key: str
) -> DataFrame:
    """Close the current version the day before the first change and open one per change.

    A key's changes follow each other by date, each version ending the day before the next; of several
    on one day the largest counts. Changes that alter no attribute are ignored. One that alters the
    current version but is dated on or before its start is refused: the job fails. New version keys
    continue after the largest existing key.
    """
    incoming = changes.select(
        F.col(key).alias("_k"), F.struct(*attrs).alias("_new"), F.col(date).cast("date").alias("_on")
    )
    ordered = neighbour(dedup_latest(incoming, ["_k", "_on"], ["_new"]).withColumn("_one", F.lit(1)), ["_k"], ["_on"], ["_new", "_one"], month_cell("_on"))
    current = dim.filter("is_current").select(F.col(key).alias("_ck"), F.struct(*attrs).alias("_old"), F.col("valid_from").alias("_since"))
    touched = ordered.join(current, F.col("_k") == F.col("_ck"), "left").withColumn(
        "_before", F.when(F.col("prev__one").isNull(), F.col("_old")).otherwise(F.col("prev__new"))
    )
    early = F.col("_since").isNotNull() & (F.col("_on") <= F.col("_since"))
    refused = F.when(early, F.raise_error(F.concat(F.lit("change dated before the current version: "), F.col("_k").cast("string"))).cast("date")).otherwise(F.col("_on"))
    changed = pin(touched.filter(~F.col("_before").eqNullSafe(F.col("_new"))).select("_k", "_new", refused.alias("_on")))
    real = pin(number_and_next(changed, ["_k"], "_on", month_cell("_on"), "_no", "_next").drop("_no"))
    first = real.groupBy("_k").agg(F.min("_on").alias("_on"))
    closed = (
        dim.join(first, (F.col(key) == F.col("_k")) & F.col("is_current"), "left")
        .withColumns(
            {
                "valid_to": F.when(F.col("_on").isNotNull(), F.date_sub("_on", 1)).otherwise(F.col("valid_to")),
                "is_current": F.col("is_current") & F.col("_on").isNull(),
            }
        )
        .select(*dim.columns)
    )
    last = dim.agg(F.coalesce(F.max(version_key), F.lit(0)).alias("m"))
    opened = (
        dense_index(real, ["_k", "_on"], out="_i", start=1)
        .withColumns(
            {
                version_key: (F.col("_i") + last.scalar()).cast(dim.schema[version_key].dataType),
                key: F.col("_k"),
                "valid_from": F.col("_on"),
                "valid_to": F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END).cast("date")),
                "is_current": F.col("_next").isNull(),
                **{a: F.col(f"_new.{a}") for a in attrs},
            }
        )
    )
    return closed.unionByName(opened.select(*[c for c in dim.columns if c in opened.columns]), allowMissingColumns=True)


def scd3_apply(dim: DataFrame, changes: DataFrame, key: str, attr: str, date: str | None = None) -> DataFrame:
    """Keep the value before the last change in `previous_<attr>`. A batch is one change per key, its last."""
    changes = last_change(changes, key, date)
    previous = f"previous_{attr}"
    base = dim if previous in dim.columns else dim.withColumn(previous, F.lit(None).cast(dim.schema[attr].dataType))
    incoming = changes.select(F.col(key).alias("_k"), F.col(attr).alias("_v"), F.lit(True).alias("_hit"))
    moved = F.coalesce(F.col("_hit"), F.lit(False)) & ~F.col("_v").eqNullSafe(F.col(attr))
    return (
        base.join(incoming, F.col(key) == F.col("_k"), "left")
        .withColumns(
            {
                previous: F.when(moved, F.col(attr)).otherwise(F.col(previous)),
                attr: F.when(moved, F.col("_v")).otherwise(F.col(attr)),
            }
        )
        .select(*base.columns)
    )


def scd2_from_log(log: DataFrame, key: str, attr: str, date: str, tiebreak: Sequence[str]) -> DataFrame:
    """Versions from a change log: consecutive equal values merge; several changes on one day keep the last.

    Each key is cut into months, so a key with very many changes is spread over tasks.
    """
    day = F.col(date).cast("date")
    last_of_day = (
        log.groupBy(F.col(key), day.alias("valid_from"))
        .agg(F.max(F.struct(*tiebreak, F.col(attr).alias("_attr"))).alias("_w"))
        .select(key, "valid_from", F.col("_w._attr").alias(attr))
    )
    seen = neighbour(
        last_of_day.withColumn("_row", F.lit(1)), [key], ["valid_from"], [attr, "_row"], month_cell("valid_from")
    )
    starts = pin(
        seen.filter(F.col("prev__row").isNull() | ~F.col(attr).eqNullSafe(F.col(f"prev_{attr}"))).select(
            key, attr, "valid_from"
        )
    )
    numbered = number_and_next(starts, [key], "valid_from", month_cell("valid_from"), "version_no", "next_valid_from")
    return numbered.select(
        key,
        attr,
        "version_no",
        "valid_from",
        F.coalesce(F.date_sub("next_valid_from", 1), F.lit(OPEN_END).cast("date")).alias("valid_to"),
        F.col("next_valid_from").isNull().alias("is_current"),
    )


def version_overlaps(dim: DataFrame, key: str) -> DataFrame:
    """Versions that reach into the next one; must be empty before a point-in-time join."""
    nxt = neighbour(dim.select(key, "valid_from", "valid_to"), [key], ["valid_from"], ["valid_from"], month_cell("valid_from"), ahead=True)
    return nxt.filter(F.col("next_valid_from") <= F.col("valid_to"))


def scd2_key_join(fact: DataFrame, dim: DataFrame, version_key: str) -> DataFrame:
    """The version each fact was recorded under, by its surrogate key."""
    return fact.join(dim, version_key)


def scd2_asof_join(fact: DataFrame, dim: DataFrame, key: str, date: str) -> DataFrame:
    """The version valid on the fact's date.

    Versions are listed once per month they cover inside the fact's date range. The join
    is then on (key, month) with the interval as residual, so a busy key is split by month
    and a fact meets only versions of its own month.
    """
    day = F.col(date).cast("date")
    span = fact.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    month = lambda d: F.year(d) * 12 + F.month(d)
    first = month(F.greatest(F.col("valid_from"), span.select("lo").scalar()))
    final = month(F.least(F.col("valid_to"), span.select("hi").scalar()))
    monthly = (
        dim.withColumn("_first", first)
        .withColumn("_final", final)
        .filter(F.col("_first") <= F.col("_final"))
        .withColumn("_month", F.explode(F.sequence("_first", "_final")))
        .withColumnRenamed(key, "_dim_key")
        .drop("_first", "_final")
    )
    return (
        fact.withColumns({"_day": day, "_fact_month": month(day)})
        .join(
            monthly,
            (F.col(key) == F.col("_dim_key"))
            & (F.col("_fact_month") == F.col("_month"))
            & F.col("_day").between(F.col("valid_from"), F.col("valid_to")),
        )
        .drop("_day", "_fact_month", "_month", "_dim_key")
    )


def scd2_history(versioned_facts: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Timeline of facts per version: mean, count, validity label and CURRENT or HISTORICAL."""
    return (
        versioned_facts.groupBy(*keys, "valid_from", "valid_to", "is_current")
        .agg(publish(mean(measure)).alias("mean_score"), F.count(F.lit(1)).alias("response_count"))
        .select(
            *keys,
            path_label(["valid_from", "valid_to"], " to ").alias("valid_range"),
            F.when(F.col("is_current"), "CURRENT").otherwise("HISTORICAL").alias("version_status"),
            "mean_score",
            "response_count",
        )
    )
