"""Entity-attribute-value, slots, JSON and sparse-wide forms of the same answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import as_col, json_value, publish
from tallyhouse.operators.compare import consistency_check
from tallyhouse.operators.joins import categorize
from tallyhouse.session import pin


def wide_to_eav(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per filled cell."""
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(ids), list(columns), "attribute", "value").filter(F.col("value").isNotNull())


def eav_to_wide(df: DataFrame, ids: Sequence[str], attrs: Sequence[str] | None = None, agg: str = "max", max_columns: int = 5_000
) -> DataFrame:
    """One column per attribute. Name the attributes on large tables: unnamed ones are discovered, which
    reads the data once more and refuses more than `max_columns` of them."""
    if attrs is None:
        found = df.select("attribute").distinct().limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"more than {max_columns} attributes; name the ones that become columns")
        attrs = sorted(r[0] for r in found)
    pick = {"max": F.max, "avg": F.avg, "sum": F.sum}[agg]
    return df.groupBy(*ids).agg(*[pick(F.when(F.col("attribute") == a, F.col("value"))).alias(a) for a in attrs])


def pack_json(df: DataFrame, key: Sequence[str], attr: str, value: str, out: str = "responses") -> DataFrame:
    """One JSON object per entity. Repeated answers to one question are averaged first, so an object stays small."""
    single = df.groupBy(*key, attr).agg(F.avg(F.col(value).cast("double")).alias("_v"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(attr), F.col("_v"))))
    return single.groupBy(*key).agg(F.to_json(F.map_from_entries(entries)).alias(out))


def eav_to_json(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    return pack_json(df, ids, "attribute", "value")


def json_to_eav(df: DataFrame, ids: Sequence[str], column: str, text: str | None = None) -> DataFrame:
    """One row per key of each object. Answers that are no numbers have a NULL value; `text` names a column
    for every answer as it stands."""
    parsed = F.from_json(F.col(column), T.MapType(T.StringType(), T.StringType()))
    entries = df.select(*ids, F.explode(parsed).alias("attribute", "_text"))
    return entries.select(*ids, "attribute", F.col("_text").try_cast("double").alias("value"), *([F.col("_text").alias(text)] if text else []))


def explode_keys(df: DataFrame, ids: Sequence[str], column: str) -> DataFrame:
    """One row per key, without the values."""
    return df.select(*ids, F.explode(F.json_object_keys(F.col(column))).alias("attribute"))


def json_columns(df: DataFrame, column: str, keys: Mapping[str, str]) -> DataFrame:
    """Named keys as typed columns next to the object."""
    return df.withColumns({k: json_value(column, k, kind) for k, kind in keys.items()})


def json_has_key(df: DataFrame, column: str, key: str) -> DataFrame:
    return df.filter(json_value(column, key, "string").isNotNull())


def slot_mapping(df: DataFrame, project: str, standard: Sequence[str]) -> DataFrame:
    """Slot numbers per project: standard questions first, in their order, then the project's own by name.

    Works on distinct (project, attribute) pairs, as many as there are questions.
    """
    place = F.array_position(F.array(*[F.lit(s) for s in standard]), F.col("attribute"))
    pairs = df.select(project, "attribute").distinct().withColumn("_place", F.when(place > 0, place).otherwise(len(standard) + 1))
    w = Window.partitionBy(project).orderBy("_place", "attribute")
    return pairs.select(project, F.row_number().over(w).alias("slot_number"), F.col("attribute").alias("question_id"))


def slot_overflow(mapping: DataFrame, n_slots: int) -> DataFrame:
    """Questions that do not fit; must be empty."""
    return mapping.filter(F.col("slot_number") > n_slots)


def eav_to_slots(df: DataFrame, ids: Sequence[str], project: str, standard: Sequence[str], n_slots: int = 20) -> tuple[DataFrame, DataFrame]:
    """Generic slot columns and the mapping that gives them meaning. Raises when a project has too many questions."""
    mapping = slot_mapping(df, project, standard)
    over = slot_overflow(mapping, n_slots).agg(F.countDistinct(project)).first()[0]
    if over:
        raise ValueError(f"more than {n_slots} questions in {over} projects; slot_overflow lists them")
    keyed = df.join(mapping.withColumnRenamed("question_id", "attribute"), [project, "attribute"])
    slots = keyed.groupBy(*ids, *([] if project in ids else [project])).agg(
        *[F.max(F.when(F.col("slot_number") == i, F.col("value"))).alias(f"slot_{i}") for i in range(1, n_slots + 1)]
    )
    return slots, mapping


def slots_to_eav(slots: DataFrame, mapping: DataFrame, ids: Sequence[str], project: str, n_slots: int = 20) -> DataFrame:
    """Filled slots with their question, through the mapping."""
    names = [f"slot_{i}" for i in range(1, n_slots + 1)]
    carried = list(dict.fromkeys([*ids, project]))
    long = slots.unpivot(carried, names, "_slot", "value").filter(F.col("value").isNotNull())
    numbered = long.withColumn("slot_number", F.substring_index("_slot", "_", -1).cast("int")).drop("_slot")
    return numbered.join(mapping, [project, "slot_number"]).select(*carried, F.col("question_id").alias("attribute"), "value")


def decode_slots(slots: DataFrame, mapping: DataFrame, ids: Sequence[str], project: str, n_slots: int = 20) -> DataFrame:
    """Mean per project and question, read through the mapping."""
    eav = slots_to_eav(slots, mapping, ids, project, n_slots)
    return eav.groupBy(project, F.col("attribute").alias("question_id")).agg(
        publish(F.avg("value")).alias("mean_score"), F.count(F.lit(1)).alias("response_count")
    )


def slot_meaning(mapping: DataFrame, project: str, slots: Sequence[int]) -> DataFrame:
    return mapping.filter(F.col("slot_number").isin(list(slots))).orderBy(project, "slot_number")


def questions_per_project(df: DataFrame, project: str) -> DataFrame:
    return df.groupBy(project).agg(F.countDistinct("attribute").alias("questions"))


def eav_category_means(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return categorize(df, mapping, "attribute").groupBy("category").agg(
        publish(F.avg("value")).alias("mean_score"), F.count(F.lit(1)).alias("response_count")
    )


def add_attribute(eav: DataFrame, rows: DataFrame) -> DataFrame:
    """New questions are new rows; the schema does not change."""
    return eav.unionByName(rows)


def add_json_key(df: DataFrame, column: str, key: str, value: Column | str) -> DataFrame:
    """Set one key of the object where the value is not NULL; other keys keep their values, of any kind."""
    parsed = F.from_json(F.col(column), T.MapType(T.StringType(), T.VariantType()))
    extra = F.map_from_arrays(F.array(F.lit(key)), F.array(F.to_variant_object(F.array(as_col(value)))))
    extra = F.transform_values(extra, lambda _, v: F.variant_get(v, "$[0]", "variant"))
    kept = F.map_filter(parsed, lambda k, _: k != key)
    merged = F.map_concat(F.coalesce(kept, F.create_map().cast(T.MapType(T.StringType(), T.VariantType()))), extra)
    return df.withColumn(column, F.when(as_col(value).isNotNull(), F.to_json(merged)).otherwise(F.col(column)))


def add_column(df: DataFrame, name: str, kind: str = "double") -> DataFrame:
    """A new question in the wide form is a schema change; old rows are NULL."""
    return df.withColumn(name, F.lit(None).cast(kind))


def encoding_equivalence(
    eav: DataFrame, ids: Sequence[str], project: str, group: str, attrs: Sequence[str], n_slots: int = 20
) -> DataFrame:
    """Means of the attributes per group on all four encodings, and whether they agree."""
    keys = [group]
    eav = pin(eav)
    from_eav = eav.groupBy(*keys).agg(
        *[publish(F.avg(F.when(F.col("attribute") == a, F.col("value")))).alias(f"{a}_avg") for a in attrs]
    )
    wide = eav_to_wide(eav, [*ids, group], attrs, agg="avg")
    from_wide = wide.groupBy(*keys).agg(*[publish(F.avg(a)).alias(f"{a}_avg") for a in attrs])
    packed = eav_to_json(eav, [*ids, group])
    from_json = packed.groupBy(*keys).agg(*[publish(F.avg(json_value("responses", a))).alias(f"{a}_avg") for a in attrs])
    slots, mapping = eav_to_slots(eav, [*ids, group], project, attrs, n_slots)
    back = slots_to_eav(slots, mapping, [*ids, group], project, n_slots)
    from_slots = back.groupBy(*keys).agg(
        *[publish(F.avg(F.when(F.col("attribute") == a, F.col("value")))).alias(f"{a}_avg") for a in attrs]
    )
    measures = [f"{a}_avg" for a in attrs]
    out = from_eav
    for name, other in (("wide", from_wide), ("json", from_json), ("slots", from_slots)):
        verdict = consistency_check(from_eav, other, keys, measures).select(*keys, F.col("status").alias(f"{name}_status"))
        out = out.join(verdict, keys)
    return out


def typed_flatten(
    df: DataFrame, ids: Sequence[str], column: str, question_meta: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """One typed column per declared question, its text, category and scale carried in the column's metadata."""
    out = df.select(*ids, *[json_value(column, q, meta.get("type", "double")).alias(q) for q, meta in question_meta.items()])
    for q, meta in question_meta.items():
        out = out.withMetadata(q, dict(meta))
    return out
