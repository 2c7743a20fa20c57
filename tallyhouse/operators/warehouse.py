"""Dimensional modelling: star from flat rows, surrogate keys, snowflake and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.joins import flatten_chain
from tallyhouse.operators.spread import dense_index, null_safe_join
from tallyhouse.session import pin_step


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dims: dict[str, DataFrame]


def assign_keys(incoming: DataFrame, natural_key: Sequence[str], key: str, existing: DataFrame | None = None) -> DataFrame:
    """Surrogate keys in natural-key order. Known members keep theirs; new ones follow the largest."""
    if existing is None:
        return dense_index(incoming, natural_key, out=key, start=1)
    known = existing.select(*natural_key, key)
    fresh = null_safe_join(incoming, existing.select(*natural_key), natural_key, "left_anti")
    last = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("m"))
    added = dense_index(fresh, natural_key, out=key, start=1).withColumn(key, F.col(key) + last.scalar())
    kept = null_safe_join(incoming, known, natural_key)
    return kept.unionByName(added)


def build_star(flat: DataFrame, dim_specs: Mapping[str, Sequence[str]], keep: Sequence[str]) -> Star:
    """Split flat rows into dimensions with surrogate keys and a fact that refers to them.

    `dim_specs` maps a key column to the dimension's attributes, natural key first. Dimensions are stored, so that
    the planner knows how small they are: a shuffled join would deal the fact by a few values of their attributes.
    """
    dims, fact = {}, flat
    for key, attrs in dim_specs.items():
        dims[key] = pin_step(assign_keys(flat.select(*attrs).distinct(), attrs, key))
        fact = null_safe_join(fact, dims[key], attrs)
    return Star(fact.select(*dim_specs, *keep), dims)


def normalize_dim(dim: DataFrame, levels: Sequence[tuple[str, Sequence[str]]]) -> list[tuple[DataFrame, str | None]]:
    """Split a flat dimension, finest level first, into tables linked by surrogate keys.

    `levels` lists (key, attributes). The finest level's key must already exist in `dim`.
    """
    chain: list[tuple[DataFrame, str | None]] = []
    current, parent_key = dim, None
    for i in range(len(levels) - 1, 0, -1):
        key, attrs = levels[i]
        columns = [*attrs, *([parent_key] if parent_key else [])]
        table = pin_step(assign_keys(current.select(*columns).distinct(), columns, key))
        chain.insert(0, (table, parent_key))
        current = null_safe_join(current, table, columns).drop(*columns)
        parent_key = key
    base_key, base_attrs = levels[0]
    chain.insert(0, (current.select(base_key, *base_attrs, *([parent_key] if parent_key else [])), parent_key))
    return chain


def flatten_dim(chain: Sequence[tuple[DataFrame, str | None]]) -> DataFrame:
    return flatten_chain(chain)
