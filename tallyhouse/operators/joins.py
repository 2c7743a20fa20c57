"""Star, snowflake and lookup joins.

No broadcast hints on tables: the optimizer and adaptive execution compare a
side's size with spark.sql.autoBroadcastJoinThreshold and otherwise shuffle,
splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.spread import dense_index, null_safe_join

LITERAL_LIMIT = 10_000
CELLS_PER_TASK = 5_000_000


def star_query(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str]],
    group_by: Sequence[str],
    aggs: Sequence[Column],
    where: Column | None = None,
) -> DataFrame:
    """Fact joined to its dimensions on their keys, filtered, then grouped."""
    joined = fact
    for dim, key in dims:
        joined = joined.join(dim, key)
    if where is not None:
        joined = joined.filter(where)
    return joined.groupBy(*group_by).agg(*aggs)


def flatten_chain(chain: Sequence[tuple[DataFrame, str | None]]) -> DataFrame:
    """Normalised dimension tables, finest first, joined to one table. Each pair is (level, parent key)."""
    flat = chain[0][0]
    for (_, parent_key), (parent, _) in zip(chain, chain[1:], strict=False):
        flat = flat.join(parent, parent_key)
    return flat


def snowflake_query(
    fact: DataFrame,
    chain: Sequence[tuple[DataFrame, str | None]],
    fact_key: str,
    level: Sequence[str],
    aggs: Sequence[Column],
) -> DataFrame:
    """Roll a fact up to a level of a dimension chain. The chain is joined before it meets the fact."""
    dim = flatten_chain(chain).select(fact_key, *level)
    return fact.join(dim, fact_key).groupBy(*level).agg(*aggs)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, limit: int = LITERAL_LIMIT) -> DataFrame:
    """A small literal relation, sent to every task. Lists longer than `limit` are refused; they belong in a table."""
    if len(rows) > limit:
        raise ValueError(f"literal relation of {len(rows)} rows; the limit is {limit}")
    return spark.createDataFrame(list(rows), schema)


def categorize(df: DataFrame, mapping: Mapping, key: str, out: str = "category") -> DataFrame:
    """Inner join to an inline lookup. The lookup's length is bounded by LITERAL_LIMIT."""
    kind = df.schema[key].dataType.simpleString()
    lookup = literal_rows(df.sparkSession, list(mapping.items()), f"`{key}` {kind}, `{out}` string")
    return df.join(F.broadcast(lookup), key)


def label_lookup(df: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Attach a label; an unknown key keeps the key itself as label, and of several labels of a key the least counts."""
    named = df.join(labels.groupBy(key).agg(F.min(label).alias(label)), key, "left")
    return named.withColumn(label, F.coalesce(F.col(label), F.col(key).cast("string")))


def with_group_size(df: DataFrame, keys: Sequence[str], out: str = "group_size") -> DataFrame:
    """Row count of each row's group, NULL keys included."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return null_safe_join(df, sizes, keys)


def with_distinct_group_size(df: DataFrame, keys: Sequence[str], column: str, out: str = "group_size") -> DataFrame:
    """COUNT(DISTINCT column) OVER (PARTITION BY keys), as an aggregate joined back."""
    sizes = df.groupBy(*keys).agg(F.countDistinct(column).alias(out))
    return null_safe_join(df, sizes, keys)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def cross_cells(dims: Sequence[DataFrame], order: Sequence[Sequence[str]]) -> DataFrame:
    """Every combination of the dimensions' rows, built from a number range.

    Each dimension is numbered; a cell's number is read as mixed-radix digits
    that pick one row of every dimension by equi-join.
    """
    spark = dims[0].sparkSession
    indexed, sizes = [], []
    for i, (dim, keys) in enumerate(zip(dims, order, strict=True)):
        numbered = dense_index(dim, keys, out=f"_i{i}")
        indexed.append(numbered)
        sizes.append(numbered.count())
    total = 1
    for n in sizes:
        total *= n
    slices = max(spark.sparkContext.defaultParallelism, -(-total // CELLS_PER_TASK))
    cells = spark.range(0, total, 1, slices).withColumnRenamed("id", "cell_no")
    step = 1
    for i in reversed(range(len(dims))):
        cells = cells.withColumn(f"_i{i}", F.expr(f"(cell_no div {step}) % {max(sizes[i], 1)}"))
        step *= max(sizes[i], 1)
    for i, dim in enumerate(indexed):
        cells = cells.join(dim, f"_i{i}").drop(f"_i{i}")
    return cells
