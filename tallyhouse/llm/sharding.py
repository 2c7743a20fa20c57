"""Uniform sharding by a hypergeometric communication matrix.

A uniform shuffle into shards of exact sizes, in one exchange. Rows are numbered by their file and
their place in it, and each `chunk_rows` of them are a chunk, whatever task reads them. How many rows
each chunk sends to each shard follows the multivariate hypergeometric law; a row of that matrix is
drawn where it is used, by splitting the chunks in halves from all down to one (the same seed for the
same half), so no place holds the matrix, and a chunk costs a draw per shard and halving. The rows of a
chunk go to the shards in a random order (the local permutation) and are exchanged.

Each shard is permuted again by random 64-bit keys: its slots are the ranks of its rows' keys. So that no task
holds a shard, it is cut into ranges of keys of about `target_rows` rows, whose numbers of rows are
counted from the row numbers alone. Equal texts are rows like others: the law counts rows.

`docs` that is not read from Parquet files is stored as such first. A task that meets a row that was not
counted fails. An empty table gives no rows. Null text has no bytes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import bounded_batches, file_rows, numbered, partitions, read

TARGET_ROWS = 4096
CHUNK_ROWS = 1 << 14
TASK_BYTES = 32 << 20  # of stored input for a task after the exchange
_HELD = 64  # chunks of which a task keeps the order
_LIBRARY = 10**9  # most rows that the library's own draw takes
SHARDS = 40
SEED = 20240501


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among `drawn` of `good + bad`: beyond the library's range by inversion over the twelve
    standard deviations around the mean, outside of which lies less than a double can tell."""
    total = good + bad
    if total < _LIBRARY:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    mean = drawn * good / total
    spread = math.sqrt(mean * (bad / total) * ((total - drawn) / max(1, total - 1)))
    low, high = max(low, int(mean - 12 * spread) - 12), min(high, int(mean + 12 * spread) + 12)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def split(rng: np.random.Generator, sizes: list[int], drawn: int) -> list[int]:
    """How many of `drawn` rows go to each target, of which `sizes` places are free."""
    out, left = [], sum(sizes)
    for size in sizes:
        left -= size
        out.append(hypergeometric(rng, size, left, drawn))
        drawn -= out[-1]
    return out


def matrix_row(before: Callable[[int], int], chunks: int, sizes: list[int], row: int, seed: int) -> list[int]:
    """Row `row` of the matrix with column sums `sizes`; `before(c)` rows come ahead of chunk c."""
    first, last = 0, chunks
    while last - first > 1:
        middle = (first + last) // 2
        left = split(np.random.default_rng([seed, first, last]), sizes, before(middle) - before(first))
        if row < middle:
            last, sizes = middle, left
        else:
            first, sizes = middle, [s - t for s, t in zip(sizes, left, strict=True)]
    return sizes


def shuffle_to_shards(docs: DataFrame, shards: int, *, seed: int = SEED, target_rows: int = TARGET_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """`docs` with `_shard` and `_slot` (gapless from 0 in each shard), uniform over all orders of the rows."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs, files = file_rows(docs)
    total = files.agg(F.sum("_rows")).first()[0] or 0
    chunks = max(1, -(-total // chunk_rows))
    sizes = [total // shards + (shard < total % shards) for shard in range(shards)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = lambda c: min(total, c * chunk_rows)
        orders: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, at = np.divmod(batch.column(0).to_numpy(), chunk_rows)
            own = np.empty(len(at), np.int32)
            for c in np.unique(chunk).tolist():
                if c not in orders:
                    if len(orders) == _HELD:
                        del orders[next(iter(orders))]
                    sent = matrix_row(before, chunks, sizes, c, seed)
                    orders[c] = np.random.default_rng([seed, c, chunks, 1]).permutation(np.repeat(np.arange(shards, dtype=np.int32), sent))
                mine = chunk == c
                own[mine] = orders[c][at[mine]]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(own), batch.column(0)], [*batch.schema.names[1:], "_shard", "_from"])

    def dealt(*columns) -> DataFrame:
        kept = docs.select(*columns).schema.fields
        schema = T.StructType([*kept, T.StructField("_shard", T.IntegerType()), T.StructField("_from", T.LongType())])
        ranges = max(1, -(-max(sizes) // target_rows))
        out = numbered(docs, files, *columns).mapInArrow(deal, schema).withColumn("_key", F.xxhash64(F.lit(seed), "_from"))
        # the upper 31 bits of the key, as an equal share of the ranges
        return out.withColumn("_range", F.shiftright(F.shiftrightunsigned("_key", 33) * ranges, 31).cast("int"))

    counts = dealt().groupBy("_shard", "_range").count()
    ahead = Window.partitionBy("_shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(F.col("_shard").alias("_s"), F.col("_range").alias("_r"), F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_first"))
    stored = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(partitions(spark), -(-stored // TASK_BYTES))
    # keys are the same in each attempt, and rows with one key go by where they came from
    again = Window.partitionBy("_shard", "_range").orderBy("_key", "_from")
    rows = dealt(*docs.columns).repartition(parts, "_shard", "_range").withColumn("_slot", F.row_number().over(again).cast("long") - 1)
    placed = rows.join(firsts, (F.col("_shard") == F.col("_s")) & (F.col("_range") == F.col("_r")))
    return placed.withColumn("_slot", F.col("_slot") + F.col("_first")).drop("_s", "_r", "_first", "_from", "_key", "_range")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return shuffle_to_shards(docs, SHARDS).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
