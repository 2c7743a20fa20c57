"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import scratch_path

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches of texts hold 8 MB, where the session has Spark's default of 64 MB: a task holds
    a few copies of a batch, outside of the heap, and has no use for larger ones."""
    if spark.conf.get(_BATCH, None) == f"{64 << 20}b":
        spark.conf.set(_BATCH, "8m")


def release() -> None:
    """Give freed memory back to the system at the end of a task: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def _plain_parquet(docs: DataFrame) -> bool:
    """Whether `docs` is columns of Parquet files, with each of their rows."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "SubqueryAlias") and plan.deterministic():
        plan = plan.children().apply(0)
    if plan.getClass().getSimpleName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return False
    return plan.relation().fileFormat().getClass().getSimpleName() == "ParquetFileFormat"


_GROUPS = 256  # of files, by a hash of their paths


def file_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A table with the rows of `docs`, read from Parquet files as they are, and a stored table of its files:
    (_path, _first, _rows), the number of a file's first row and of its rows.

    The table is `docs` itself where that is read from such files, and else a copy of it in the shared folder. Files
    are numbered by groups of their paths' hashes, and stay in Spark: there may be very many of them.
    """
    spark = docs.sparkSession
    for copy in (not _plain_parquet(docs), True):
        if copy:
            path = scratch_path(spark, "rows")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
        place = docs.metadataColumn("_metadata")
        found = docs.select(place["file_path"].alias("_path"), place["row_index"].alias("at")).groupBy("_path").agg(F.count("*").alias("_rows"), F.max("at").alias("last"))
        at = scratch_path(spark, "files")
        found.withColumn("_group", F.pmod(F.xxhash64("_path"), F.lit(_GROUPS)).cast("int")).write.parquet(at)
        files = spark.read.parquet(at)
        if files.filter("_rows <> last + 1").isEmpty():  # not with a path that is read twice
            break
    else:
        raise RuntimeError("the stored copy has other rows than its files")
    ahead = lambda w: F.coalesce(F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = files.groupBy("_group").agg(F.sum("_rows").alias("_rows")).select("_group", ahead(Window.orderBy("_group")).alias("_start"))
    inside = files.withColumn("_inner", ahead(Window.partitionBy("_group").orderBy("_path")))
    numbered_at = scratch_path(spark, "numbers")
    inside.join(groups, "_group").select("_path", (F.col("_start") + F.col("_inner")).alias("_first"), "_rows").write.parquet(numbered_at)
    return docs, spark.read.parquet(numbered_at)


def numbered(docs: DataFrame, files: DataFrame, *columns, key: str = "_row") -> DataFrame:
    """The named columns and the number of each row, gapless in the order of `files`; both are from `file_rows`.

    The files are a stored table of known size, so Spark broadcasts it only where it is small.
    """
    place = docs.metadataColumn("_metadata")
    placed = docs.select(place["file_path"].alias("_path"), place["row_index"].alias("_at"), *columns).join(files, "_path", "left")
    number = F.when(F.col("_at") < F.col("_rows"), F.col("_first") + F.col("_at")).otherwise(F.raise_error(F.lit("the input has other rows than were counted: store it first")).cast("long"))
    return placed.withColumn(key, number).select(key, *[c for c in placed.columns if c not in files.columns and c != "_at"])


def keyed(docs: DataFrame, *columns, key: str = "_row") -> DataFrame:
    """The named columns and a row number that tells repeated rows apart.

    The number follows from the file and the place in it, so it is the same in each scan however the
    files are split over tasks. What is not read from Parquet files is stored as such first; to number it
    twice alike, take one table from `file_rows`.
    """
    docs, files = file_rows(docs)
    return numbered(docs, files, *columns, key=key)


def binaries(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def batches_of(batches: Iterator[pa.RecordBatch], name: str, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of Arrow batches whose column `name` holds about `limit` bytes together."""
    group: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            group.append(batch)
            size += batch.column(batch.schema.get_field_index(name)).nbytes
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def partitions(spark: SparkSession, floor: int = 1) -> int:
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_texts(batch: pa.RecordBatch, text: str, texts: list[bytes | None], changed: list[int], chars: str | None) -> pa.RecordBatch:
    """`batch` with new texts, and with the number of code points of the changed ones in column `chars`."""
    columns = list(batch.columns)
    at = batch.schema.get_field_index(text)
    columns[at] = pa.array(texts, pa.binary()).cast(columns[at].type)
    if chars is not None and changed:
        at = batch.schema.get_field_index(chars)
        counts = columns[at].to_pylist()
        for i in changed:
            counts[i] = len(texts[i].decode())
        columns[at] = pa.array(counts, columns[at].type)
    return pa.RecordBatch.from_arrays(columns, batch.schema.names)
