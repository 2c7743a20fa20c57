"""Upserts, incremental loads and materialised results with refresh and staleness."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.compare import staleness
from tallyhouse.operators.ranking import dedup_latest
from tallyhouse.operators.rollup import apply_changes, build_rollup, merge_rollups
from tallyhouse.operators.spread import null_safe_join
from tallyhouse.session import pin
from tallyhouse.sources.published import latest_version, publish_version, read_version, stored_or_empty


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target whose key is not updated, plus the updates. Keys are unique in `updates`."""
    kept = null_safe_join(target, updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates)


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition: str) -> None:
    """Upsert into a partitioned parquet table, rewriting only the partitions that the updates touch:
    those they go to, and those that hold an older row of their keys.

    The merged rows are pinned before the write, since the write replaces files they come from. A
    partition whose last row moved away is removed after the write.
    """
    stored = spark.read.parquet(path)
    held = null_safe_join(stored.select(*dict.fromkeys([*keys, partition])), updates.select(*keys).distinct(), keys, "left_semi")
    touched = pin(held.select(F.col(partition).alias("_p")).union(updates.select(F.col(partition).alias("_p"))).distinct())
    affected = stored.join(touched, F.col(partition).eqNullSafe(F.col("_p")), "left_semi")
    merged = pin(upsert(affected, updates.select(*affected.columns), keys))
    emptied = touched.join(merged.select(F.col(partition).alias("_q")).distinct(), F.col("_p").eqNullSafe(F.col("_q")), "left_anti")
    folders = (
        stored.select(partition, F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1).alias("folder"))
        .join(emptied, F.col(partition).eqNullSafe(F.col("_p")), "left_semi")
        .select("folder").distinct().collect()
    )
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    jvm = spark.sparkContext._jvm
    for row in folders:
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.folder))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def newer_than_target(source: DataFrame, target: DataFrame, ts: str, lookback: str | None = None) -> DataFrame:
    """Source rows past the target's newest timestamp; everything when the target is empty.

    Strict mode drops late rows. `lookback` (an interval such as '3 days') re-reads a margin
    and relies on the keyed upsert to absorb repeats.
    """
    instant = isinstance(target.schema[ts].dataType, T.TimestampType)
    # an instant is read as a number, since its text depends on the zone of who reads it
    newest = target.agg((F.unix_micros(F.max(ts)) if instant else F.max(ts)).alias("newest")).first()[0]
    if newest is None:
        return source
    # a literal bound reaches the source's scan, a subquery would not
    high = (F.timestamp_micros(F.lit(newest)) if instant else F.lit(str(newest))).cast(source.schema[ts].dataType)
    return source.filter(F.col(ts) > high if lookback is None else F.col(ts) >= high - F.expr(f"INTERVAL {lookback}"))


def incremental_load(
    source: DataFrame, target: DataFrame, keys: Sequence[str], ts: str, lookback: str | None = "3 days"
) -> DataFrame:
    """Upsert of the new rows. Of several rows of one key in the batch the latest counts."""
    batch = dedup_latest(newer_than_target(source, target, ts, lookback), keys, [ts])
    return upsert(target, batch, keys)


def update_where(df: DataFrame, condition: Column, sets: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in sets.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false or unknown stay, as with SQL DELETE."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


_FILES = "source STRING, files BIGINT, bytes BIGINT, newest_file TIMESTAMP, marks DECIMAL(38,0), row_count BIGINT, newest STRING"


def file_state(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One row on the files of a stored table: how many, how large, how new, and a sum over hashes of their names,
    sizes and times. Only file listings are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.max("modificationTime").alias("newest_file"),
        F.coalesce(F.sum(mark), F.lit(0)).cast("decimal(38,0)").alias("marks"),
    ).select(F.lit(name).alias("source"), "*")


class MaterializedView:
    """A stored rollup of a source query, published as versions under one path.

    `inputs` names the stored tables the query reads, as a path or a path and its time column. Each version
    keeps a manifest of them, taken before the query runs, so staleness is a comparison of file listings; a file that
    arrives during a refresh leaves the version stale.
    """

    def __init__(
        self, spark: SparkSession, path: str, source: Callable[[], DataFrame], dims: Sequence[str], measure: str,
        inputs: Mapping[str, str | tuple[str, str]] | None = None,
    ):
        self.spark, self.path, self.source = spark, path, source
        self.dims, self.measure = list(dims), measure
        self.inputs = {name: (at, None) if isinstance(at, str) else at for name, at in (inputs or {}).items()}

    def live(self) -> DataFrame:
        return build_rollup(self.source(), self.dims, self.measure)

    def _published(self, build: Callable[[], DataFrame]) -> int:
        before = self._input_states(measured=True).collect() if self.inputs else []  # one row per named input
        version = publish_version(build(), self.path, self.dims)
        if before:
            self.spark.createDataFrame(before, _FILES).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/inputs/v={version}")
        return version

    def refresh(self) -> int:
        return self._published(self.live)

    def refresh_incremental(self, new_rows: DataFrame) -> int:
        """Fold only the new rows into the stored parts."""
        delta = build_rollup(new_rows, self.dims, self.measure)
        return self._published(lambda: merge_rollups(self.read(), delta, self.dims))

    def refresh_changes(self, inserted: DataFrame, removed: DataFrame) -> int:
        """Fold in rows that came and rows that went; an updated row is one of each. The source has the changes already."""
        return self._published(lambda: apply_changes(self.read(), inserted, removed, self.source(), self.dims, self.measure))

    def read(self, version: int | None = None) -> DataFrame:
        return read_version(self.spark, self.path, version)

    def version(self) -> int | None:
        return latest_version(self.spark, self.path)

    def _input_states(self, measured: bool = False) -> DataFrame:
        """File state of each input; `measured` adds its rows (from file footers) and its newest instant (one column)."""
        out = None
        for name, (path, ts) in self.inputs.items():
            state = file_state(self.spark, name, path)
            if measured:
                rows = self.spark.read.parquet(path)
                newest = F.max(ts).cast("string") if ts else F.lit(None).cast("string")
                state = state.crossJoin(rows.agg(F.count("*").alias("row_count"), newest.alias("newest")))  # one row each
            out = state if out is None else out.unionByName(state)
        return out

    def input_staleness(self, version: int | None = None) -> DataFrame:
        """Per input: files and bytes then and now, rows and newest instant then, and FRESH, STALE or UNKNOWN (no manifest)."""
        if not self.inputs:
            raise ValueError("name the inputs of the view to compare them")
        version = self.version() if version is None else version
        known = stored_or_empty(self.spark, f"{self.path}/inputs/v={version}", _FILES)
        now = self._input_states()
        then = known.select("source", F.col("files").alias("stored_files"), F.col("bytes").alias("stored_bytes"), "row_count", "newest", F.col("marks").alias("_then"))
        status = F.when(F.col("_then").isNull(), "UNKNOWN").when(F.col("_then") == F.col("marks"), "FRESH").otherwise("STALE")
        return now.join(then, "source", "left").select("source", "stored_files", "files", "stored_bytes", "bytes", "row_count", "newest", status.alias("status"))

    def staleness(self) -> DataFrame:
        """Row by row against the live result, which is computed in full."""
        return staleness(self.read(), self.live(), self.dims, ["score_sum", "score_count"])

    def is_stale(self) -> bool:
        """From the manifest where inputs are named, else from the live result."""
        report = self.input_staleness() if self.inputs else self.staleness()
        return not report.filter("status <> 'FRESH'").isEmpty()
