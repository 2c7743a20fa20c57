"""Partitioned parquet tables whose updates happen at once or not at all.

Layout: <path>/data/<commit>/_part=<id>/ holds rows, <path>/lists/<commit> the folders of a snapshot, one row per
partition, and <path>/snapshots/v=<n> one line that names its list. A partition's id is a hash of its
value. A commit writes new folders for the partitions it touches, a list of these and all untouched ones, and
then moves its line to the next number, which fails if another commit took it. Until then readers see
the table as it was, whole; what a stopped commit leaves is named by no snapshot.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.operators.spread import null_safe_join
from tallyhouse.session import pin

_LIST = "part STRING, folder STRING"


class CommitConflict(Exception):
    """Another commit took the next number; start again from the newest snapshot."""


def _part(column: str):
    return F.hex(F.xxhash64(column))


def snapshot_versions(spark: SparkSession, path: str) -> list[int]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(where, "snapshots/v=*"))
    return sorted(int(str(s.getPath().getName())[2:]) for s in found or [])


def _listing(spark: SparkSession, path: str, version: int | None) -> tuple[int, DataFrame, str]:
    """Number, folders and schema of a snapshot; the newest when none is named."""
    known = snapshot_versions(spark, path)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no such snapshot under {path}")
    version = known[-1] if version is None else version
    line = json.loads(spark.read.text(f"{path}/snapshots/v={version}").first()[0])
    return version, spark.read.schema(_LIST).parquet(f"{path}/lists/{line['list']}"), line["schema"]


def _rows(spark: SparkSession, schema: str, folders: list[str]) -> DataFrame:
    kind = StructType.fromJson(json.loads(schema))
    return spark.read.schema(kind).parquet(*folders) if folders else spark.createDataFrame([], kind)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    _, folders, schema = _listing(spark, path, version)
    return _rows(spark, schema, [r.folder for r in folders.collect()])  # one per partition


def _commit(spark: SparkSession, path: str, version: int, rows: DataFrame, partition: str, untouched: DataFrame | None) -> int:
    commit = uuid.uuid4().hex
    data = f"{path}/data/{commit}"
    rows.withColumn("_part", _part(partition)).write.partitionBy("_part").parquet(data)
    made = spark.createDataFrame([], "_part STRING") if rows.isEmpty() else spark.read.schema("_part STRING").parquet(data)
    folders = made.select(F.col("_part").alias("part"), F.concat(F.lit(f"{data}/_part="), "_part").alias("folder")).distinct()
    (folders if untouched is None else folders.unionByName(untouched)).coalesce(1).write.parquet(f"{path}/lists/{commit}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    line, target = place(f"{path}/pending/{commit}"), place(f"{path}/snapshots/v={version}")
    files = line.getFileSystem(conf)
    out = files.create(line, False)
    out.write(bytearray(json.dumps({"list": commit, "schema": rows.schema.json()}).encode()))
    out.close()
    files.mkdirs(target.getParent())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(line, target, none)
    except Exception as e:
        if version in snapshot_versions(spark, path):
            raise CommitConflict(f"snapshot {version} is taken") from e
        raise
    return version


def create_snapshot(rows: DataFrame, path: str, partition: str) -> int:
    """Store `rows` as the first snapshot of a new table."""
    if snapshot_versions(rows.sparkSession, path):
        raise CommitConflict(f"{path} has snapshots already")
    return _commit(rows.sparkSession, path, 1, rows, partition, None)


def upsert_snapshot(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition: str) -> int:
    """Upsert by key as a new snapshot, writing only the partitions the updates go to and those that hold
    an older row of their keys. Keys are unique in `updates`; a partition that becomes empty is no longer listed."""
    version, folders, schema = _listing(spark, path, None)
    folders = pin(folders)
    stored = _rows(spark, schema, [r.folder for r in folders.collect()])
    updates = updates.select(*stored.columns)
    held = null_safe_join(stored.select(*dict.fromkeys([*keys, partition])), updates.select(*keys), keys, "left_semi")
    touched = pin(held.select(_part(partition).alias("part")).union(updates.select(_part(partition).alias("part"))).distinct())
    affected = _rows(spark, schema, [r.folder for r in folders.join(touched, "part", "left_semi").collect()])
    kept = null_safe_join(affected, updates.select(*keys), keys, "left_anti")
    return _commit(spark, path, version + 1, kept.unionByName(updates), partition, folders.join(touched, "part", "left_anti"))
