"""Versioned serving tables on plain parquet.

Layout: <path>/data/v=<n> holds key-sorted parquet, <path>/manifest/v=<n> one
JSON line written after the data. A version exists once its manifest does, so
readers never see half a load and can stay on the version they started with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.files import range_sorted

_MANIFEST = "version INT, row_count BIGINT, computed_at TIMESTAMP, keys STRING"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def stored_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A parquet table, or no rows where nothing was stored."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """All published versions, one row each."""
    if not _exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).json(f"{path}/manifest")


def latest_version(spark: SparkSession, path: str) -> int | None:
    return manifest(spark, path).agg(F.max("version")).first()[0]


def _claim(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(file)


def publish_version(df: DataFrame, path: str, keys: Sequence[str], version: int | None = None) -> int:
    """Write a new version, range-partitioned and sorted by key, then announce it.

    A version is claimed by creating a file that must not exist yet, so two loads never share one: the
    second takes the next number, or fails if it asked for this one. A load that died before its
    announcement leaves a claim and its data, which no reader sees.
    """
    spark = df.sparkSession
    newest = latest_version(spark, path) or 0
    asked, version = version, newest + 1 if version is None else version
    if version <= newest:
        raise ValueError(f"version {version} is not after {newest}")
    while not _claim(spark, f"{path}/claims/v={version}"):
        if asked is not None:
            raise ValueError(f"version {version} is taken by another load")
        version += 1
    data = f"{path}/data/v={version}"
    range_sorted(df, keys).write.mode("overwrite").parquet(data)
    rows = spark.read.schema(df.schema).parquet(data).count()  # from file footers
    entry = spark.range(1).select(
        F.lit(version).alias("version"),
        F.lit(rows).cast("bigint").alias("row_count"),
        F.current_timestamp().alias("computed_at"),
        F.lit(",".join(keys)).alias("keys"),
    )
    entry.write.mode("overwrite").json(f"{path}/manifest/v={version}")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version in full; the newest when none is named."""
    if version is None:
        version = latest_version(spark, path)
        if version is None:
            raise FileNotFoundError(f"nothing published under {path}")
    return spark.read.parquet(f"{path}/data/v={version}")


def serve(spark: SparkSession, path: str, version: int | None = None, **key) -> DataFrame:
    """Keyed read, in the order of the version's keys. The equality reaches the parquet scan, where sorted files skip by min/max."""
    out = read_version(spark, path, version)
    for column, value in key.items():
        out = out.filter(F.col(column) == F.lit(value))
    keys = manifest(spark, path).filter(F.col("version") == (latest_version(spark, path) if version is None else version)).first().keys
    return out.orderBy(*[F.col(c) for c in keys.split(",")])
