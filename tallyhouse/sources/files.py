"""CSV and parquet in and out, audit columns, views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headered CSV with a declared schema; a header that differs from the schema is an error."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def range_sorted(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in ranges of `columns`, sorted inside each range.

    A hash of the whole row is the last range key, so a value with very many
    rows is cut into several neighbouring ranges.
    """
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType | VariantType)]
    n = [partitions] if partitions else []
    return df.repartitionByRange(*n, *columns, F.xxhash64(*hashable)).sortWithinPartitions(*columns)


def write_parquet(
    df: DataFrame, path: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet export. With `sort_by` the rows are range-partitioned first, so files hold narrow ranges."""
    if sort_by:
        df = range_sorted(df, [*partition_by, *sort_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def materialize(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """CREATE TABLE AS SELECT: store the result and return a reader of it."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def with_audit(df: DataFrame, from_files: bool = True) -> DataFrame:
    """Load time and, for file scans, the file each row came from."""
    out = df.withColumn("_loaded_at", F.current_timestamp())
    return out.withColumn("_source_file", F.col("_metadata.file_path")) if from_files else out


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Data files and bytes under a path, from file metadata only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
