"""Streaming bronze ingest, dedup, incremental gold and late rows. Each run drains what has arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.functions.columns import publish
from tallyhouse.operators.ranking import dedup_latest
from tallyhouse.session import drop_stored
from tallyhouse.sources.published import publish_version, read_version


def stream_bronze(
    spark: SparkSession, path: str, schema: StructType, ts: str, files_per_batch: int = 1000, glob: str | None = None, arrival: str | None = None
) -> DataFrame:
    """Files as they arrive, with the event time as a watermarkable timestamp.

    `arrival` names a column for a hash of the file and the place in it: it tells copies apart, and a replay gives
    it again.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.parquet(path)
    if arrival:
        rows = rows.withColumn(arrival, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    return rows.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_dedup(sdf: DataFrame, key: Sequence[str], ts: str, delay: str, arrival: str | None = None, ways: int = 64) -> DataFrame:
    """First arrival per key within the watermark delay; state is bounded by the delay.

    The state of a key lives in one task. For a feed in which one key repeats very often, `arrival` (see
    `stream_bronze`) spreads each key over `ways` tasks first: these keep one row each, and only
    those go on to the key's own task. The arrival column is dropped.
    """
    rows = sdf.withWatermark(ts, delay)
    if arrival is None:
        return rows.dropDuplicatesWithinWatermark(list(key))
    spread = rows.withColumn(arrival, F.pmod(arrival, F.lit(ways)).cast("int"))
    return spread.dropDuplicatesWithinWatermark([*key, arrival]).drop(arrival).dropDuplicatesWithinWatermark(list(key))


def windowed_means(df: DataFrame, ts: str, window: str, keys: Sequence[str], measure: str) -> DataFrame:
    """Sum and count per tumbling window and key; works on batch and streaming frames."""
    return (
        df.groupBy(F.window(ts, window).alias("_w"), *keys)
        .agg(F.sum(F.col(measure).cast("decimal(18,4)")).alias("value_sum"), F.count(measure).alias("value_count"))
        .select(F.col("_w.start").alias("window_start"), *keys, "value_sum", "value_count")
    )


def published_means(gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    return gold.select(
        "window_start",
        *keys,
        publish(F.col("value_sum").cast("double") / F.col("value_count")).alias("mean_value"),
        F.col("value_count").alias("n"),
    )


def stream_gold(sdf: DataFrame, ts: str, window: str, keys: Sequence[str], measure: str, delay: str, out: str, checkpoint: str):
    """Keep a gold table up to date from the stream; read it with `read_gold`.

    Update mode emits each changed window. A batch writes only its changed rows,
    into a folder of its own, so a replay replaces what it wrote before and the
    cost of a batch does not grow with the table.
    """
    grouped = windowed_means(sdf.withWatermark(ts, delay), ts, window, keys, measure)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        grouped.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def _folders(spark: SparkSession, out: str, prefix: str) -> dict[int, str]:
    """Numbered folders <prefix><n> under `out`: those since the last fold, so few."""
    where = spark._jvm.org.apache.hadoop.fs.Path(out)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(where, f"{prefix}*"))
    numbers = [str(status.getPath().getName()).rsplit("=", 1)[1] for status in found or []]
    return {int(n): f"{out}/{prefix}{n}" for n in numbers if n.isdigit()}


def _base(spark: SparkSession, out: str) -> tuple[int, int] | None:
    """(last batch folded, version of the base that holds it), of the newest fold that was announced."""
    marks = _folders(spark, out, "folded/batch=")
    if not marks:
        return None
    last = max(marks)
    return last, spark.read.schema("version INT").json(marks[last]).first().version


def read_gold(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per window and key: of the compacted base and the batches written since.

    Batches up to the last fold are in the base and are not looked at, whether or not their folders are gone.
    """
    folded = _base(spark, out)
    after = [path for n, path in sorted(_folders(spark, out, "batch=").items()) if folded is None or n > folded[0]]
    base = None if folded is None else read_version(spark, f"{out}/base", folded[1]).withColumn("batch", F.lit(folded[0]).cast("long"))
    if not after:
        if base is None:
            raise FileNotFoundError(f"no batch was written to {out} yet")
        return base.drop("batch")
    newer = spark.read.option("basePath", out).parquet(*after).withColumn("batch", F.col("batch").cast("long"))
    return dedup_latest(newer if base is None else base.unionByName(newer), ["window_start", *keys], ["batch"]).drop("batch")


def compact_gold(spark: SparkSession, out: str, keys: Sequence[str]) -> int:
    """Fold all batches so far into a new base, announce it, and delete them; the base's version.

    A stop at any point leaves the table readable: until the announcement the old base and all batches count, after it
    left-over batches are ignored. Run it between runs of the stream.
    """
    batches, folded = _folders(spark, out, "batch="), _base(spark, out)
    last = max([*batches, *([folded[0]] if folded else [])])
    if folded and last == folded[0]:
        version = folded[1]  # nothing new, but an earlier fold may have left its batches
    else:
        version = publish_version(read_gold(spark, out, keys), f"{out}/base", ["window_start", *keys])
        spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("overwrite").json(f"{out}/folded/batch={last}")
    for n, path in batches.items():
        if n <= last:
            drop_stored(spark, path)
    return version


def publish_gold(spark: SparkSession, out: str, keys: Sequence[str], path: str) -> int:
    """Publish the current state as one key-sorted version for serving."""
    return publish_version(read_gold(spark, out, keys), path, ["window_start", *keys])


def split_late(batch: DataFrame, ts: str, max_seen, delay: str) -> tuple[DataFrame, DataFrame]:
    """Rows newer than the watermark (largest time seen less the delay), and the late rows."""
    bound = F.lit(max_seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    late = F.col(ts).cast("timestamp") <= bound
    return batch.filter(~late), batch.filter(late)


def drain(sdf: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Write everything available to parquet and return a reader of it."""
    query = (
        sdf.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sdf.sparkSession.read.schema(sdf.schema).parquet(path)


def stream_split_late(sdf: DataFrame, ts: str, delay: str, path: str, checkpoint: str):
    """Keep rows that arrive behind the watermark apart, as <path>/late next to <path>/on_time.

    The watermark is the largest time of all earlier batches less the delay; one
    row per batch under <path>/seen carries it on. Each batch writes folders of
    its own, so a replay replaces what it wrote before.
    """
    spark = sdf.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read three times
        try:
            write_parts(batch, batch_id)
        finally:
            batch.unpersist()

    def write_parts(batch: DataFrame, batch_id: int) -> None:
        bound = None
        if batch_id > 0:
            bound = spark.read.parquet(f"{path}/seen/batch={batch_id - 1}").first()[0]
        if bound is None:
            on_time, late = batch, batch.filter(F.lit(False))
        else:
            on_time, late = split_late(batch, ts, bound, delay)
        on_time.write.mode("overwrite").parquet(f"{path}/on_time/batch={batch_id}")
        late.write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        seen = batch.agg(F.greatest(F.max(ts), F.lit(bound).cast("timestamp")).alias("seen"))
        seen.write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")

    return sdf.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
