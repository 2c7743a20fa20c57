"""Session defaults and the shared folder used for checkpoints and published tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


BYTES_PER_TASK = 200 * 1024 * 1024


def shuffle_partitions(input_bytes: int) -> int:
    """Enough partitions for about 200 MB each; adaptive execution merges the ones that stay small."""
    return max(200, -(-input_bytes // BYTES_PER_TASK))


def build_session(
    master: str | None = None, app: str = "tallyhouse", input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with adaptive execution and skew handling on. Settings passed in `conf` win.

    `input_bytes`, the size of the largest table, sets the number of shuffle partitions.
    """
    settings = {
        **({"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes))} if input_bytes else {}),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # a hot key on the fact side of a shuffled join is split over tasks, even if that costs a shuffle after it
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_RAISED = "tallyhouse.initialPartitionNum"  # the number set here; another one is the user's own
_SPLIT = "spark.sql.files.maxPartitionBytes"
SHUFFLE_BYTES = 16 << 20  # read by a task after an exchange
UNSORTED = 200  # up to so many partitions a task writes its shuffle without sorting it in memory


def initial_partitions(input_bytes: int) -> int:
    """Partitions to shuffle into before small ones are merged: one per 4 MB stored (about 16 MB shuffled) up to 200,
    one per 16 MB up to 20,000, then one per 200 MB."""
    by = lambda size: -(-input_bytes // size)
    return max(min(by(4 << 20), UNSORTED), min(by(16 << 20), 20_000), by(BYTES_PER_TASK))


def bounded_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Let adaptive execution merge shuffle partitions up to 16 MB, where the session has Spark's default of 64 MB.
    A task's sorts and hash tables take about 15 times what it reads. Skewed partitions are still split.

    `input_bytes`, the stored size of the largest table, raises the number of partitions before merging where the
    session has fewer, since a fixed number grows with the input. Past 200 a task sorts all it scans by partition, so
    it then scans 32 MB instead of the default 128 MB. Settings of the user's own stay.
    """
    if spark.conf.get(_ADVISORY) == f"{64 << 20}b":
        spark.conf.set(_ADVISORY, f"{SHUFFLE_BYTES}b")
    now = spark.conf.get(_INITIAL, None)
    if now != spark.conf.get(_RAISED, None):
        return
    parts = max(initial_partitions(input_bytes), int(now or 0))
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(parts))
        spark.conf.set(_RAISED, str(parts))
        if parts > UNSORTED and spark.conf.get(_SPLIT) == f"{128 << 20}b":
            spark.conf.set(_SPLIT, f"{32 << 20}b")
    elif now:  # the session's number has been raised since
        spark.conf.unset(_INITIAL)
        spark.conf.unset(_RAISED)


def stored_size(df: DataFrame) -> int:
    """Bytes of the files that `df` reads, as the planner knows them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. A private one is made only for local masters."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if named is None and current is None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if current is None:
        if named is None:
            named = tempfile.mkdtemp(prefix="tallyhouse-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return named or current


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's stored intermediates, under the shared one."""
    return f"{shared_root(spark).rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's run folder."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete the run folder, once nothing that was stored in it is read any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete one stored intermediate that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def pin(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder and cut its lineage there."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def pin_step(df: DataFrame) -> DataFrame:
    """`pin` for the steps of an iteration, as a stored table. A checkpoint keeps the planner's estimate of its size,
    a product over all joins before it, whose digits multiply with each step; a stored table has the size of its files."""
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
