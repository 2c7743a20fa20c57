"""Cell-wise windows against plain windows, with one hot key, NULL keys and ties."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators import spread


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        data.append((i, key, rng.randrange(0, 300), rng.randrange(1, 6)))
    return spark.createDataFrame(data, "id int, k string, pos int, score int").cache()


def same(a, b, columns):
    a, b = a.select(*columns), b.select(*columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("width", [1, 17, 1000])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks_match_window(skewed, width, descending):
    got = spread.ranks(skewed, ["k"], "pos", F.floor(F.col("pos") / width), descending)
    order = F.col("pos").desc() if descending else F.col("pos")
    w = Window.partitionBy("k")
    want = skewed.withColumn("rnk", F.rank().over(w.orderBy(order)).cast("bigint")).withColumn("group_rows", F.count("*").over(w))
    same(got, want, ["id", "rnk", "group_rows"])


def test_global_ranks(skewed):
    got = spread.ranks(skewed, [], "pos", F.floor(F.col("pos") / 20))
    want = skewed.withColumn("rnk", F.rank().over(Window.orderBy("pos")).cast("bigint"))
    same(got, want, ["id", "rnk"])


def test_running_total_matches_window(skewed):
    got = spread.running_total(skewed, ["k"], ["pos", "id"], "score", F.floor(F.col("pos") / 25))
    w = Window.partitionBy("k").orderBy("pos", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("running", F.sum("score").over(w)).withColumn("total", F.sum("score").over(Window.partitionBy("k")))
    same(got, want, ["id", "running", "total"])


@pytest.mark.parametrize("ahead", [True, False])
def test_neighbour_matches_lag_and_lead(skewed, ahead):
    got = spread.neighbour(skewed, ["k"], ["pos", "id"], ["score", "id"], F.floor(F.col("pos") / 13), ahead)
    w, shift, prefix = Window.partitionBy("k").orderBy("pos", "id"), F.lead if ahead else F.lag, "next_" if ahead else "prev_"
    want = skewed.withColumn(f"{prefix}score", shift("score").over(w)).withColumn(f"{prefix}id", shift("id").over(w))
    same(got, want, ["id", f"{prefix}score", f"{prefix}id"])


def test_number_and_next(skewed):
    distinct = skewed.select("k", "pos").distinct()
    got = spread.number_and_next(distinct, ["k"], "pos", F.floor(F.col("pos") / 40))
    w = Window.partitionBy("k").orderBy("pos")
    want = distinct.withColumn("rn", F.row_number().over(w).cast("bigint")).withColumn("next", F.lead("pos").over(w))
    same(got, want, ["k", "pos", "rn", "next"])


def test_dense_index_is_consecutive_in_order(skewed):
    got = spread.dense_index(skewed, [F.col("k").asc_nulls_first(), "pos", "id"], out="i", start=1)
    want = skewed.withColumn("i", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first(), "pos", "id")).cast("bigint"))
    same(got, want, ["id", "i"])


def test_rows_are_shuffled_once_for_window_and_join(skewed, spark):
    """The join back to the cell summaries reuses the window's partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spread.running_total(skewed, ["k"], ["pos", "id"], "score", F.floor(F.col("pos") / 17))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    left = plan.split("SortMergeJoin")[1].split("+- *")[0]
    assert left.count("Exchange hashpartitioning") <= 1


def test_null_safe_join_keeps_null_groups(skewed):
    sizes = skewed.groupBy("k").count()
    joined = spread.null_safe_join(skewed, sizes, ["k"])
    assert joined.count() == skewed.count()
