import datetime as dt
import shutil
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import layout, stats
from tallyhouse.streaming import ingest


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(9)
    data = []
    for i in range(300):
        g = rng.choice(["a", "b", "c"])
        x = rng.gauss({"a": 0, "b": 1, "c": 3}[g], 1)
        data.append((i, g, rng.choice(["u", "v"]), x, 2 * x + rng.gauss(0, 0.5), rng.gauss(0, 1)))
    return spark.createDataFrame(data, "id int, g string, h string, x double, y double, z double").cache()


def test_correlation_and_drivers(people, rows):
    data = people.collect()
    want = statistics.correlation([r.x for r in data], [r.y for r in data])
    assert stats.pearson(people, "x", "y").first().r == pytest.approx(want, abs=1e-4)
    out = stats.driver_analysis(people, "y", ["x", "z"], ["g"])
    assert rows(out.filter("driver_rank = 1").select("g", "driver")) == [("a", "x"), ("b", "x"), ("c", "x")]
    model = stats.multi_driver_regression(people, "y", ["x", "z"])
    assert model.coefficients[0] == pytest.approx(2.0, abs=0.1) and model.coefficients[1] == pytest.approx(0.0, abs=0.1)


def test_welch_and_anova_from_definitions(people):
    data = people.collect()
    groups = {g: [r.x for r in data if r.g == g] for g in "abc"}
    a, b = groups["a"], groups["b"]
    se = (statistics.variance(a) / len(a) + statistics.variance(b) / len(b)) ** 0.5
    assert stats.t_statistic(people.filter("g != 'c'"), "g", "x").first().t == pytest.approx((statistics.mean(a) - statistics.mean(b)) / se, abs=1e-3)
    grand = statistics.mean(x for v in groups.values() for x in v)
    ssb = sum(len(v) * (statistics.mean(v) - grand) ** 2 for v in groups.values())
    ssw = sum((x - statistics.mean(v)) ** 2 for v in groups.values() for x in v)
    assert stats.anova_f(people, "g", "x").first().f == pytest.approx((ssb / 2) / (ssw / 297), rel=1e-4)


def test_chi_squared_counts_empty_cells(spark):
    df = spark.createDataFrame([("a", "u")] * 10 + [("a", "v")] * 5 + [("b", "v")] * 15, "p string, q string")
    r = stats.chi_squared(df, "p", "q").first()
    observed = {("a", "u"): 10, ("a", "v"): 5, ("b", "u"): 0, ("b", "v"): 15}
    rows_, cols = {"a": 15, "b": 15}, {"u": 10, "v": 20}
    want = sum((o - rows_[p] * cols[q] / 30) ** 2 / (rows_[p] * cols[q] / 30) for (p, q), o in observed.items())
    assert (r.chi2, r.dof, r.n) == (pytest.approx(want, abs=0.01), 1, 30)


@pytest.mark.parametrize("a, b, test", [("x", "y", "pearson"), ("g", "h", "chi_squared"), ("h", "x", "t_statistic"), ("x", "g", "anova")])
def test_the_test_follows_the_columns(people, a, b, test):
    assert stats.auto_test(people, a, b).first().test == test


def test_attrition_model_separates(people):
    df = people.withColumn("gone", F.col("x") > 1.5)
    model = stats.attrition_model(df, ["x", "z"], "gone")
    scored = stats.attrition_scores(model, df.withColumn("gone2", F.col("gone")), ["id", "gone2"], ["x", "z"])
    right = scored.filter(F.col("at_risk") == F.col("gone2")).count()
    assert right / 300 > 0.9


def test_clustered_copy_keeps_ranges_apart(spark, tmp_path):
    df = spark.range(4000).withColumn("team", (F.col("id") * 7919) % 100)
    copy = layout.cluster_by(df, ["team"], str(tmp_path / "s"), files=6)
    zones = copy.groupBy("_metadata.file_path").agg(F.min("team").alias("low"), F.max("team").alias("high")).orderBy("low").collect()
    assert len(zones) == 6 and all(a.high <= b.low for a, b in zip(zones, zones[1:]))


def test_partition_filter_prunes_folders(spark, tmp_path):
    spark.range(100).withColumn("period", F.col("id") % 4).write.partitionBy("period").parquet(str(tmp_path / "p"))
    plan = layout.pruned(spark.read.parquet(str(tmp_path / "p")), "period", [2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan or "PartitionFilters: [(period" in plan


def test_encoding_profile_counts_runs(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 1), (3, "b", 1), (4, "a", None)], "pos int, v string, w int")
    assert rows(layout.encoding_profile(df, ["v", "w"], ["pos"])) == [("v", 2, 3, 0.0), ("w", 1, 3, 50.0)]


START = dt.datetime(2024, 1, 1)
SCHEMA = "id bigint, ts timestamp_ntz, k string, v double"


def arrivals(spark, path, *batches):
    for batch in batches:
        spark.createDataFrame([(i, START + dt.timedelta(hours=h), k, float(v)) for i, h, k, v in batch], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return ingest.stream_bronze(spark, path, spark.createDataFrame([], SCHEMA).schema, "ts", files_per_batch=1)


def test_stream_dedup_keeps_one_row_per_id_over_batches(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    arrivals(spark, path, [(1, 0, "a", 1), (2, 1, "a", 2), (1, 0, "a", 1)], [(2, 1, "a", 2), (3, 2, "b", 3)])
    out = ingest.drain(ingest.stream_dedup(source(spark, path), ["id"], "ts", "10 days"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert rows(out, "id") == [(1,), (2,), (3,)]


def test_copies_are_thinned_before_the_shuffle_and_rows_stay_whole(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    arrivals(spark, path, [(1, 0, "a", 1)] * 500 + [(2, 1, "b", 2)], [(1, 0, "a", 1)] * 500 + [(3, 2, "c", 3)])
    feed = ingest.stream_bronze(spark, path, spark.createDataFrame([], SCHEMA).schema, "ts", files_per_batch=1, arrival="_arrival")
    unique = ingest.stream_dedup(feed, ["id"], "ts", "10 days", arrival="_arrival", ways=16)
    query = unique.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id", "k", "v") == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)]
    kept = sorted(int(state["numRowsTotal"]) for state in query.lastProgress["stateOperators"])
    assert kept[0] == 3 and kept[1] == 16 + 2  # the hot key's rows were thinned in 16 places


def test_stream_gold_equals_batch_and_resumes(spark, rows, tmp_path):
    path, out, ck = str(tmp_path / "in"), str(tmp_path / "gold"), str(tmp_path / "ck")
    run = lambda: ingest.stream_gold(source(spark, path), "ts", "1 day", ["k"], "v", "30 days", out, ck).awaitTermination()
    arrivals(spark, path, [(1, 0, "a", 1), (2, 30, "a", 2)], [(3, 1, "a", 4), (4, 31, "b", 3)])
    run()
    arrivals(spark, path, [(5, 2, "a", 1)])
    run()
    stored = ingest.published_means(ingest.read_gold(spark, out, ["k"]), ["k"])
    everything = spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    batch = ingest.published_means(ingest.windowed_means(everything, "ts", "1 day", ["k"], "v"), ["k"])
    assert rows(stored) == rows(batch) and stored.count() == 3
    assert ingest.publish_gold(spark, out, ["k"], str(tmp_path / "serving")) == 1


def test_gold_reads_the_base_and_later_batches_only(spark, rows, tmp_path):
    path, out, ck = str(tmp_path / "in"), str(tmp_path / "gold"), str(tmp_path / "ck")
    run = lambda: ingest.stream_gold(source(spark, path), "ts", "1 day", ["k"], "v", "90 days", out, ck).awaitTermination()
    listed = []
    for turn in range(3):
        arrivals(spark, path, *[[(10 * turn + i, 24 * i, "ab"[i % 2], turn)] for i in range(3)])
        run()
        before = rows(ingest.read_gold(spark, out, ["k"]))
        assert ingest.compact_gold(spark, out, ["k"]) == turn + 1
        assert rows(ingest.read_gold(spark, out, ["k"])) == before and not list((tmp_path / "gold").glob("batch=*"))
        listed.append(len(ingest.read_gold(spark, out, ["k"]).inputFiles()))
    assert max(listed) <= listed[0] + 1  # not with the number of batches ever written
    everything = ingest.windowed_means(spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", ["k"], "v")
    assert rows(ingest.read_gold(spark, out, ["k"])) == rows(everything)
    # a fold that stopped before its announcement, and one that stopped before it deleted its batches
    arrivals(spark, path, [(99, 0, "a", 7)])
    run()
    want = rows(ingest.read_gold(spark, out, ["k"]))
    ingest.publish_gold(spark, out, ["k"], f"{out}/base")
    assert rows(ingest.read_gold(spark, out, ["k"])) == want
    batch = max((tmp_path / "gold").glob("batch=*"))
    shutil.copytree(batch, tmp_path / "left")
    assert ingest.compact_gold(spark, out, ["k"]) == 5
    shutil.copytree(tmp_path / "left", batch)
    assert rows(ingest.read_gold(spark, out, ["k"])) == want and ingest.compact_gold(spark, out, ["k"]) == 5 and not batch.exists()


def test_late_rows_are_kept_apart_and_none_is_lost(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "split")
    arrivals(spark, path, [(1, 100, "a", 1)], [(2, 99, "a", 1), (3, 10, "a", 1)], [(4, 200, "a", 1)], [(5, 120, "a", 1), (6, 199, "a", 1)])
    src = source(spark, path)
    ingest.stream_split_late(src, "ts", "1 day", out, str(tmp_path / "ck")).awaitTermination()
    read = lambda side: rows(spark.read.option("recursiveFileLookup", True).schema(src.schema).parquet(f"{out}/{side}"), "id")
    assert read("on_time") == [(1,), (2,), (4,), (6,)]
    assert read("late") == [(3,), (5,)]
