import datetime as dt
from unittest import mock

import pytest
from pyspark.sql import functions as F

from tallyhouse import session
from tallyhouse.functions import columns as c
from tallyhouse.sources import files, published, schemas
from tallyhouse.sources import survey as survey_view
from tallyhouse.sources.generate import generate_facts


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()[0]


@pytest.mark.parametrize("value, digits, wanted", [(1.005, 2, 1.01), (2.675, 2, 2.68), (2.345, 2, 2.35), (1.115, 2, 1.12), (3.25, 1, 3.3)])
def test_publish_rounds_half_up(spark, value, digits, wanted):
    assert one(spark, c.publish(F.lit(value), digits)) == wanted


def test_reverse_scale_and_clamp_and_bands(spark):
    df = spark.createDataFrame([(1, True), (5, True), (3, False), (None, True)], "s int, f boolean")
    got = df.select(c.reverse_scale("s", "f").alias("r"), c.clamp("s", 2, 4).alias("c"), c.likert_band("s").alias("b")).collect()
    assert [r.r for r in got] == [5, 1, 3, None]
    # GREATEST and LEAST skip NULL, as they do in SQL
    assert [r.c for r in got][:3] == [2, 4, 3]
    assert [r.b for r in got] == ["unfavorable", "favorable", "neutral", None]


def test_period_and_path_labels(spark):
    df = spark.createDataFrame([(dt.date(2025, 5, 14), "Ops", "Alpha"), (dt.date(2025, 12, 31), None, "Beta")], "d date, dep string, team string")
    got = df.select(c.period_label("d").alias("p"), c.path_label(["dep", "team"]).alias("l")).collect()
    assert [tuple(r) for r in got] == [("2025-Q2", "Ops > Alpha"), ("2025-Q4", None)]


def test_json_helpers(spark):
    df = spark.createDataFrame([('{"a": 4, "b": "x"}', "a"), ('{"b": "y"}', "b")], "j string, k string")
    got = df.select(
        c.json_value("j", "a").alias("a"), c.json_value("j", F.col("k"), "string").alias("k"), c.json_keys("j").alias("keys"), c.json_has_key("j", "a").alias("has")
    ).collect()
    assert [tuple(r) for r in got] == [(4.0, "4", ["a", "b"], True), (None, "y", ["b"], False)]


def test_value_bucket_keeps_order(spark):
    values = [-1e9, -3.5, -3.4, -1e-12, 0.0, 1e-12, 0.5, 1.0, 1.0001, 7.0, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", c.value_bucket("v").alias("b")).orderBy("v")
    buckets = [r.b for r in df.collect()]
    assert buckets == sorted(buckets)


def test_strict_and_lenient_casts(spark, rows):
    df = spark.createDataFrame([("1", "a"), ("X", "b"), (None, "c")], "s string, k string")
    good, bad = c.reject_uncastable(df, "s", "int")
    assert rows(good) == [(1, "a")]
    assert rows(bad) == [("X", "b")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        c.cast_columns(df, {"s": "int"}).collect()


def test_bound_parameters_are_values(spark, rows):
    df = spark.createDataFrame([("a",), ("b' OR '1'='1",)], "s string")
    assert rows(c.run_sql(spark, "SELECT s FROM {t} WHERE s = :x", {"x": "b' OR '1'='1"}, t=df)) == [("b' OR '1'='1",)]


def test_partitions_follow_the_input_size():
    assert session.shuffle_partitions(10**9) == 200
    assert session.shuffle_partitions(100 * 10**12) == 476838


def test_a_cluster_without_a_shared_folder_is_refused():
    sc = mock.Mock(master="spark://host:7077")
    sc.getConf.return_value.get.return_value = None
    sc.getCheckpointDir.return_value = None
    fake = mock.Mock(sparkContext=sc)
    fake.conf.get.return_value = None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(fake)


def test_a_hot_value_is_cut_into_several_files(spark, tmp_path):
    df = spark.range(2000).withColumn("team", F.when(F.col("id") < 1500, 7).otherwise(F.col("id") % 50))
    files.range_sorted(df, ["team"], 6).write.parquet(str(tmp_path / "t"))
    sizes = spark.read.parquet(str(tmp_path / "t")).groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    assert sizes < 800


def test_registered_functions(spark):
    c.register_functions(spark)
    got = spark.sql(
        "SELECT mask_score(3.5D, 'analyst_role') a, mask_score(3.5D, 'viewer_role') v, suppress_below(2.0D, 3L, 4) s, suppress_below(2.0D, 4L, 4) o, reverse_scale(2, true) r"
    ).first()
    assert tuple(got) == (3.5, None, None, 2.0, 4)


def test_csv_with_declared_schema(spark, rows, tmp_path):
    (tmp_path / "t.csv").write_text("team_id,team_name,department,division\nT1,Alpha,Eng,Tech\n")
    df = files.read_csv(spark, str(tmp_path / "t.csv"), schemas.TEAM_HIERARCHY)
    assert rows(df) == [("T1", "Alpha", "Eng", "Tech")]
    audited = files.with_audit(df).first()
    assert audited["_source_file"].endswith("t.csv") and audited["_loaded_at"] is not None
    (tmp_path / "bad.csv").write_text("team,name,department,division\nT1,Alpha,Eng,Tech\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "bad.csv"), schemas.TEAM_HIERARCHY).collect()


def test_parquet_sorted_partitioned_append_and_size(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    files.write_parquet(df, path, sort_by=["id"], partition_by=["g"])
    files.write_parquet(df.filter("g = 1"), path, partition_by=["g"], mode="append")
    back = spark.read.parquet(path)
    assert back.count() == 1000 + 333
    size = files.stored_bytes(spark, path).first()
    assert size.files >= 4 and size.bytes > 0


def test_published_versions_are_pinned_and_ordered(spark, rows, tmp_path):
    path = str(tmp_path / "serving")
    assert published.latest_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        published.read_version(spark, path)
    a = spark.createDataFrame([("t1", "Growth", 3.5), ("t2", "Growth", 4.0)], "team string, category string, m double")
    b = a.withColumn("m", F.col("m") + 1)
    assert published.publish_version(a, path, ["team"]) == 1
    assert published.publish_version(b, path, ["team"]) == 2
    assert rows(published.serve(spark, path, team="t1")) == [("t1", "Growth", 4.5)]
    assert rows(published.read_version(spark, path, 1), "team", "m") == [("t1", 3.5), ("t2", 4.0)]
    assert rows(published.manifest(spark, path), "version", "row_count", "keys") == [(1, 2, "team"), (2, 2, "team")]
    with pytest.raises(ValueError):
        published.publish_version(b, path, ["team"], version=2)


def test_unannounced_version_is_invisible_and_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "serving")
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    published.publish_version(df, path, ["k"])
    df.withColumn("v", F.lit(9.0)).write.parquet(f"{path}/data/v=2")  # a load that died before its manifest
    assert rows(published.read_version(spark, path)) == [(1, 1.0)]
    assert published.publish_version(df.withColumn("v", F.lit(2.0)), path, ["k"]) == 2
    assert rows(published.read_version(spark, path)) == [(1, 2.0)]


def test_generated_facts_cover_all_cells_and_repeat(spark):
    teams = spark.createDataFrame([(f"t{i}",) for i in range(7)], "team string")
    questions = spark.createDataFrame([(i,) for i in range(1, 13)], "q int")
    periods = spark.createDataFrame([("2025-Q1",), ("2025-Q2",)], "p string")
    make = lambda: generate_facts([teams, questions, periods], [["team"], ["q"], ["p"]], 3)
    facts = make()
    assert facts.count() == 7 * 12 * 2 * 3
    assert facts.select("response_id").distinct().count() == 504
    assert facts.groupBy("team", "q", "p").count().filter("count != 3").isEmpty()
    bounds = facts.agg(F.min("score"), F.max("score")).first()
    assert bounds[0] >= 1.0 and bounds[1] <= 5.0
    assert facts.exceptAll(make()).isEmpty()


def test_tasks_after_the_survey_joins_read_a_bounded_share(spark, tmp_path):
    for name in ("customer", "orders", "lineitem", "part", "nation", "region"):
        spark.createDataFrame([], schemas.TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    target = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own = spark.newSession()
    survey_view.survey(own, str(tmp_path))
    assert int(own.conf.get(target).rstrip("b")) <= 16 << 20
    own.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    own.conf.set("spark.sql.shuffle.partitions", "40")
    wide = own.range(600_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("a"))  # 50 MB shuffled
    assert wide.groupBy("a").agg(F.max("id").alias("m")).select(F.spark_partition_id().alias("p")).distinct().count() > 1
    chosen = spark.newSession()
    chosen.conf.set(target, "96m")
    survey_view.survey(chosen, str(tmp_path))
    assert chosen.conf.get(target) == "96m"


def test_partitions_before_merging_follow_the_stored_answers(spark, tmp_path):
    assert [session.initial_partitions(n << 20) for n in (0, 7, 700, 6400)] == [0, 2, 175, 400]
    assert session.initial_partitions(1 << 50) == session.shuffle_partitions(1 << 50)
    for name in ("customer", "orders", "part", "nation", "region"):
        spark.createDataFrame([], schemas.TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    answers = spark.range(500_000).select(*[F.rand(i).alias(c) for i, c in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax"))])
    answers.write.parquet(str(tmp_path / "lineitem.parquet"))  # 16 MB
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    few, chosen = spark.newSession(), spark.newSession()
    for own in (few, chosen):
        own.conf.set("spark.sql.shuffle.partitions", "2")
    chosen.conf.set(number, "3")
    for own in (few, chosen, few):
        survey_view.survey(own, str(tmp_path))
    raised = session.initial_partitions(session.stored_size(survey_view.table(few, str(tmp_path), "lineitem")))
    assert raised > 3 and few.conf.get(number) == str(raised) and chosen.conf.get(number) == "3"
    few.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1b")
    few.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
    dealt = few.range(10_000).groupBy("id").count().select(F.spark_partition_id().alias("p")).distinct().count()
    assert dealt == raised
    session.bounded_tasks(few, 6400 << 20)
    assert few.conf.get(number) == "400" and few.conf.get("spark.sql.files.maxPartitionBytes") == f"{32 << 20}b"
    few.conf.set("spark.sql.shuffle.partitions", "600")
    survey_view.survey(few, str(tmp_path))
    assert few.conf.get(number, None) is None
