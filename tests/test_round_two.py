"""Cases that once gave wrong answers or stopped a job."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.columns import json_has_key, json_value, publish
from tallyhouse.operators import aggregate, history, overview, ranking, refresh, reshape, rollup, stats
from tallyhouse.operators.joins import cross_cells

D = dt.date
OPEN = D(9999, 12, 31)


def test_increment_compares_instants_whatever_the_zone(spark, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Tokyo", "America/Lima"):
            spark.conf.set("spark.sql.session.timeZone", name)
            at = lambda *hours: spark.createDataFrame([(i, 1_700_000_000 + 3600 * h) for i, h in enumerate(hours)], "id int, s long").select("id", F.timestamp_seconds("s").alias("ts"))
            assert rows(refresh.newer_than_target(at(0, 1, 30), at(0), "ts"), "id") == [(1,), (2,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_increment_keeps_the_latest_of_repeats(spark, rows):
    t = lambda d: dt.datetime(2025, 4, d)
    source = spark.createDataFrame([(1, t(1), "old"), (1, t(2), "new"), (1, t(2), "new")], "id int, ts timestamp_ntz, v string")
    assert rows(refresh.incremental_load(source, source.limit(0), ["id"], "ts"), "id", "v") == [(1, "new")]


def test_partition_upsert_follows_moved_keys(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "p"), (2, "b", "q x/1"), (3, "c", "p")], "id int, v string, part string").write.partitionBy("part").parquet(path)
    refresh.upsert_partitions(spark, path, spark.createDataFrame([(1, "A", "q x/1"), (2, "B", None)], "id int, v string, part string"), ["id"], "part")
    assert rows(spark.read.parquet(path), "id", "v", "part") == [(1, "A", "q x/1"), (2, "B", None), (3, "c", "p")]
    refresh.upsert_partitions(spark, path, spark.createDataFrame([(1, "A", "p")], "id int, v string, part string"), ["id"], "part")
    assert rows(spark.read.parquet(path), "id", "part") == [(1, "p"), (2, None), (3, "p")]


def test_several_changes_of_a_key_in_one_batch(spark, rows):
    dim = spark.createDataFrame([(1, "a", "x", D(2025, 1, 1), OPEN, True)], "sk int, k string, v string, valid_from date, valid_to date, is_current boolean")
    changes = [("a", "y", D(2025, 5, 1)), ("a", "y", D(2025, 6, 1)), ("a", "z", D(2025, 7, 1)), ("b", "n", D(2025, 2, 1)), ("b", "m", D(2025, 3, 1)), ("a", "x", D(2024, 1, 1))]
    log = spark.createDataFrame(changes, "k string, v string, d date")
    out = history.scd2_apply(dim, log.filter("d > '2024-06-01'"), "k", ["v"], "d", "sk")
    assert rows(out, "k", "v", "valid_from", "valid_to", "is_current") == [
        ("a", "x", D(2025, 1, 1), D(2025, 4, 30), False), ("a", "y", D(2025, 5, 1), D(2025, 6, 30), False), ("a", "z", D(2025, 7, 1), OPEN, True),
        ("b", "m", D(2025, 3, 1), OPEN, True), ("b", "n", D(2025, 2, 1), D(2025, 2, 28), False),
    ]
    assert history.version_overlaps(out, "k").isEmpty() and out.select("sk").distinct().count() == 5
    early = spark.createDataFrame([("a", "q", D(2024, 1, 1))], "k string, v string, d date")
    with pytest.raises(Exception, match="dated before"):
        history.scd2_apply(dim, early, "k", ["v"], "d", "sk").collect()
    flat = spark.createDataFrame([("a", "x")], "k string, v string")
    assert rows(history.scd1_apply(flat, log, "k", "d")) == [("a", "z"), ("b", "m")]
    assert rows(history.scd3_apply(flat, log, "k", "v", "d")) == [("a", "z", "x")]


def test_text_answers_and_odd_keys(spark, rows):
    docs = spark.createDataFrame([(1, '{"a": 1.5, "b": "fine", "c.d": 2, "it\'s": 3, "n": null}'), (2, None)], "id int, j string")
    assert rows(reshape.json_to_eav(docs, ["id"], "j", text="t")) == [(1, "a", 1.5, "1.5"), (1, "b", None, "fine"), (1, "c.d", 2.0, "2"), (1, "it's", 3.0, "3"), (1, "n", None, None)]
    more = reshape.add_json_key(reshape.add_json_key(docs, "j", "e", F.lit("x")), "j", "a", F.lit(9))
    first = more.filter("id = 1").select(*[json_value("j", k, "string") for k in ("a", "b", "c.d", "it's", "e")], json_value("j", F.lit("c.d")), json_value("j", F.lit("it's")), json_has_key("j", "b")).first()
    assert tuple(first) == ("9", "fine", "2", "3", "x", 2.0, 3.0, True)
    assert json_value("j", "b") is not None and docs.select(json_value("j", "b")).first()[0] is None


def test_ranks_use_exact_means(spark, rows):
    df = spark.createDataFrame([("p", "a", 3.00001), ("p", "b", 3.00002), ("p", "c", 3.00002)], "p string, t string, s double")
    assert rows(ranking.rank_groups(df, ["t"], "s"), "t", "rnk") == [("a", 3), ("b", 1), ("c", 1)]
    assert rows(ranking.percent_rank_groups(df, ["p"], ["t"], "s"), "t", "pct_rank") == [("a", 1.0), ("b", 0.0), ("c", 0.0)]


def test_empty_and_constant_groups_do_not_stop_the_job(spark, rows):
    df = spark.createDataFrame([("a", None, 0, 1.0), ("b", 4, 0, 1.0), ("b", 5, 0, 2.0)], "g string, x int, w int, y double")
    assert rows(aggregate.favorability(df, ["g"], "x")) == [("a", 0, None, None), ("b", 2, 100.0, 0.0)]
    assert aggregate.question_metrics(df, ["g"], "x").count() == 2
    assert aggregate.weighted_mean(df, "y", "w").first()[0] is None
    flat = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("b", 1, 2), ("b", 2, 4)], "g string, x int, y int")
    assert rows(stats.pearson(flat, "x", "y", ["g"])) == [("a", None, 2), ("b", 1.0, 2)]
    assert stats.driver_analysis(flat, "y", ["x"], ["g"]).count() == 2
    assert stats.t_statistic(flat, "g", "x").first().t is not None and stats.t_statistic(flat.withColumn("x", F.lit(1)), "g", "x").first().t is None
    assert stats.anova_f(flat.filter("g = 'a'"), "g", "x").first().f is None
    three = flat.unionByName(spark.createDataFrame([("c", 1, 1)], flat.schema))
    with pytest.raises(Exception, match="two labels"):
        stats.t_statistic(three, "g", "x").collect()
    assert stats.t_statistic(three, "g", "x", ["a", "b"]).first().group_b == "b"
    assert rollup.reduction(df, df.limit(0)).first().reduction_factor is None
    assert spark.range(1).select(publish(F.lit(2e12))).first()[0] == 2e12


def test_records_without_questions(spark):
    scores = spark.createDataFrame([(1, 1, "p", "c", 4.0, 0, 9, 0.5, 3.0)], "team_id int, project_id int, time_period string, category string, mean_score double, question_count int, response_count int, response_rate double, benchmark double")
    names = lambda what: spark.createDataFrame([(1, "n")], f"{what}_id int, {what}_name string")
    assert overview.team_overview(scores, names("team"), names("project")).first().overall_score == 0.0


def test_scores_are_given_for_rows_that_lack_a_feature(spark):
    df = spark.createDataFrame([(i, float(i), i > 5) for i in range(12)] + [(99, None, False)], "id int, x double, gone boolean")
    scored = {r.id: r.risk for r in stats.attrition_scores(stats.attrition_model(df, ["x"], "gone"), df, ["id"], ["x"]).collect()}
    assert len(scored) == 13 and scored[99] is None and scored[11] > scored[0]


def test_products_are_dealt_by_their_size(spark):
    dim = lambda n, c: spark.range(n).withColumnRenamed("id", c)
    assert cross_cells([dim(3, "a"), dim(4, "b")], [["a"], ["b"]]).select("a", "b").distinct().count() == 12


def test_one_outlier_does_not_gather_the_values_in_one_task(spark):
    values = spark.range(20_000).select((100 + F.col("id") / 200_000).alias("v")).unionByName(spark.createDataFrame([(1e12,)], "v double"))
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ranked = aggregate._ranked_values(values, [], "v")
        sizes = [r[0] for r in ranked.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_001 and max(sizes) < 20_001 * 0.5
    assert aggregate.percentiles(values, [], "v", [0.5]).first()[0] == pytest.approx(100.05)


def test_slices_skip_missing_answers(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 3), ("a", "y", None)], "q string, d string, s int")
    assert rows(aggregate.dimension_slices(df, ["d"], ["q"], "s", (1, 2, 3)), "value", "mean_score", "response_count", "n_1", "n_2") == [("x", 2.0, 2, 1, 0), ("y", None, 0, 0, 0)]


def test_joint_drivers_per_segment(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = rng.normal(size=200), rng.normal(size=200)
    rows = [("s", float(x), float(z), float(2 * x - z)) for x, z in zip(a, b, strict=True)] + [("flat", 1.0, 2.0, 3.0)] * 3 + [("s", None, 1.0, 1.0)]
    got = {(r.g, r.driver): r for r in stats.segment_regression(spark.createDataFrame(rows, "g string, a double, b double, y double"), "y", ["a", "b"], ["g"]).collect()}
    assert (got["s", "a"].coefficient, got["s", "b"].coefficient, got["s", "a"].r_squared, got["s", "a"].n) == (2.0, -1.0, 1.0, 200)
    assert (got["s", "a"].driver_rank, got["s", "b"].driver_rank) == (1, 2) and got["flat", "a"].coefficient is None


def test_the_total_of_a_line_with_one_cell_is_hidden_too(spark):
    from tallyhouse.operators.disclosure import suppress_with_totals

    cells = spark.createDataFrame([("r1", "c1", 1), ("r2", "c1", 9), ("r2", "c2", 8), ("r3", "c2", 7)], "r string, c string, n int").withColumn("m", F.col("n") * 1.0)
    out = suppress_with_totals(cells, "r", "c", "n", ["m"], k=4)
    hidden = {(x.kind, x.r, x.c) for x in out.filter("suppression_reason IS NOT NULL").collect()}
    assert {("cell", "r1", "c1"), ("row_total", "r1", None)} <= hidden


def test_one_layer_alone_reads_what_was_stored(spark, tmp_path):
    from tallyhouse.plans.medallion import Model, run_layers

    built = []

    def model(name, layer, inputs, stored=True):
        return Model(name=name, layer=layer, inputs=inputs, build=lambda df: built.append(name) or df.withColumn(name, F.lit(1)), stored=stored)

    models = [model("b", "bronze", ("src",)), model("s", "silver", ("b",), stored=False), model("g", "gold", ("s",))]
    source = {"src": spark.range(3).toDF("id")}
    run_layers(spark, models, source, str(tmp_path))
    built.clear()
    out = run_layers(spark, models, {"src": spark.range(99).toDF("id")}, str(tmp_path), only="gold")
    assert out["g"].count() == 3 and built == ["s", "g"]
    with pytest.raises(ValueError):
        run_layers(spark, models, source, str(tmp_path), only="copper")


def test_two_publishers_never_share_a_version(spark, tmp_path):
    from tallyhouse.sources import published

    path, df = str(tmp_path / "p"), spark.range(5)
    assert published.publish_version(df, path, ["id"]) == 1
    assert published._claim(spark, f"{path}/claims/v=2")  # another load that has not announced yet
    with pytest.raises(ValueError, match="taken"):
        published.publish_version(df, path, ["id"], version=2)
    assert published.publish_version(df.limit(2), path, ["id"]) == 3
    assert published.read_version(spark, path).count() == 2
