"""Layers, contracts, refresh and comparisons."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import compare, quality, refresh
from tallyhouse.operators.quality import CheckSpec, Contract, ContractViolation, run_suite
from tallyhouse.plans import medallion
from tallyhouse.sources import schemas

QUESTIONS = [("Q01", "expectations", "Basic Needs", "false"), ("Q06", "development", "Individual", "true"), ("Q07", "opinions", "Teamwork", "false"), ("Q11", "progress", "Growth", "false")]
TEAMS = [("T001", "Alpha", "Engineering", "Technology"), ("T002", "Beta", "Engineering", "Technology")]


def response(i, person, team, question, score, ts="2025-03-15 09:00:00"):
    return (f"R{i:03d}", person, team, "P01", question, score, ts)


@pytest.fixture
def raw(spark):
    data = [
        response(1, "E1", "T001", "Q01", "4", "2025-03-15 09:00:00"),
        response(1, "E1", "T001", "Q01", "5", "2025-03-16 09:00:00"),  # the later delivery wins
        response(2, "E1", "T001", "Q06", "2"),
        response(3, "E2", "T001", "Q06", "3"),
        response(4, "E2", "T001", "Q07", "9"),
        response(5, "E3", "T002", "Q11", "4"),
    ]
    return {
        "raw_survey_responses": spark.createDataFrame(data, schemas.BRONZE_RESPONSES),
        "raw_question_config": spark.createDataFrame(QUESTIONS, schemas.QUESTION_CONFIG),
        "raw_team_hierarchy": spark.createDataFrame(TEAMS, schemas.TEAM_HIERARCHY),
    }


def test_layers_build_in_order_and_pass_their_checks(spark, raw, rows, tmp_path):
    out = medallion.run_layers(spark, medallion.engagement_models(), raw, str(tmp_path))
    assert rows(out["survey_responses_cleaned"], "response_id", "raw_score", "score") == [("R001", 5, 5), ("R002", 2, 4), ("R003", 3, 3), ("R005", 4, 4)]
    assert rows(out["team_hierarchy_scd"], "team_id", "full_path") == [("T001", "Engineering > Alpha"), ("T002", "Engineering > Beta")]
    assert rows(out["suppression_flags"]) == [("T001", 2, True), ("T002", 1, True)]
    gold = rows(out["team_overview_metrics"], "team_id", "category", "mean_score", "response_count", "is_suppressed")
    assert gold == [("T001", "Basic Needs", 5.0, 1, True), ("T001", "Individual", 3.5, 2, True), ("T002", "Growth", 4.0, 1, True)]
    counts = medallion.layer_counts({"bronze": out["stg_survey_responses"], "silver": out["survey_responses_cleaned"], "gold": out["team_overview_metrics"]})
    assert rows(counts) == [("bronze", 6), ("gold", 3), ("silver", 4)]


def test_layers_stop_after_the_selected_one(spark, raw, tmp_path):
    out = medallion.run_layers(spark, medallion.engagement_models(), raw, str(tmp_path), select="silver")
    assert "survey_responses_cleaned" in out and "category_summary" not in out


def test_a_failed_check_stops_everything_downstream(spark, raw, tmp_path):
    broken = {**raw, "raw_question_config": raw["raw_question_config"].unionByName(
        spark.createDataFrame([("Q99", "odd", "Unknown", "false")], schemas.QUESTION_CONFIG))}
    with pytest.raises(ContractViolation, match="accepted_values_stg_question_config_category: 1 rows"):
        medallion.run_layers(spark, medallion.engagement_models(), broken, str(tmp_path))
    assert not (tmp_path / "silver").exists()


def test_a_cycle_of_models_is_refused():
    m = lambda name, reads: medallion.Model(name, "silver", reads, lambda *a: None)
    with pytest.raises(ValueError, match="a -> b -> a"):
        medallion.build_order([m("a", ["b"]), m("b", ["a"])])


def test_published_gold_hides_small_teams(spark, raw, tmp_path, rows):
    out = medallion.run_layers(spark, medallion.engagement_models(), raw, str(tmp_path), select="silver")
    gold = medallion.team_overview_metrics(out["survey_responses_cleaned"], out["team_hierarchy_scd"], medallion.suppression_flags(out["survey_responses_cleaned"], k=2))
    assert rows(gold.groupBy("team_id").agg(F.count("mean_score").alias("n"))) == [("T001", 2), ("T002", 0)]


def test_reject_reasons_account_for_every_row(spark, rows):
    df = spark.createDataFrame([("a", 1, "3"), ("a", 2, "X"), ("b", 1, "9"), ("c", 1, "4"), ("c", 2, "4"), ("c", 3, "5")], "id string, ts int, score string")
    assert rows(medallion.reject_reasons(df, "id", "score", ["ts", "score"])) == [("duplicate", 3), ("kept", 1), ("not_a_number", 1), ("out_of_range", 1)]


@pytest.mark.parametrize("kind, column, values, bad", [
    ("not_null", "id", (), (None, 3, "x", 1)),
    ("unique", "id", (), (1, 3, "x", 1)),
    ("accepted_values", "score", (1, 2, 3, 4, 5), (9, 7, "x", 1)),
    ("in_range", "score", (1, 5), (9, 0, "x", 1)),
    ("relationships", "team", ("teams", "team"), (9, 3, "x", 99)),
])
def test_each_check_passes_clean_data_and_catches_one_bad_row(spark, kind, column, values, bad):
    schema = "id int, score int, cat string, team int"
    clean = spark.createDataFrame([(1, 3, "x", 1), (2, 5, "x", 2)], schema)
    teams = spark.createDataFrame([(1,), (2,)], "team int")
    spec = [CheckSpec("t", kind, column, values)]
    assert run_suite({"t": clean, "teams": teams}, spec).first().status == "PASS"
    broken = clean.unionByName(spark.createDataFrame([bad], schema))
    result = run_suite({"t": broken, "teams": teams}, spec)
    assert (result.first().status, result.first().failing_rows) == ("FAIL", 1)
    with pytest.raises(ContractViolation):
        quality.gate(result)


def test_row_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    suite = run_suite({"t": df}, [CheckSpec("t", "not_null", "id"), CheckSpec("t", "not_null", "v"), CheckSpec("t", "accepted_values", "v", (0, 1, 2))])
    assert suite._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_contract_lists_its_checks():
    c = Contract("t", required=["a"], keys=["a"], domains={"b": ("x",)}, references={"c": ("u", "id")})
    assert [s.name for s in c.checks()] == ["not_null_t_a", "unique_t_a", "accepted_values_t_b", "relationships_t_c"]


def test_quarantine_names_every_reason(spark, rows):
    df = spark.createDataFrame([(1, 3, "a"), (2, 9, "a"), (3, 9, None), (4, None, "a")], "id int, score int, team string")
    ok, bad = quality.quarantine(df, {"score": ~F.col("score").between(1, 5), "team": F.col("team").isNull()})
    assert rows(ok, "id") == [(1,), (4,)]
    assert {r.id: list(r.reject_reasons) for r in bad.collect()} == {2: ["score"], 3: ["score", "team"]}


def test_update_and_delete_follow_sql_null_rules(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "id int, v int")
    assert rows(refresh.delete_where(df, F.col("v") > 3)) == [(2, None), (3, 1)]
    assert rows(refresh.update_where(df, F.col("v") > 3, {"v": F.lit(0)})) == [(1, 0), (2, None), (3, 1)]


def test_upsert_matches_null_keys(spark, rows):
    a = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    b = spark.createDataFrame([(None, "B"), (2, "c")], "k int, v string")
    assert rows(refresh.upsert(a, b, ["k"])) == [(1, "a"), (2, "c"), (None, "B")]


def test_strict_increment_loses_late_rows_and_lookback_keeps_them(spark, rows):
    t = lambda d: dt.datetime(2025, 4, d)
    target = spark.createDataFrame([(1, t(1)), (2, t(10))], "id int, ts timestamp_ntz")
    source = spark.createDataFrame([(1, t(1)), (2, t(10)), (3, t(9)), (4, t(11)), (5, t(10))], "id int, ts timestamp_ntz")
    assert rows(refresh.incremental_load(source, target, ["id"], "ts", None), "id") == [(1,), (2,), (4,)]
    assert rows(refresh.incremental_load(source, target, ["id"], "ts", "3 days"), "id") == [(1,), (2,), (3,), (4,), (5,)]
    assert refresh.incremental_load(source, target.limit(0), ["id"], "ts").count() == 5


def test_increment_bound_reaches_the_scan(spark, tmp_path):
    src = spark.range(100).selectExpr("id", "timestamp_ntz'2025-01-01' + make_dt_interval(cast(id as int)) AS ts")
    src.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    plan = refresh.newer_than_target(stored, stored.filter("id < 50"), "ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan.split("PushedFilters")[1]


def test_partition_upsert_rewrites_only_touched_partitions(spark, rows, tmp_path):
    path = tmp_path / "t"
    spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "id int, v string, part string").write.partitionBy("part").parquet(str(path))
    untouched = {f.name for f in (path / "part=q").iterdir()}
    refresh.upsert_partitions(spark, str(path), spark.createDataFrame([(1, "A", "p"), (3, "c", "p")], "id int, v string, part string"), ["id"], "part")
    assert rows(spark.read.parquet(str(path)), "id", "v", "part") == [(1, "A", "p"), (2, "b", "q"), (3, "c", "p")]
    assert {f.name for f in (path / "part=q").iterdir()} == untouched


def test_materialized_view_goes_stale_and_refreshes(spark, rows, tmp_path):
    base = spark.createDataFrame([("a", 4), ("a", 2), ("b", 5)], "team string, score int")
    new = spark.createDataFrame([("b", 1), ("c", 3)], "team string, score int")
    state = {"df": base}
    view = refresh.MaterializedView(spark, str(tmp_path / "mv"), lambda: state["df"], ["team"], "score")
    view.refresh()
    assert not view.is_stale()
    state["df"] = base.unionByName(new)
    assert view.is_stale()
    assert rows(view.staleness(), "team", "status") == [("a", "FRESH"), ("b", "STALE"), ("c", "STALE")]
    assert view.refresh_incremental(new) == 2
    assert not view.is_stale()
    assert view.read().exceptAll(view.live()).isEmpty() and view.live().exceptAll(view.read()).isEmpty()


def test_diff_lists_changed_added_and_removed(spark, rows):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", None)], "k string, m double")
    b = spark.createDataFrame([("x", 1.5), ("w", 2.0), ("z", None)], "k string, m double")
    assert rows(compare.metric_diff(a, b, ["k"], ["m"])) == [("w", None, 2.0, "added"), ("x", 1.0, 1.5, "changed"), ("y", 2.0, None, "removed")]
    assert rows(compare.metric_diff(a, b, ["k"], ["m"], changed_only=True), "k") == [("x",)]
    checks = compare.consistency_check(a, b, ["k"], ["m"])
    assert rows(checks, "k", "delta_m", "status") == [("w", None, "MISMATCH"), ("x", 0.5, "MISMATCH"), ("y", None, "MISMATCH"), ("z", None, "MATCH")]
