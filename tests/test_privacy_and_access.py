import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import access, privacy
from tallyhouse.plans import all_queries
from tallyhouse.sources import schemas

ROLES = ["analyst_role"]


@pytest.fixture(scope="module")
def staff(spark):
    """Team A ten people in two cities, B three, C six of whom two sit in Austin."""
    data, n = [], 0
    for team, city, scores in [("A", "New York", [4] * 7), ("A", "Austin", [3, 4, 5]), ("B", "Chicago", [1, 2, 3]), ("C", "New York", [3, 4, 4, 5]), ("C", "Austin", [2, 3])]:
        for s in scores:
            n += 1
            data.append((n, team, city, s))
    return spark.createDataFrame(data, "person int, team string, city string, q01 int").cache()


def test_each_cut_is_judged_by_its_own_count(staff, rows):
    out = privacy.suppressed_cuts(staff, [["team"], ["team", "city"], []], "q01", 4)
    by_team = rows(out.filter("cut = 'team'"), "team", "n", "mean_score", "is_suppressed")
    assert by_team == [("A", 10, 4.0, False), ("B", 3, None, True), ("C", 6, 3.5, False)]
    fine = rows(out.filter("cut = 'team x city'"), "team", "city", "n", "mean_score")
    assert fine == [("A", "Austin", 3, None), ("A", "New York", 7, 4.0), ("B", "Chicago", 3, None), ("C", "Austin", 2, None), ("C", "New York", 4, 4.0)]
    assert rows(out.filter("cut = 'all'"), "n") == [(19,)]


def test_people_are_counted_once(spark, rows):
    df = spark.createDataFrame([(1, "A", 5)] * 9 + [(2, "A", 1)], "person int, team string, q01 int")
    by_rows = privacy.suppressed_cuts(df, [["team"]], "q01", 4)
    by_people = privacy.suppressed_cuts(df, [["team"]], "q01", 4, "person")
    assert rows(by_rows, "n", "is_suppressed") == [(10, False)]
    assert rows(by_people, "n", "is_suppressed", "mean_score") == [(2, True, None)]


def test_a_null_value_is_a_group_of_its_own(spark, rows):
    df = spark.createDataFrame([(None, 1)] * 5 + [("A", 2)], "team string, s int")
    out = privacy.suppressed_cuts(df, [["team"], []], "s", 4)
    assert rows(out, "cut", "team", "n") == [("all", None, 6), ("team", "A", 1), ("team", None, 5)]


def test_k_anonymity_release_and_probe(staff, rows):
    qi = ["team", "city"]
    assert rows(privacy.k_anonymity_groups(staff, qi, 4), "team", "city", "risk")[0] == ("A", "Austin", "VULNERABLE")
    released = privacy.k_anonymize(staff, qi, ["q01"], 4)
    assert released.count() == 19
    visible = released.filter("q01 IS NOT NULL")
    assert visible.groupBy(*qi).count().filter("count < 4").isEmpty() and visible.count() == 11
    assert rows(privacy.probe(released, {"team": "C", "city": "Austin"}, ["q01"])) == [("C", "Austin", None)] * 2
    risk = privacy.reidentification_risk(staff, qi, 4).first()
    assert (risk.qi_groups, risk.total_rows, risk.unique_rows, risk.rows_below_k) == (5, 19, 0, 8)


def test_null_quasi_identifiers_form_a_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(5)] + [("x", 9)], "city string, v int")
    released = privacy.k_anonymize(df, ["city"], ["v"], 4)
    assert released.filter("v IS NOT NULL").count() == 5 and released.count() == 6


def test_generalisation_climbs_until_the_group_is_large_enough(staff, rows):
    out = privacy.generalize(staff, [["team", "city"], ["team"], []], "q01", 4)
    assert rows(out, "team", "city", "published_level", "n") == [
        ("A", "Austin", "team", 10), ("A", "New York", "team x city", 7), ("B", "Chicago", "all", 19), ("C", "Austin", "team", 6), ("C", "New York", "team x city", 4)]
    nothing = privacy.generalize(staff, [["team"]], "q01", 100)
    assert rows(nothing, "team", "published_level", "mean_score") == [("A", None, None), ("B", None, None), ("C", None, None)]


@pytest.mark.parametrize("name", ["suppressed_cuts", "generalize", "build_star"])
def test_cells_per_person_are_made_in_bounded_tasks(spark, tmp_path, name):
    for table in ("customer", "orders", "lineitem", "part", "nation", "region"):
        spark.createDataFrame([], schemas.TABLES[table]).write.parquet(str(tmp_path / f"{table}.parquet"))
    own = spark.newSession()
    assert all_queries()[name](own, str(tmp_path)).isEmpty()
    assert int(own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").rstrip("b")) <= 16 << 20


def adjacent(spark, groups, mode, k=4):
    df = spark.createDataFrame(groups, "dep string, team string, n int").withColumn("m", F.lit(1.0))
    out = privacy.suppress_adjacent(df, ["dep"], ["team"], "n", ["m"], mode, k)
    return {(r.dep, r.team): r.suppression_reason for r in out.collect() if r.suppression_reason}


def test_basic_mode_hides_the_next_smallest_beside_a_single(spark):
    groups = [("d", "a", 1), ("d", "b", 6), ("d", "c", 6), ("d", "e", 9), ("x", "p", 2), ("x", "q", 3)]
    assert adjacent(spark, groups, "basic") == {("d", "a"): "small_group", ("d", "b"): "adjacent"}


def test_strong_mode_hides_all_small_and_one_more_only_when_one_is_hidden(spark):
    groups = [("d", "a", 2), ("d", "b", 6), ("d", "c", 8), ("x", "p", 2), ("x", "q", 3), ("x", "r", 9), ("y", "s", 3)]
    assert adjacent(spark, groups, "strong") == {("d", "a"): "small_group", ("d", "b"): "adjacent", ("x", "p"): "small_group", ("x", "q"): "small_group", ("y", "s"): "small_group"}
    with pytest.raises(ValueError):
        adjacent(spark, groups, "other")


@pytest.mark.parametrize("seed", range(2))
def test_complementary_hiding_leaves_no_line_with_one_hidden_cell(spark, seed):
    rng = random.Random(seed)
    data = [(f"r{i}", f"c{j}", rng.choice([1, 2, 5, 8, 12, 20])) for i in range(5) for j in range(4) if rng.random() < 0.85]
    cells = spark.createDataFrame(data, "r string, c string, n int").withColumn("m", F.col("n") * 1.0)
    out = privacy.suppress_complementary(cells, "r", "c", "n", ["m"], k=4).collect()
    assert len(out) == len(data)
    assert all(x.m is None for x in out if x.n < 4)
    for line in ("r", "c"):
        for value in {x[line] for x in out}:
            members = [x for x in out if x[line] == value]
            hidden = sum(x.m is None for x in members)
            assert hidden != 1 or len(members) == 1


def test_thresholds_by_role(spark, rows):
    agg = spark.createDataFrame([("a", 3, 2.0)], "t string, n int, m double")
    assert rows(privacy.suppress_by_role(agg, "n", ["m"], {"admin": 1, "manager": 5}), "role", "m", "is_suppressed") == [("admin", 2.0, False), ("manager", None, True)]


def test_three_enforcement_points_agree(spark, staff, tmp_path):
    app = privacy.suppress_app(staff, ["team"], "q01", 4)
    view = privacy.suppress_view(staff, ["team"], "q01", "staff_safe", 4)
    table = privacy.suppress_table(staff, ["team"], "q01", str(tmp_path / "safe"), 4)
    want = {tuple(r) for r in app.select("team", "mean_score", "n", "is_suppressed").collect()}
    for other in (view, table):
        assert {tuple(r) for r in other.select("team", "mean_score", "n", "is_suppressed").collect()} == want


@pytest.fixture
def policies(spark):
    return spark.createDataFrame([("manager_a", "A", False), ("manager_a", "B", False), ("manager_c", "C", False), ("admin", None, True)], "principal string, owner string, is_admin boolean")


@pytest.mark.parametrize("who, teams", [("manager_a", {"A", "B"}), ("manager_c", {"C"}), ("admin", {"A", "B", "C"}), ("stranger", set())])
def test_row_security(staff, policies, who, teams):
    assert {r.team for r in access.secure_rows(staff, "team", policies, who).collect()} == teams


def test_repeated_policies_do_not_repeat_rows(staff, policies):
    assert access.secure_rows(staff, "team", policies.unionByName(policies), "manager_a").count() == 13


def test_masking_keeps_rows_and_types(staff):
    masked = access.mask_columns(staff, ["q01"], "viewer_role", ROLES)
    assert masked.schema == staff.schema or masked.schema["q01"].dataType == staff.schema["q01"].dataType
    assert masked.filter("q01 IS NOT NULL").isEmpty() and masked.count() == 19
    assert access.mask_columns(staff, ["q01"], "analyst_role", ROLES) is staff


def test_governed_view_composes_all_three(staff, policies, rows):
    view = lambda who, role: rows(access.governed_view(staff, "team", policies, who, role, ["team"], "q01", 4), "team", "mean_score", "n")
    assert view("manager_a", "analyst_role") == [("A", 4.0, 10), ("B", None, 3)]
    assert view("manager_a", "viewer_role") == [("A", None, 10), ("B", None, 3)]


def test_attribute_rules(staff, rows):
    user = {"city": ["Austin"], "clearance": {"public"}}
    out = access.abac_filter(staff, user, [access.ColumnRule("q01", "sensitive"), access.ColumnRule("team", "public")], [access.RowRule("city", "city")])
    assert out.count() == 5 and out.filter("q01 IS NOT NULL").isEmpty() and out.filter("team IS NULL").isEmpty()
    assert access.abac_filter(staff, {}, [], [access.RowRule("city", "city")]).isEmpty()
