import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import aggregate as agg
from tallyhouse.operators import joins, ranking, rollup, warehouse


@pytest.fixture(scope="module")
def answers(spark):
    rng = random.Random(3)
    data = []
    for i in range(600):
        team = "hot" if rng.random() < 0.35 else f"t{rng.randrange(6)}"
        data.append((i, team, rng.randrange(1, 5), rng.choice(["NY", "LA", None]), rng.randrange(1, 6), rng.randrange(0, 40), round(rng.lognormvariate(1, 2), 3)))
    return spark.createDataFrame(data, "id int, team string, q int, loc string, score int, person int, amount double").cache()


def groups(df, *keys):
    out = {}
    for r in df.collect():
        out.setdefault(tuple(r[k] for k in keys), []).append(r)
    return out


def test_grain_rule_on_published_team_means(spark):
    """Three teams of 50, 10 and 30 answers: the mean of means is not the mean."""
    df = spark.createDataFrame([("A", 4.20, 50), ("B", 3.50, 10), ("C", 3.80, 30)], "team string, m double, n int")
    assert agg.weighted_mean(df, "m", "n").first()[0] == 3.99
    assert df.agg(agg.publish(F.avg("m"))).first()[0] == 3.83
    assert df.agg(F.sum("n")).first()[0] == 90


def test_grain_check_and_additivity(answers):
    r = agg.grain_check(answers, ["team"], "score").first()
    scores = [x.score for x in answers.collect()]
    means = [statistics.mean(x.score for x in v) for v in groups(answers, "team").values()]
    assert r.raw_mean == r.weighted_mean == pytest.approx(statistics.mean(scores), abs=0.006)
    assert r.avg_of_avgs == pytest.approx(statistics.mean(means), abs=0.006)
    a = agg.additivity_report(answers, ["team"], "score").first()
    assert a.total_responses == 600 and a.weighted_mean == r.raw_mean and a.raw_percentile == 5.0


def test_percentiles_match_numpy(answers):
    import numpy as np

    for keys in (["team"], ["loc"], []):
        got = {tuple(r[k] for k in keys): r for r in agg.percentiles(answers, keys, "amount", [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
        for key, members in groups(answers, *keys).items():
            values = [m.amount for m in members]
            for p in (0, 10, 50, 90, 100):
                assert got[key][f"p{p}"] == pytest.approx(np.percentile(values, p))


def test_order_statistics_are_the_values_at_quarter_places(answers):
    got = {r.team: r for r in agg.order_stat_quantiles(answers, ["team"], "amount").collect()}
    for (team,), members in groups(answers, "team").items():
        v = sorted(m.amount for m in members)
        n = len(v)
        assert (got[team].p25, got[team]["median"], got[team].p75) == (v[n // 4], v[n // 2], v[3 * n // 4])


def test_question_metrics_match_brute_force(answers):
    got = {(r.team, r.q): r for r in agg.question_metrics(answers, ["team", "q"], "score").collect()}
    for key, members in groups(answers, "team", "q").items():
        v = sorted(m.score for m in members)
        n, r = len(v), got[key]
        assert (r.p25, r["median"], r.p75) == (v[n // 4], v[n // 2], v[3 * n // 4])
        assert r.distribution == {str(s): v.count(s) for s in range(1, 6)}
        assert r.std_dev == pytest.approx(statistics.pstdev(v), abs=0.006)
        assert r.favorable_pct == pytest.approx(100 * sum(x >= 4 for x in v) / n, abs=0.06)
        assert (r.min_score, r.max_score, r.response_count) == (v[0], v[-1], n)


def test_slices_cover_each_dimension_with_null_values(answers):
    out = agg.dimension_slices(answers, ["team", "loc"], ["q"], "score")
    per_dim = {r.dimension: r.n for r in out.groupBy("dimension").agg(F.sum("response_count").alias("n")).collect()}
    assert per_dim == {"team": 600, "loc": 600}


def test_sparsity_and_distincts(answers):
    r = agg.sparsity(answers, ["loc"]).first()
    filled = sum(x["loc"] is not None for x in answers.collect())
    assert (r.row_count, r.filled_loc, r.pct_loc) == (600, filled, round(100 * filled / 600, 1))
    d = {x.team: x for x in agg.distinct_counts(answers, ["team"], ["person", "loc"]).collect()}
    for (team,), members in groups(answers, "team").items():
        assert d[team].distinct_person == len({m.person for m in members})
        assert d[team].distinct_loc == len({m["loc"] for m in members} - {None})


def test_cell_growth_multiplies_cardinalities(answers):
    got = {r.dimensions: (r.potential_cells, r.actual_cells) for r in agg.cell_growth(answers, ["team", "q", "score"]).collect()}
    rows = answers.collect()
    assert got[1] == (7, 7) and got[2][0] == 28 and got[3][0] == 140
    assert got[3][1] == len({(r.team, r.q, r.score) for r in rows})


def test_cardinality_profile_and_approximate(answers):
    exact = {r.column_name: r.distinct_values for r in agg.cardinality_profile(answers, ["team", "loc", "person"]).collect()}
    assert exact == {"team": 7, "loc": 2, "person": 40}
    approx = {r.column_name: r.distinct_values for r in agg.cardinality_profile(answers, ["team", "loc"], approximate=True).collect()}
    assert approx == {"team": 7, "loc": 2}


def test_response_rate_counts_silent_groups(spark, rows):
    roster = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "team string, p int")
    got = agg.response_rate(roster.filter("p = 1"), roster, ["team"], "p")
    assert rows(got, "team", "invited", "responded", "response_rate") == [("a", 2, 1, 0.5), ("b", 1, 0, 0.0)]


def test_hot_sets_ignore_order(spark, rows):
    log = spark.createDataFrame([(["team", "period"],), (["period", "team"],), (["category"],)], "dims array<string>")
    assert rows(agg.hot_dimension_sets(log)) == [("category", 1, 100.0), ("period,team", 2, 66.7)]


def test_dedup_keeps_latest_and_breaks_ties_by_the_whole_row(spark, rows):
    df = spark.createDataFrame([("r1", 1, "a"), ("r1", 2, "b"), ("r1", 2, "c"), ("r2", None, "d"), ("r2", 0, "e"), (None, 5, "n"), (None, 6, "m")], "id string, ts int, v string")
    assert rows(ranking.dedup_latest(df, ["id"], ["ts"])) == [("r1", 2, "c"), ("r2", 0, "e"), (None, 6, "m")]


def test_hot_key_dedup_combines_before_the_shuffle(spark):
    plan = ranking.dedup_latest(spark.range(10).selectExpr("id % 2 AS k", "id AS v"), ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_ranks_over_groups(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 5), ("d", 1)], "t string, s int")
    assert rows(ranking.rank_groups(df, ["t"], "s"), "t", "rnk") == [("a", 1), ("b", 3), ("c", 1), ("d", 4)]
    part = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("x", "c", 3), ("y", "a", 9)], "p string, t string, s int")
    assert rows(ranking.percent_rank_groups(part, ["p"], ["t"], "s", descending=False), "p", "t", "pct_rank") == [("x", "a", 0.0), ("x", "b", 0.5), ("x", "c", 1.0), ("y", "a", 0.0)]


def test_trend_starts_with_null(spark, rows):
    df = spark.createDataFrame([("a", 2024, 4), ("a", 2025, 3)], "t string, y int, s int")
    assert rows(ranking.period_trend(df, ["t"], ["y"], "s"), "y", "change") == [(2024, None), (2025, -1.0)]


def test_rollup_of_rollup_equals_base(answers):
    base = rollup.build_rollup(answers, ["team", "q", "loc"], "score")
    direct = rollup.build_rollup(answers, ["team"], "score")
    derived = rollup.derive_rollup(rollup.derive_rollup(base, ["team", "loc"]), ["team"])
    assert direct.exceptAll(derived).isEmpty() and derived.exceptAll(direct).isEmpty()
    half, rest = answers.filter("id < 200"), answers.filter("id >= 200")
    merged = rollup.merge_rollups(rollup.build_rollup(half, ["team"], "score"), rollup.build_rollup(rest, ["team"], "score"), ["team"])
    assert merged.exceptAll(direct).isEmpty()


def test_cube_matches_sql_cube(answers, spark):
    got = rollup.cube_rollup(answers, ["team", "loc"], "score").select("team", "loc", "grouping_id", "score_sum", "score_count")
    answers.createOrReplaceTempView("cube_answers")
    want = spark.sql("SELECT team, loc, grouping_id() g, sum(score), count(score) FROM cube_answers GROUP BY CUBE (team, loc)")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_rollup_choice_prefers_the_smallest_fitting(answers):
    stored = {"big": (["team", "q", "loc"], 500), "small": (["team", "loc"], 20)}
    assert rollup.pick_rollup(stored, ["team"]) == "small"
    assert rollup.pick_rollup(stored, ["q"]) == "big"
    assert rollup.pick_rollup(stored, ["person"]) is None
    wide = rollup.build_rollup(answers, ["team", "loc"], "score")
    from_stored = rollup.answer_from_rollups({"small": (wide, ["team", "loc"], 20)}, answers, ["team"], "score")
    from_facts = rollup.answer_from_rollups({}, answers, ["team"], "score")
    assert from_stored.drop("source").exceptAll(from_facts.drop("source")).isEmpty()
    assert {r.source for r in from_facts.collect()} == {"facts"}


def test_star_keys_and_snowflake_round_trip(spark, rows):
    flat = spark.createDataFrame([("b", "NY", 1), ("a", "LA", 2), ("a", "LA", 3), (None, "LA", 4)], "team string, city string, score int")
    star = warehouse.build_star(flat, {"team_key": ["team", "city"]}, ["score"])
    assert star.fact.count() == 4
    assert rows(star.dims["team_key"], "team", "city", "team_key") == [("a", "LA", 2), ("b", "NY", 3), (None, "LA", 1)]
    dim = spark.createDataFrame([(1, "A", "Eng", "Tech"), (2, "B", "Eng", "Tech"), (3, "C", "Ops", "Biz")], "team_id int, team string, dep string, div string")
    chain = warehouse.normalize_dim(dim, [("team_id", ["team"]), ("dep_key", ["dep"]), ("div_key", ["div"])])
    assert [t.count() for t, _ in chain] == [3, 2, 2]
    back = warehouse.flatten_dim(chain).select("team_id", "team", "dep", "div")
    assert back.exceptAll(dim).isEmpty() and dim.exceptAll(back).isEmpty()
    facts = spark.createDataFrame([(1, 4), (2, 2), (3, 5)], "team_id int, score int")
    up = joins.snowflake_query(facts, chain, "team_id", ["div"], [F.avg("score").alias("m")])
    assert rows(up) == [("Biz", 5.0), ("Tech", 3.0)]


def test_star_does_not_deal_the_fact_by_its_few_dimension_members(spark):
    flat = spark.createDataFrame([(f"t{i % 3}", i % 2, i) for i in range(60)], "team string, year int, score int")
    star = warehouse.build_star(flat, {"team_key": ["team"], "year_key": ["year"]}, ["score"])
    plan = star.fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert star.fact.count() == 60 and star.dims["team_key"].count() == 3
    chain = warehouse.normalize_dim(flat, [("score", ["team"]), ("year_key", ["year"])])
    assert "SortMergeJoin" not in chain[0][0]._jdf.queryExecution().executedPlan().toString()


def test_new_members_continue_after_the_largest_key(spark, rows):
    old = spark.createDataFrame([("b", 7), ("c", 3)], "name string, k bigint")
    got = warehouse.assign_keys(spark.createDataFrame([("b",), ("a",), ("z",)], "name string"), ["name"], "k", old)
    assert rows(got, "name", "k") == [("a", 8), ("b", 7), ("z", 9)]


def test_unknown_label_falls_back_to_the_key(spark, rows):
    df = spark.createDataFrame([("t1",), ("t9",)], "team_id string")
    labels = spark.createDataFrame([("t1", "Beta"), ("t1", "Alpha")], "team_id string, team_name string")
    assert rows(joins.label_lookup(df, labels, "team_id", "team_name")) == [("t1", "Alpha"), ("t9", "t9")]


def test_literal_relations_are_bounded(spark):
    with pytest.raises(ValueError):
        joins.literal_rows(spark, [(i,) for i in range(joins.LITERAL_LIMIT + 1)], "i int")


def test_cross_cells_is_the_full_product(spark):
    a = spark.createDataFrame([("x",), ("y",), ("z",)], "a string")
    b = spark.createDataFrame([(1,), (2,)], "b int")
    cells = joins.cross_cells([a, b], [["a"], ["b"]])
    assert sorted((r.a, r.b) for r in cells.collect()) == [(x, y) for x in "xyz" for y in (1, 2)]
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
