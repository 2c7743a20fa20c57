"""Views that know which inputs moved, and that follow deleted and corrected rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import refresh, rollup
from tallyhouse.sources import published

FACTS = "id long, team string, score int"


def test_inputs_tell_staleness_without_the_facts(spark, rows, tmp_path):
    feed, other = str(tmp_path / "feed"), str(tmp_path / "other")
    spark.createDataFrame([(1, "a", 4), (2, "b", 5)], FACTS).write.parquet(feed)
    spark.range(3).write.parquet(other)
    runs = []
    view = refresh.MaterializedView(spark, str(tmp_path / "v"), lambda: runs.append(1) or spark.read.parquet(feed), ["team"], "score", {"feed": (feed, "id"), "other": other})
    view.refresh()
    assert not view.is_stale() and runs == [1]
    plan = view.input_staleness()._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "content" not in plan and feed not in plan.replace(f"[file:{feed}]", "").split("ReadSchema")[-1]
    spark.createDataFrame([(3, "a", 1)], FACTS).write.mode("append").parquet(feed)
    assert view.is_stale() and runs == [1]  # the view's query did not run
    assert rows(view.input_staleness(), "source", "row_count", "newest", "status") == [("feed", 2, "2", "STALE"), ("other", 3, None, "FRESH")]
    view.refresh()
    assert rows(view.input_staleness(), "source", "row_count", "status") == [("feed", 3, "FRESH"), ("other", 3, "FRESH")]
    assert rows(view.input_staleness(version=9), "status") == [("UNKNOWN",), ("UNKNOWN",)]
    with pytest.raises(ValueError):
        refresh.MaterializedView(spark, str(tmp_path / "w"), view.source, ["team"], "score").input_staleness()


@pytest.mark.parametrize("seed", range(3))
def test_changes_equal_a_full_build(spark, rows, seed):
    rng = random.Random(seed)
    before = {i: (rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, 4, 5, None])) for i in range(40)} | {100: ("only", 3), 101: ("nulls", None), 102: ("nulls", 2)}
    after = {i: v for i, v in before.items() if rng.random() > 0.2 and i != 100 and i != 102}
    after = {i: (rng.choice(["a", "d", t]), s if rng.random() > 0.3 else 5) if i < 40 and rng.random() < 0.3 else (t, s) for i, (t, s) in after.items()} | {200: ("e", 1), 201: (None, 0)}
    frame = lambda d: spark.createDataFrame([(i, *v) for i, v in d.items()], FACTS)
    gone = {i: v for i, v in before.items() if after.get(i) != v}
    came = {i: v for i, v in after.items() if before.get(i) != v}
    stored = rollup.build_rollup(frame(before), ["team"], "score")
    out = rollup.apply_changes(stored, frame(came), frame(gone), frame(after), ["team"], "score")
    assert rows(out, "team", *rollup.PARTS) == rows(rollup.build_rollup(frame(after), ["team"], "score"), "team", *rollup.PARTS)


def test_only_cells_that_lost_an_extreme_read_the_facts(spark, rows):
    before = spark.createDataFrame([(1, "a", 1), (2, "a", 3), (3, "a", 5), (4, "b", 2), (5, "b", 4)], FACTS)
    stored = rollup.build_rollup(before, ["team"], "score")
    wrong = before.filter("id <> 2 AND id <> 4").withColumn("score", F.when(F.col("team") == "a", 99).otherwise(F.col("score")))
    out = rollup.apply_changes(stored, before.limit(0), before.filter("id IN (2, 4)"), wrong, ["team"], "score")
    assert rows(out, "team", *rollup.PARTS) == [("a", 6, 2, 1, 5), ("b", 4, 1, 4, 4)]


def test_served_rows_come_in_key_order(spark, tmp_path):
    df = spark.createDataFrame([(9, "b", 1), (1, "a", 2), (5, "a", 1)], "m int, k string, j int")
    published.publish_version(df, str(tmp_path / "p"), ["k", "j"])
    assert [r.m for r in published.serve(spark, str(tmp_path / "p")).collect()] == [5, 1, 9]
    assert [r.m for r in published.serve(spark, str(tmp_path / "p"), k="a").collect()] == [5, 1]
