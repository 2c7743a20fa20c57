import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import history, reshape

D = dt.date
OPEN = D(9999, 12, 31)
DIM = "team_key int, code string, department string, valid_from date, valid_to date, is_current boolean"


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [(1, "ALPHA", "Engineering", D(2025, 1, 1), D(2025, 6, 30), False), (2, "ALPHA", "Product", D(2025, 7, 1), OPEN, True), (3, "BETA", "Engineering", D(2025, 1, 1), OPEN, True)], DIM
    )


def test_type1_overwrites_and_adds(spark, rows):
    dim = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, v string, other int")
    changes = spark.createDataFrame([("a", None), ("c", "z")], "k string, v string")
    assert rows(history.scd1_apply(dim, changes, "k")) == [("a", None, 1), ("b", "y", 2), ("c", "z", None)]


def test_type2_closes_and_opens(spark, dim, rows):
    changes = spark.createDataFrame([("BETA", "Sales", D(2025, 10, 1)), ("ALPHA", "Product", D(2025, 10, 1)), ("GAMMA", "Ops", D(2025, 10, 1))], "code string, department string, on_date date")
    out = history.scd2_apply(dim, changes, "code", ["department"], "on_date", "team_key")
    got = rows(out, "team_key", "code", "department", "valid_from", "valid_to", "is_current")
    assert (3, "BETA", "Engineering", D(2025, 1, 1), D(2025, 9, 30), False) in got
    assert (4, "BETA", "Sales", D(2025, 10, 1), OPEN, True) in got
    assert (5, "GAMMA", "Ops", D(2025, 10, 1), OPEN, True) in got
    assert len(got) == 5 and (2, "ALPHA", "Product", D(2025, 7, 1), OPEN, True) in got
    assert history.version_overlaps(out, "code").isEmpty()


def test_type3_keeps_the_previous_value(spark, rows):
    dim = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    once = history.scd3_apply(dim, spark.createDataFrame([("a", "z"), ("b", "y")], "k string, v string"), "k", "v")
    assert rows(once) == [("a", "z", "x"), ("b", "y", None)]
    twice = history.scd3_apply(once, spark.createDataFrame([("a", "w")], "k string, v string"), "k", "v")
    assert rows(twice) == [("a", "w", "z"), ("b", "y", None)]


def test_versions_from_a_skewed_log_match_brute_force(spark):
    rng = random.Random(11)
    log = [(i, "hot" if rng.random() < 0.4 else rng.choice("abc"), D(2024, 1, 1) + dt.timedelta(days=rng.randrange(0, 700)), rng.choice(["x", "y", "z", None])) for i in range(800)]
    df = spark.createDataFrame(log, "seq int, k string, d date, v string")
    got = sorted((r.k, r.version_no, r.v, r.valid_from, r.valid_to, r.is_current) for r in history.scd2_from_log(df, "k", "v", "d", ["seq"]).collect())
    want = []
    for k in {r[1] for r in log}:
        last = {}
        for seq, kk, d, v in sorted(log):
            if kk == k:
                last[d] = v
        starts, prev = [], object()
        for d in sorted(last):
            if last[d] != prev:
                starts.append((d, last[d]))
            prev = last[d]
        for i, (d, v) in enumerate(starts):
            end = starts[i + 1][0] - dt.timedelta(days=1) if i + 1 < len(starts) else OPEN
            want.append((k, i + 1, v, d, end, i + 1 == len(starts)))
    assert got == sorted(want, key=lambda t: (t[0], t[1]))


def test_point_in_time_join_finds_the_version_of_the_day(spark, dim, rows):
    facts = spark.createDataFrame([(1, "ALPHA", D(2025, 6, 30)), (2, "ALPHA", D(2025, 7, 1)), (3, "BETA", D(2031, 1, 1)), (4, "ALPHA", D(2024, 12, 31)), (5, "NONE", D(2025, 7, 1))], "id int, code string, day date")
    assert rows(history.scd2_asof_join(facts, dim, "code", "day"), "id", "department") == [(1, "Engineering"), (2, "Product"), (3, "Engineering")]


def test_overlapping_versions_are_found(spark, dim):
    bad = dim.unionByName(spark.createDataFrame([(9, "ALPHA", "X", D(2025, 6, 1), D(2025, 6, 10), False)], DIM))
    assert history.version_overlaps(bad, "code").count() == 1


def test_history_labels_versions(spark, dim, rows):
    facts = spark.createDataFrame([(1, 4)] * 3 + [(2, 5)] * 2, "team_key int, score int")
    out = history.scd2_history(history.scd2_key_join(facts, dim, "team_key"), ["code", "department"], "score")
    assert rows(out, "department", "valid_range", "version_status", "mean_score", "response_count") == [
        ("Engineering", "2025-01-01 to 2025-06-30", "HISTORICAL", 4.0, 3), ("Product", "2025-07-01 to 9999-12-31", "CURRENT", 5.0, 2)]


@pytest.fixture
def eav(spark):
    data = []
    for rid, project, team, answers in [
        (1, "Phoenix", "Alpha", {"Q01": 4.0, "Q02": 3.0, "CRW01": 5.0}), (2, "Phoenix", "Beta", {"Q01": 2.0, "Q02": 4.0}),
        (3, "Atlas", "Alpha", {"Q01": 5.0, "Q02": 1.0, "CLD01": 2.0, "CLD02": 3.0}),
    ]:
        data += [(rid, project, team, a, v) for a, v in answers.items()]
    return spark.createDataFrame(data, "response_id int, project string, team string, attribute string, value double").cache()


IDS = ["response_id", "project", "team"]


def same(a, b, columns):
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_every_encoding_returns_to_eav(eav):
    columns = [*IDS, "attribute", "value"]
    wide = reshape.eav_to_wide(eav, IDS)
    assert same(reshape.wide_to_eav(wide, IDS, ["Q01", "Q02", "CRW01", "CLD01", "CLD02"]), eav, columns)
    assert same(reshape.json_to_eav(reshape.eav_to_json(eav, IDS), IDS, "responses"), eav, columns)
    slots, mapping = reshape.eav_to_slots(eav, IDS, "project", ["Q01", "Q02"], 4)
    assert same(reshape.slots_to_eav(slots, mapping, IDS, "project", 4), eav, columns)


def test_slots_mean_different_things_per_project(eav, rows):
    mapping = reshape.slot_mapping(eav, "project", ["Q01", "Q02"])
    assert rows(reshape.slot_meaning(mapping, "project", [3])) == [("Atlas", 3, "CLD01"), ("Phoenix", 3, "CRW01")]
    with pytest.raises(ValueError, match="in 1 projects"):
        reshape.eav_to_slots(eav, IDS, "project", ["Q01", "Q02"], 3)


def test_questions_can_be_added(spark, eav, rows):
    extra = spark.createDataFrame([(1, "Phoenix", "Alpha", "NEW01", 4.0)], eav.schema)
    assert rows(reshape.questions_per_project(reshape.add_attribute(eav, extra), "project")) == [("Atlas", 4), ("Phoenix", 4)]
    assert rows(reshape.add_column(reshape.eav_to_wide(eav, ["response_id"], ["Q01"]), "NEW01"), "NEW01") == [(None,)] * 3
    packed = reshape.eav_to_json(eav, ["response_id"])
    added = reshape.add_json_key(packed, "responses", "NEW01", F.when(F.col("response_id") == 2, 1.5))
    assert [r.response_id for r in reshape.json_has_key(added, "responses", "NEW01").collect()] == [2]
    assert same(reshape.json_to_eav(added, ["response_id"], "responses").filter("attribute != 'NEW01'"), eav, ["response_id", "attribute", "value"])


def test_the_four_encodings_answer_alike(eav, rows):
    out = reshape.encoding_equivalence(eav, ["response_id", "project"], "project", "team", ["Q01", "Q02"])
    assert rows(out) == [("Alpha", 4.5, 2.0, "MATCH", "MATCH", "MATCH"), ("Beta", 2.0, 4.0, "MATCH", "MATCH", "MATCH")]


def test_typed_flatten_carries_question_metadata(eav):
    packed = reshape.eav_to_json(eav, ["response_id"])
    out = reshape.typed_flatten(packed, ["response_id"], "responses", {"Q01": {"type": "double", "text": "Expectations", "category": "Basic Needs"}})
    assert out.schema["Q01"].metadata["category"] == "Basic Needs" and out.schema["Q01"].dataType.simpleString() == "double"


def test_category_means_use_only_known_questions(eav, rows):
    assert rows(reshape.eav_category_means(eav, {"Q01": "Basic", "Q02": "Basic"})) == [("Basic", 3.17, 6)]
