"""Upserts that stop half way leave the table as it was."""

import json
import types

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import snapshots

KIND = "id int, v string, part string"


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.create_snapshot(spark.createDataFrame([(1, "a", "p"), (2, "b", "q x/1"), (3, "c", "p"), (4, "d", None)], KIND), path, "part")
    return path


def test_upsert_writes_only_what_it_touches(spark, rows, table):
    first = {f for f in snapshots.read_snapshot(spark, table).inputFiles()}
    assert snapshots.upsert_snapshot(spark, table, spark.createDataFrame([(1, "A", "q x/1"), (5, "e", "new")], KIND), ["id"], "part") == 2
    assert rows(snapshots.read_snapshot(spark, table)) == [(1, "A", "q x/1"), (2, "b", "q x/1"), (3, "c", "p"), (4, "d", None), (5, "e", "new")]
    assert len(first & set(snapshots.read_snapshot(spark, table).inputFiles())) == 1  # the partition of null
    assert rows(snapshots.read_snapshot(spark, table, 1), "id", "part") == [(1, "p"), (2, "q x/1"), (3, "p"), (4, None)]
    assert snapshots.upsert_snapshot(spark, table, spark.createDataFrame([(3, "C", None), (4, "D", "p")], KIND), ["id"], "part") == 3
    assert rows(snapshots.read_snapshot(spark, table), "id", "v", "part")[2:] == [(3, "C", None), (4, "D", "p"), (5, "e", "new")]


def test_a_stopped_commit_changes_nothing(spark, rows, table, monkeypatch):
    before = rows(snapshots.read_snapshot(spark, table))
    moved = spark.createDataFrame([(1, "A", "q x/1")], KIND)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "json", types.SimpleNamespace(dumps=stop, loads=json.loads))  # rows and list are written, the line is not
        with pytest.raises(RuntimeError):
            snapshots.upsert_snapshot(spark, table, moved, ["id"], "part")
    bad = moved.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        snapshots.upsert_snapshot(spark, table, bad, ["id"], "part")
    assert rows(snapshots.read_snapshot(spark, table)) == before and snapshots.snapshot_versions(spark, table) == [1]
    assert snapshots.upsert_snapshot(spark, table, moved, ["id"], "part") == 2
    assert rows(snapshots.read_snapshot(spark, table), "id", "v", "part")[0] == (1, "A", "q x/1")


def test_of_two_commits_on_one_snapshot_one_fails(spark, rows, table, monkeypatch):
    real, other = snapshots._listing, spark.createDataFrame([(9, "z", "z")], KIND)
    seen = real(spark, table, None)
    snapshots.upsert_snapshot(spark, table, other, ["id"], "part")
    after = rows(snapshots.read_snapshot(spark, table))
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_listing", lambda *_: seen)
        with pytest.raises(snapshots.CommitConflict):
            snapshots.upsert_snapshot(spark, table, spark.createDataFrame([(8, "y", "z")], KIND), ["id"], "part")
    assert rows(snapshots.read_snapshot(spark, table)) == after
    with pytest.raises(snapshots.CommitConflict):
        snapshots.create_snapshot(other, table, "part")
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, table, 7)
