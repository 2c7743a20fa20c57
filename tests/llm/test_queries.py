"""Queries with SQL agree with it; all are listed at the entry point."""

import pathlib

import pytest

from tallyhouse import llm
from tests.test_queries import checker  # noqa: F401

SQL = llm.all_sql()


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_sql(spark, checker, name, size):  # noqa: F811
    duckdb = pytest.importorskip("duckdb")
    sf = f"/root/testdata/{size}"
    if not pathlib.Path(sf).exists():
        pytest.skip("given tables not present")
    con = duckdb.connect()
    for table in checker.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    verdict = checker.compare(con, llm.all_queries()[name](spark, sf), SQL[name])
    assert verdict.startswith("ok") and verdict != "ok 0 rows", verdict
