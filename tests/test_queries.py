"""Every named query on the smallest given tables: equal to its SQL where it has one, and not empty."""

import importlib.util
import pathlib

import pytest

from tallyhouse.plans import all_queries, all_sql

SF = "/root/testdata/sf0.001"
EMPTY_BY_DESIGN = {"rls_stranger", "scd2_overlaps", "user_teams", "attribute_probe"}
QUERIES, SQL = all_queries(), all_sql()

pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="given tables not present")


@pytest.fixture(scope="module")
def checker():
    path = pathlib.Path(__file__).parent.parent / "scripts" / "check_oracle.py"
    spec = importlib.util.spec_from_file_location("check_oracle", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def con(checker):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in checker.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, checker, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        verdict = checker.compare(con, df, SQL[name])
        assert verdict.startswith("ok"), verdict
        assert name in EMPTY_BY_DESIGN or verdict != "ok 0 rows"
    else:
        assert not df.isEmpty()


def test_the_entry_point_lists_the_same_queries(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
