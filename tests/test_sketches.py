"""Quantiles and distinct counts from merged sketches, within their stated errors."""

import numpy as np
import pytest

from tallyhouse.operators import rollup


def test_derived_from_cells_within_the_stated_error(spark):
    rng = np.random.default_rng(4)
    rows = [(f"t{i % 7}", i % 2, float(v), int(p)) for i, (v, p) in enumerate(zip(rng.gamma(2, 50, 30000), rng.integers(0, 9000, 30000), strict=True))]
    cells = rollup.build_sketches(spark.createDataFrame(rows, "team string, year int, value double, person long").repartition(6), ["team", "year"], "value", "person")
    assert cells.count() == 14
    for keep in (["year"], []):
        got = rollup.sketched(rollup.derive_sketches(cells, keep), keep, {"p10": 0.1, "p90": 0.9}).collect()
        for r in got:
            own = [x for x in rows if not keep or x[1] == r.year]
            values, people = np.array([x[2] for x in own]), len({x[3] for x in own})
            assert r.score_count == len(own) and r.people == pytest.approx(people, rel=0.025)
            for q, v in ((0.1, r.p10), (0.9, r.p90)):
                assert (values <= v).mean() == pytest.approx(q, abs=0.006)


def test_empty_cells(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", 2.0, None)], "team string, value double, person long")
    got = {r.team: (r.median, r.people, r.score_count) for r in rollup.sketched(rollup.build_sketches(df, ["team"], "value", "person"), ["team"], {"median": 0.5}).collect()}
    assert got == {"a": (None, 1, 0), "b": (2.0, 0, 1)}
