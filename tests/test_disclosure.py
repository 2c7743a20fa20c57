"""Totals attacked by linear algebra: a hidden cell is safe if the shown ones leave its value open."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import disclosure, privacy
from tallyhouse.session import pin


def determined(table):
    """Hidden (kind, r, c) of a table with totals whose values follow from the others: unit vectors in the row space."""
    hidden = [t for t in table if t[3]]
    at = {t[:3]: i for i, t in enumerate(hidden)}
    lines = []
    for side, totals in ((1, ("row_total", "col_total")), (2, ("col_total", "row_total"))):
        values = {t[side] for t in table if t[0] in ("cell", totals[0])}
        for value in values:
            line = np.zeros(len(hidden))
            for t in hidden:
                if t[side] == value and t[0] in ("cell", totals[0]):
                    line[at[t[:3]]] = -1 if t[0] == totals[0] else 1
            lines.append(line)
        last = np.zeros(len(hidden))  # the line of the totals themselves
        for t in hidden:
            if t[0] == totals[1] or t[0] == "grand_total":
                last[at[t[:3]]] = -1 if t[0] == "grand_total" else 1
        lines.append(last)
    matrix = np.array(lines)
    rank = np.linalg.matrix_rank(matrix) if matrix.size else 0
    return {key for key, i in at.items() if np.linalg.matrix_rank(np.vstack([matrix, np.eye(len(hidden))[i]])) == rank}


def attacked(rows):
    return determined([(x.kind, x.r, x.c, x.suppression_reason is not None) for x in rows])


SQUARE = {(1, 1): 2, (1, 2): 3, (2, 1): 3, (2, 2): 2, (3, 3): 1, (3, 4): 3, (4, 3): 2, (4, 4): 3, (1, 3): 2}


def test_bridge_between_two_cycles(spark):
    """Every line hides two cells, and still the totals give (1, 3) away."""
    data = [(i, j, SQUARE.get((i, j), 10 + i + j)) for i in range(1, 5) for j in range(1, 5)]
    cells = spark.createDataFrame(data, "r int, c int, n int").withColumn("m", F.col("n") * 1.0)
    leaks = disclosure.recoverable(disclosure.with_totals(cells, "r", "c", "n"), F.col("n") < 4)
    assert [(x.kind, x.r, x.c, x.n) for x in leaks.collect()] == [("cell", 1, 3, 2)]
    out = disclosure.suppress_with_totals(cells, "r", "c", "n", ["m"], k=4).collect()
    assert len(out) == 16 + 9 and attacked(out) == set()
    assert all((x.m is None) == (x.suppression_reason is not None) for x in out if x.kind == "cell")
    assert {(x.r, x.c) for x in out if x.suppression_reason == "small_group"} == set(SQUARE)
    assert sum(x.suppression_reason == "complementary" for x in out) == 1  # one cell between the two squares
    inner = privacy.suppress_complementary(cells, "r", "c", "n", ["m"], k=4)
    assert inner.columns == ["r", "c", "n", "m", "suppression_reason"] and inner.count() == 16


@pytest.mark.parametrize("seed", range(2))
def test_random_tables(spark, seed):
    rng = random.Random(seed)
    rows, columns, fill = [(6, 4, 0.6), (1, 1, 1)][seed]
    data = [(f"r{i}" if i else None, f"c{j}", rng.choice([1, 2, 5, 8, 12, 20])) for i in range(rows) for j in range(columns) if rng.random() < fill] or [("r1", "c1", 1)]
    cells = pin(spark.createDataFrame(data, "r string, c string, n long").withColumn("m", F.col("n") * 1.0))
    before = disclosure.with_totals(cells, "r", "c", "n").withColumn("suppression_reason", F.when(F.col("n") < 4, "x"))
    got = {(x.kind, x.r, x.c) for x in disclosure.recoverable(before, F.col("suppression_reason").isNotNull()).collect()}
    assert got == attacked(before.collect())
    out = disclosure.suppress_with_totals(cells, "r", "c", "n", ["m"], k=4).collect()
    assert attacked(out) == set()
    assert all(x.suppression_reason for x in out if x.n < 4) and all(x.m is None for x in out if x.suppression_reason)


def test_long_path_and_empty_table(spark):
    path = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(16)] + [("n008", "n012")], "u string, v string")
    known = {x.node: x for x in disclosure.blocks(path).collect()}
    assert sum(x.bridge for x in known.values()) == 12
    assert len({known[f"n{i:03}"].block for i in range(8, 13)}) == 1 and known["n007"].block != known["n008"].block
    none = spark.createDataFrame([], "r string, c string, n long, m double")
    assert disclosure.suppress_with_totals(none, "r", "c", "n", ["m"]).collect() == []
