"""Tail probabilities against tabulated quantiles, closed forms and numeric integration."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.distributions import chi_squared_tail, f_tail, incomplete_beta, log_gamma, t_two_sided, upper_gamma


def one(spark, expr):
    return spark.range(1).select(expr.alias("p")).first().p


@pytest.fixture
def tails(spark):
    def run(fn, rows):
        df = spark.createDataFrame([tuple(map(float, r)) for r in rows], ", ".join(f"c{i} double" for i in range(len(rows[0]))))
        return [r.p for r in df.select(fn(*[F.col(c) for c in df.columns]).alias("p")).collect()]

    return run


# fixed values: usual table entries (statistic, degrees of freedom, probability)
CHI = [(3.841458821, 1, 0.05), (5.991464547, 2, 0.05), (18.30703805, 10, 0.05), (23.20925116, 10, 0.01), (124.3421134, 100, 0.05), (2.70554345, 1, 0.1)]
T = [(12.70620474, 1, 0.05), (2.228138852, 10, 0.05), (3.169272673, 10, 0.01), (1.983971519, 100, 0.05), (1.959963985, 1e9, 0.05)]
FS = [(161.4476388, 1, 1, 0.05), (4.964602744, 1, 10, 0.05), (2.978237016, 10, 10, 0.05), (2.372097, 4, 49999, 0.05)]


def test_tabulated_values(tails):
    assert tails(chi_squared_tail, [r[:2] for r in CHI]) == pytest.approx([r[2] for r in CHI], abs=1e-6)
    assert tails(t_two_sided, [r[:2] for r in T]) == pytest.approx([r[2] for r in T], abs=1e-6)
    assert tails(f_tail, [r[:3] for r in FS]) == pytest.approx([r[3] for r in FS], abs=3e-6)


def test_closed_forms(tails):
    x = [0.01, 0.7, 3.0, 9.0, 60.0]
    q4 = [math.exp(-v) * sum(v**k / math.factorial(k) for k in range(4)) for v in x]
    assert tails(upper_gamma, [(4, v) for v in x]) == pytest.approx(q4, rel=1e-11)
    y = [0.001, 0.2, 0.5, 0.93, 0.99999]
    assert tails(incomplete_beta, [(3.5, 2, v) for v in y]) == pytest.approx([v**3.5 * (1 + 3.5 * (1 - v)) for v in y], rel=1e-11)
    assert tails(log_gamma, [(v,) for v in (0.5, 1, 7.25, 3e5)]) == pytest.approx([math.lgamma(v) for v in (0.5, 1, 7.25, 3e5)], rel=1e-13, abs=1e-14)


def test_large_degrees_of_freedom(tails):
    """The normal limit, and an integral of the density."""
    assert tails(t_two_sided, [(1.0, 4e6)])[0] == pytest.approx(math.erfc(1 / math.sqrt(2)), abs=1e-6)
    dof, at = 599998.0, 1.3
    grid = np.linspace(0, at, 20001)
    log_scale = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(dof * math.pi)
    density = np.exp(log_scale - (dof + 1) / 2 * np.log1p(grid**2 / dof))
    assert tails(t_two_sided, [(at, dof)])[0] == pytest.approx(1 - 2 * np.trapezoid(density, grid), abs=1e-8)
    assert tails(chi_squared_tail, [(5e5, 5e5)])[0] == pytest.approx(0.5, abs=1e-3)


def test_edges(spark, tails):
    assert tails(chi_squared_tail, [(0, 3), (1e6, 3), (1, 0)]) == [1.0, 0.0, None]
    assert tails(t_two_sided, [(0, 5)]) == [1.0] and tails(f_tail, [(0, 2, 5), (2, 0, 5)]) == [1.0, None]
    assert one(spark, chi_squared_tail(F.lit(None).cast("double"), F.lit(2))) is None
