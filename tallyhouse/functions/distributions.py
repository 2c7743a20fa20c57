"""Tail probabilities of chi-squared, t and F as column expressions, without Python.

The incomplete gamma and beta functions are summed as continued fractions (modified Lentz) or, where it
settles sooner, as a power series, inside one `aggregate` over step numbers. Steps after the last that
changes anything leave the state as it is. Null in, or a parameter outside of its range: null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 3000
_TINY = 1e-300
_CLOSE = 1e-15

# fixed values: Lanczos coefficients for g = 7
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function, for x > 0."""
    z = x - 1
    total = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], 1):
        total = total + F.lit(c) / (z + i)
    t = z + 7.5
    return 0.5 * F.log(2 * F.pi()) + (z + 0.5) * F.log(t) - t + F.log(total)


def _off_zero(v: Column) -> Column:
    return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)


def _not_negative(v: Column) -> Column:
    return F.when(v < 0, 0.0).otherwise(v)


def _iterated(start: dict[str, Column], step, steps: int) -> Column:
    """State after `steps` of `step(state, i)`; a state with `done` set is left alone."""
    names = list(start)
    pack = lambda cols: F.struct(*[cols[n].alias(n) for n in names])
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), pack(start), lambda s, i: F.when(s["done"], s).otherwise(pack(step(s, i.cast("double")))))


def upper_gamma(a: Column, x: Column, steps: int = STEPS) -> Column:
    """Regularised upper incomplete gamma function Q(a, x)."""
    a, x = a.cast("double"), x.cast("double")
    scale = F.exp(a * F.log(x) - x - log_gamma(a))

    def more(s, i):
        term = s["term"] * s["x"] / (s["a"] + i)
        total = s["total"] + term
        return {"a": s["a"], "x": s["x"], "term": term, "total": total, "done": term <= total * _CLOSE}

    series = _iterated({"a": a, "x": x, "term": 1 / a, "total": 1 / a, "done": F.lit(False)}, more, steps)["total"]

    def lentz(s, i):
        an, b = -i * (i - s["a"]), s["b"] + 2
        d = 1 / _off_zero(an * s["d"] + b)
        c = _off_zero(b + an / s["c"])
        return {"a": s["a"], "b": b, "c": c, "d": d, "h": s["h"] * d * c, "done": F.abs(d * c - 1) < _CLOSE}

    b0 = x + 1 - a
    first = 1 / _off_zero(b0)
    fraction = _iterated({"a": a, "b": b0, "c": F.lit(1 / _TINY), "d": first, "h": first, "done": F.lit(False)}, lentz, steps)["h"]
    return F.when((a <= 0) | (x < 0), F.lit(None).cast("double")).when(x == 0, 1.0).when(x < a + 1, 1 - scale * series).otherwise(scale * fraction)


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    def lentz(s, m):
        a, b, x = s["a"], s["b"], s["x"]
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / _off_zero(1 + even * s["d"])
        c = _off_zero(1 + even / s["c"])
        h = s["h"] * d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / _off_zero(1 + odd * d)
        c = _off_zero(1 + odd / c)
        return {"a": a, "b": b, "x": x, "c": c, "d": d, "h": h * d * c, "done": F.abs(d * c - 1) < _CLOSE}

    d = 1 / _off_zero(1 - (a + b) * x / (a + 1))
    return _iterated({"a": a, "b": b, "x": x, "c": F.lit(1.0), "d": d, "h": d, "done": F.lit(False)}, lentz, steps)["h"]


def incomplete_beta(a: Column, b: Column, x: Column, steps: int = STEPS) -> Column:
    """Regularised incomplete beta function I_x(a, b)."""
    a, b, x = (c.cast("double") for c in (a, b, x))
    scale = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    near = x < (a + 1) / (a + b + 2)
    # one fraction, on the side where it settles soon
    p, q, y = F.when(near, a).otherwise(b), F.when(near, b).otherwise(a), F.when(near, x).otherwise(1 - x)
    part = scale * _beta_fraction(p, q, y, steps) / p
    return (
        F.when((a <= 0) | (b <= 0) | (x < 0) | (x > 1), F.lit(None).cast("double"))
        .when(x == 0, 0.0).when(x == 1, 1.0).when(near, part).otherwise(1 - part)
    )


def chi_squared_tail(statistic: Column, dof: Column) -> Column:
    """Probability of a chi-squared value of at least `statistic`."""
    return upper_gamma(dof / 2, _not_negative(statistic) / 2)


def t_two_sided(statistic: Column, dof: Column) -> Column:
    """Probability of a t value at least as far from zero on either side."""
    return incomplete_beta(dof / 2, F.lit(0.5), F.try_divide(dof, dof + statistic * statistic))


def f_tail(statistic: Column, between: Column, within: Column) -> Column:
    """Probability of an F value of at least `statistic`."""
    return incomplete_beta(within / 2, between / 2, F.try_divide(within, within + between * _not_negative(statistic)))
