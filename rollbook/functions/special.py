"""Tail probabilities of the t and F distributions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

TINY = 1e-300


def _double(x) -> Column:
    return x.cast("double") if isinstance(x, Column) else F.lit(float(x))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series eight places further up."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5))) - 1 / (1680 * F.pow(y, F.lit(7)))
    steps = F.lit(0.0)
    for k in range(8):
        steps = steps + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - steps


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's rule; it needs some root of a or b steps."""
    steps = F.least(F.lit(20000), 60 + F.ceil(6 * F.sqrt(F.greatest(a, b)))).cast("int")
    keep = lambda v: F.when(F.abs(v) < TINY, TINY).otherwise(v)

    def step(s: Column, k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m))
        part = F.when(k % 2 == 0, even).otherwise(odd)
        d, c = 1 / keep(1 + part * s["d"]), keep(1 + part / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    first = 1 / keep(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.sequence(F.lit(2), 2 * steps), start, step, lambda s: s["h"])


def beta_share(a: Column, b: Column, x: Column, rest: Column) -> Column:
    """The regularised incomplete beta function of x in [0, 1]; ``rest`` is 1 - x, given apart so that it stays exact."""
    a, b = _double(a), _double(b)
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(rest))
    low, high = front * _fraction(a, b, x) / a, 1 - front * _fraction(b, a, rest) / b
    return F.when(x <= 0, 0.0).when(rest <= 0, 1.0).when(x < (a + 1) / (a + b + 2), low).otherwise(high)


def t_two_sided(t: Column, freedom: Column) -> Column:
    """Probability of a t at least as far from 0; null where t or the degrees of freedom are missing or not positive."""
    square, n = F.pow(_double(t), F.lit(2.0)), _double(freedom)
    p = beta_share(n / 2, F.lit(0.5), n / (n + square), square / (n + square))
    return F.when(F.isnan(square) | (n <= 0), None).when(F.abs(t) == float("inf"), 0.0).when(t.isNotNull() & n.isNotNull(), p)


def f_above(f: Column, first: Column, second: Column) -> Column:
    """Probability of an F of these degrees of freedom above ``f``."""
    f, a, b = _double(f), _double(first), _double(second)
    p = beta_share(b / 2, a / 2, b / (b + a * f), a * f / (b + a * f))
    return F.when(f.isNotNull() & (a > 0) & (b > 0), F.when(f <= 0, 1.0).otherwise(p))


def f_two_sided(f: Column, first: Column, second: Column) -> Column:
    """Twice the smaller tail: the usual test that two variances are equal."""
    above = f_above(f, first, second)
    return 2 * F.least(above, 1 - above)
