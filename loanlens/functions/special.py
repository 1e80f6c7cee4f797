"""Tail of Student's t distribution as a column expression.

The two-sided tail is the regularised incomplete beta function ``I_x(df / 2, 1 / 2)`` at ``x = df / (df + t^2)``,
evaluated by its continued fraction (a fixed number of terms, from whichever side of the symmetry relation converges);
the quotient of gamma functions before it comes from its asymptotic series after a shift of the argument, so that the
result stays right (to 1e-8) up to a billion degrees of freedom.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.functions.linalg import let

SHIFT = 16  # the series is used from this argument on
TERMS = 120  # of the continued fraction
_TINY = 1e-300


def log_half_step(a: Column) -> Column:
    """``ln gamma(a + 1/2) - ln gamma(a)`` for ``a > 0``, without the difference of two large numbers."""
    shifted = a + SHIFT
    fall = F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(0.0), lambda s, i: s + F.log1p(-0.5 / (a + i + 0.5)))
    r = 1.0 / (shifted * shifted)
    series = (F.lit(-1 / 8) + r * (F.lit(1 / 192) + r * (F.lit(-1 / 640) + r * F.lit(17 / 14336)))) / shifted
    return 0.5 * F.log(shifted) + series + fall


def _continued_fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of ``I_x(a, b)`` by the modified Lentz method."""
    guard = lambda v: let(v, lambda v: F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v))
    start = let(1.0 / guard(1.0 - (a + b) * x / (a + 1.0)), lambda d: F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h")))

    def advance(s: Column, numerator: Column) -> Column:
        def both(num: Column) -> Column:
            pair = F.struct(guard(1.0 + num / s["c"]).alias("c"), (1.0 / guard(1.0 + num * s["d"])).alias("d"))
            return let(pair, lambda o: F.struct(o["c"].alias("c"), o["d"].alias("d"), (s["h"] * o["c"] * o["d"]).alias("h")))

        return let(numerator, both)

    def step(s: Column, k: Column) -> Column:
        def terms(m: Column) -> Column:
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            return let(advance(s, even), lambda s: advance(s, odd))

        return let(k.cast("double"), terms)

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda s: s["h"])


def student_t_two_sided(t: Column, df: Column) -> Column:
    """``P(|T| >= |t|)`` for Student's t with ``df`` degrees of freedom; null where either is null or ``df`` is not positive."""
    def tail(t: Column, df: Column) -> Column:
        a, b = df / 2, F.lit(0.5)
        x, rest = df / (df + t * t), t * t / (df + t * t)  # rest is 1 - x without its rounding
        front = F.exp(log_half_step(a) - F.lit(0.5 * math.log(math.pi)) - a * F.log1p(t * t / df) + b * F.log(rest))
        fraction = lambda x, a, b: let(x, lambda x: let(a, lambda a: let(b, lambda b: _continued_fraction(x, a, b) / a)))
        p = F.when(x < (a + 1) / (a + b + 2), front * fraction(x, a, b)).otherwise(1.0 - front * fraction(rest, b, a))
        p = F.when(t == 0, F.lit(1.0)).when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
        return F.when((df > 0) & t.isNotNull() & ~F.isnan(t), p)

    return let(t.cast("double"), lambda t: let(df.cast("double"), lambda df: tail(t, df)))
