"""p-values as column expressions: one for each group of a finished aggregate, inside the plan."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos' approximation of the gamma function for g = 7.
_LANCZOS_G = 7.0
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def kolmogorov_p_value(distance: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Two-sample Kolmogorov-Smirnov p-value, asymptotic form.

    ``2 * sum((-1)^(k-1) * exp(-2 k^2 t^2))`` with ``t = d * sqrt(n1 n2 / (n1 + n2))``,
    as built-in functions only.  For small ``t`` the alternating series has not
    converged after the given terms, and the value is 1 to double precision.
    """
    size = F.try_divide(n1.cast("double") * n2.cast("double"), n1.cast("double") + n2.cast("double"))
    t = distance * F.sqrt(size)

    def add(total: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        return total + sign * F.exp(-2.0 * k * k * t * t)

    series = 2.0 * F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), add)
    return F.when(t < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for positive arguments."""
    z = x - 1.0
    total = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], 1):
        total = total + F.lit(c) / (z + float(i))
    t = z + _LANCZOS_G + 0.5
    return 0.5 * math.log(2 * math.pi) + (z + 0.5) * F.log(t) - t + F.log(total)


def _away_from_zero(x: Column) -> Column:
    return F.when(F.abs(x) < 1e-300, 1e-300).otherwise(x)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, by Lentz' method.

    It takes terms in the order of the square root of the larger parameter; the sequence is that long.
    """
    terms = 2 * (100 + 4 * F.ceil(F.sqrt(F.greatest(a, b))))

    def step(state: Column, k: Column) -> Column:
        m = F.floor((k + 1) / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        # Terms come as even, odd, even, odd of the same m.
        term = F.when(k % 2 == 1, even).otherwise(odd)
        d = 1.0 / _away_from_zero(1.0 + term * state["d"])
        c = _away_from_zero(1.0 + term / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["value"] * c * d).alias("value"))

    first = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("value"))
    return F.aggregate(F.sequence(F.lit(1).cast("bigint"), terms), start, step, lambda state: state["value"])


def regularised_beta(a: Column, b: Column, x: Column) -> Column:
    """The incomplete beta function over the complete one, for positive parameters and x from 0 to 1."""
    swap = x >= (a + 1.0) / (a + b + 2.0)
    one, other, at = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b), F.when(swap, 1.0 - x).otherwise(x)
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log1p(-x))
    part = front * _beta_fraction(one, other, at) / one
    return F.when(x <= 0.0, 0.0).when(x >= 1.0, 1.0).otherwise(F.when(swap, 1.0 - part).otherwise(part))


def pearson_p_value(r: Column, n: Column) -> Column:
    """P(|R| >= |r|) for uncorrelated samples of size n, via the t distribution; NULL without r or for fewer than three."""
    degrees = n.cast("double") - 2.0
    value = regularised_beta(degrees / 2.0, F.lit(0.5), 1.0 - r * r)
    return F.when((n < 3) | r.isNull() | F.isnan(r), F.lit(None).cast("double")).when(F.abs(r) >= 1.0, 0.0).otherwise(value)
