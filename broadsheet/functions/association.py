"""Association and distribution measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-6


def xlogx(x: Column) -> Column:
    """x ln x, and 0 for x of 0 or less."""
    return F.when(x > 0, x * F.ln(x)).otherwise(F.lit(0.0))


def pmi(joint: Column, left: Column, right: Column, total: Column) -> Column:
    """ln(joint * total / (left * right)), null where a count is not positive."""
    a, r, t, n = (c.cast("double") for c in (joint, left, right, total))
    return F.when((a > 0) & (r > 0) & (t > 0) & (n > 0), F.ln(a * n / (r * t)))


def llr(joint: Column, left: Column, right: Column, total: Column) -> Column:
    """Dunning's log-likelihood ratio of a 2 x 2 table given its marginals, never below 0."""
    a, r, t, n = (c.cast("double") for c in (joint, left, right, total))
    cells = xlogx(a) + xlogx(r - a) + xlogx(t - a) + xlogx(n - r - t + a)
    return F.greatest(F.lit(0.0), 2 * (cells - xlogx(r) - xlogx(n - r) - xlogx(t) - xlogx(n - t) + xlogx(n)))


def psi_term(now: Column, base: Column) -> Column:
    """One class's share of the population stability index; shares are clipped at EPSILON."""
    a, b = F.greatest(now, F.lit(EPSILON)), F.greatest(base, F.lit(EPSILON))
    return (a - b) * F.ln(a / b)


def severity(psi: Column) -> Column:
    return F.when(psi < 0.10, "stable").when(psi < 0.25, "moderate").when(psi.isNotNull(), "significant")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0 or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage, 0 where whole is 0."""
    return F.coalesce(F.round(100 * ratio(part, whole), digits), F.lit(0.0))


def entropy_bits(weights: Column) -> Column:
    """Shannon entropy of an array of weights in bits."""
    total = F.aggregate(weights, F.lit(0.0), lambda s, x: s + x)
    shares = F.transform(weights, lambda x: F.try_divide(x.cast("double"), total))
    return -F.aggregate(shares, F.lit(0.0), lambda s, p: s + F.when(p > 0, p * F.log2(p)).otherwise(0.0))
