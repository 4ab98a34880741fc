"""Exact discrete distributions as Spark SQL column expressions (no Python in the plan)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_SPREAD = 14.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a one-element transform)."""
    return F.transform(F.array(value), body)[0]


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8, stepped back; error below 1e-12."""
    def series(y: Column) -> Column:
        return ((y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727)
                + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0))))

    step = F.log(x)
    for i in range(1, 8):
        step = step + F.log(x + i)
    return series(x + 8) - step


def log_choose(n: Column, k: Column) -> Column:
    return log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``marked`` among ``drawn`` of ``total`` items, for a uniform ``u`` in [0, 1).

    Inversion of the distribution function, summed over a range of 14 standard
    deviations and more around the mean (everything outside weighs less than 1e-40).
    """
    n, k, m = (c.cast("double") for c in (total, marked, drawn))
    lo, hi = F.greatest(F.lit(0.0), m - (n - k)), F.least(k, m)
    mean = F.when(n > 0, m * k / n).otherwise(0.0)
    sd = F.sqrt(F.when(n > 1, mean * (1 - k / n) * (n - m) / (n - 1)).otherwise(0.0))
    start = F.greatest(lo, F.floor(mean - _SPREAD * sd - 20)).cast("long")
    stop = F.greatest(start, F.least(hi, F.ceil(mean + _SPREAD * sd + 20)).cast("long"))

    def weight(x: Column) -> Column:
        return log_choose(k, x.cast("double")) + log_choose(n - k, m - x.cast("double"))

    def pick(logs: Column) -> Column:
        top = F.array_max(logs)
        mass = F.transform(logs, lambda v: F.exp(v - top))
        whole = F.aggregate(mass, F.lit(0.0), lambda a, v: a + v)
        below = F.aggregate(
            mass, F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")),
            lambda a, v: F.struct((a["sum"] + v).alias("sum"),
                                  (a["n"] + F.when(a["sum"] + v <= u * whole, 1).otherwise(0)).cast("long").alias("n")))
        return F.least(start + below["n"], stop)

    return let(F.transform(F.sequence(start, stop), weight), pick)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p); terms beyond 14 standard deviations below the mean are left out."""
    mean, sd = n * p, F.sqrt(n * (p * (1 - p)))
    start = F.greatest(F.lit(0.0), F.floor(mean - _SPREAD * sd - 20)).cast("long")

    def term(x: Column) -> Column:
        y = x.cast("double")
        logs = y * F.log(F.lit(p)) + (n - y) * F.log(F.lit(1 - p))
        return F.exp(log_choose(n.cast("double"), y) + logs)

    total = F.aggregate(F.transform(F.sequence(start, F.greatest(start, k)), term), F.lit(0.0), lambda a, v: a + v)
    return F.when(k < start, F.lit(0.0)).otherwise(F.least(F.lit(1.0), total))
