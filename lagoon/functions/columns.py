"""Scalar column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yes_no_flag(c: str | Column, yes: str = "Yes") -> Column:
    """String -> boolean: exactly ``yes`` is true; anything else, null included, is false."""
    return F.when(_col(c) == F.lit(yes), F.lit(True)).otherwise(F.lit(False))


def zscore(c: str | Column, mean: float, std: float) -> Column:
    """``(x - mean) / std`` as double; null stays null."""
    return (_col(c).cast("double") - F.lit(float(mean))) / F.lit(float(std))


def rounded_zscore(c: str | Column, mean: float, std: float, digits: int = 4) -> Column:
    """Z-score rounded half-up to ``digits`` decimals (sequence and lag features)."""
    return F.round(zscore(c, mean, std), digits)


def unscale(c: str | Column, mean: float, std: float) -> Column:
    """Inverse of :func:`zscore`: ``z * std + mean``."""
    return _col(c).cast("double") * F.lit(float(std)) + F.lit(float(mean))


def missing_indicator(c: str | Column) -> Column:
    """1 when the value is missing, else 0 (lag-mask polarity)."""
    return F.when(_col(c).isNull(), F.lit(1)).otherwise(F.lit(0))


def fill_zero(c: str | Column) -> Column:
    return F.coalesce(_col(c).cast("double"), F.lit(0.0))


def hash_percent(key: str | Column, seed: int = 42) -> Column:
    """Stable bucket in [0, 100) from an md5 of ``'<seed>|<key>'``.

    A pure per-row function of the key: the same key lands in the same
    bucket on any partitioning, any executor count and in DuckDB
    (``('0x' || substr(md5(...), 1, 8))::BIGINT % 100``).
    """
    return hash_mod(key, 100, seed)


def hash_mod(key: str | Column, n: int, seed: int = 42) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}|"), _col(key).cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(n)).cast("int")
