"""Column statistics: mean and sample standard deviation in one pass.

All requested columns are aggregated by a single ``df.agg`` -- a partial
(map-side) hash aggregate per partition and one tiny final aggregate -- so
fitting several stages costs one scan.  Only the one-row result reaches
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FeatureStats = dict[str, dict[str, float]]


class StatsError(ValueError):
    """A column cannot be standardised (zero, null or missing statistics)."""


def _alias(kind: str, col: str) -> str:
    return f"{kind}__{col}"


def stats_aggregates(cols: Sequence[str]):
    exprs = []
    for c in cols:
        exprs.append(F.avg(F.col(c).cast("double")).alias(_alias("mean", c)))
        exprs.append(F.stddev_samp(F.col(c).cast("double")).alias(_alias("std", c)))
    return exprs


def validate_stats(stats: FeatureStats) -> FeatureStats:
    """Refuse statistics that would make every scaled value null or infinite."""
    for c, s in stats.items():
        mean, std = s.get("mean"), s.get("std")
        if mean is None or std is None:
            raise StatsError(
                f"{c!r} has fewer than two values, so it has no std to scale by")
        if std == 0:
            raise StatsError(f"{c!r} is constant (std 0): leave it out of the scaled columns")
    return stats


def fit_column_stats(df: DataFrame, cols: Sequence[str], validate: bool = True) -> FeatureStats:
    """``{col: {"mean": m, "std": s}}`` for every column in one aggregate job."""
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise StatsError(f"Columns not found: {missing}")
    row = df.agg(*stats_aggregates(cols)).first()
    stats = {c: {"mean": row[_alias("mean", c)], "std": row[_alias("std", c)]} for c in cols}
    return validate_stats(stats) if validate else stats


def stats_frame(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Lazy ``(col, mean, std)`` DataFrame: the same single aggregate, unpivoted."""
    cols = list(dict.fromkeys(cols))
    agg = df.agg(*stats_aggregates(cols))
    rows = F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(_alias("mean", c)).alias("mean"),
                 F.col(_alias("std", c)).alias("std"))
        for c in cols
    ])
    out = agg.select(F.inline(rows))
    if digits is not None:
        out = out.select("col", F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"))
    return out
