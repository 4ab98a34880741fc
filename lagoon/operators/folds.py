"""Cross-validation statistics from one pass: mergeable moments per fold.

One aggregate gives count, mean and sum of squared deviations of every column in
every fold.  The statistics that fold f's model may see are those of all other folds:
the total without the fold.  They are formed by merging the other folds' moments
(``k`` rows on the driver), which is the same number as total minus fold without its
cancellation, and equals refitting on the training rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.operators.stats import FeatureStats

#: Count, mean and sum of squared deviations from the mean.
Moments = tuple[int, float, float]


def moments_frame(df: DataFrame, cols: Sequence[str], fold_col: str = "fold") -> DataFrame:
    """``fold, {n,mean,m2}__{col}``: one partial and final hash aggregate for all folds and columns."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n__{c}"), F.avg(x).alias(f"mean__{c}"), (F.var_pop(x) * F.count(x)).alias(f"m2__{c}")]
    return df.groupBy(fold_col).agg(*aggs)


def fold_moments(df: DataFrame, cols: Sequence[str], fold_col: str = "fold") -> dict[int, dict[str, Moments]]:
    """The moments of every fold, a row per fold on the driver."""
    return {r[fold_col]: {c: (r[f"n__{c}"], r[f"mean__{c}"] or 0.0, r[f"m2__{c}"] or 0.0) for c in cols}
            for r in moments_frame(df, cols, fold_col).collect()}


def merged(a: Moments, b: Moments) -> Moments:
    n = a[0] + b[0]
    if not n:
        return 0, 0.0, 0.0
    gap = b[1] - a[1]
    return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n


def stats_without(moments: dict[int, dict[str, Moments]], fold: int | None) -> FeatureStats:
    """``{col: {mean, std}}`` of all rows outside ``fold`` (None: of all rows); std is None below two values."""
    out: FeatureStats = {}
    for f, cols in sorted(moments.items(), key=lambda x: str(x[0])):
        for c, m in cols.items():
            out.setdefault(c, (0, 0.0, 0.0))
            if fold is None or f != fold:
                out[c] = merged(out[c], m)
    return {c: {"mean": m if n else None, "std": (m2 / (n - 1)) ** 0.5 if n > 1 else None} for c, (n, m, m2) in out.items()}
