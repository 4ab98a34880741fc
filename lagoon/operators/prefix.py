"""Running sums over a global order without a single-task window.

``sum(x) OVER (ORDER BY k)`` with no partition key puts every row in one
task.  ``ordered_prefix`` produces the same numbers with bounded tasks and
one evaluation of its input:

1. The input is stored once and cut into contiguous ranges of (groups, order
   column) by ``range_parts``; the number of ranges follows the row count.
2. Every (group, range) is totalled: a partial hash aggregate with at most one
   row per group and range.
3. A running sum of those totals per group gives each range its offset.  It is
   materialized (reliable checkpoint) and counted before it is broadcast.
4. A running sum inside each (group, range), plus the offset of its range.

Exact whenever ``order_col`` is unique inside a group (the callers
aggregate ties first or order by a key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagoon.operators.ranges import PART, PART_ROWS, range_parts
from lagoon.session import materialize

BROADCAST_LIMIT = 1_000_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null; the result has the left side's keys."""
    named = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(named, same, how).drop(*[f"__r_{k}" for k in keys])


def ordered_prefix(df: DataFrame, order_col: str, sums: dict[str, Column],
                   group_cols: Sequence[str] = (), n_ranges: int | None = None,
                   inclusive: bool = True, part_rows: int = PART_ROWS) -> DataFrame:
    """Append ``name = running sum of expr`` for each entry of ``sums``.

    Rows are ordered by ``order_col`` inside each group.  ``inclusive``
    counts the current row; otherwise only rows strictly before it are
    counted.  ``n_ranges`` overrides the number of ranges that ``part_rows`` asks for.
    """
    groups = list(group_cols)
    values = {f"__v_{n}": (F.col(e) if isinstance(e, str) else e).cast("double") for n, e in sums.items()}
    ranged = range_parts(df.select("*", *[e.alias(k) for k, e in values.items()]), [*groups, order_col],
                         part_rows, n_ranges)

    totals = ranged.groupBy(*groups, PART).agg(*[F.sum(k).alias(f"{k}_tot") for k in values])
    w_off = Window.partitionBy(*groups).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(totals.select(*groups, PART, *[
        F.coalesce(F.sum(f"{k}_tot").over(w_off), F.lit(0.0)).alias(f"{k}_off") for k in values
    ]))
    if offsets.count() <= BROADCAST_LIMIT:
        offsets = F.broadcast(offsets)

    end = Window.currentRow if inclusive else -1
    w_in = Window.partitionBy(*groups, PART).orderBy(order_col).rowsBetween(Window.unboundedPreceding, end)
    local = ranged.select("*", *[F.coalesce(F.sum(k).over(w_in), F.lit(0.0)).alias(f"{k}_loc")
                                 for k in values])
    joined = join_null_safe(local, offsets, [*groups, PART])
    return joined.select(
        *df.columns,
        *[(F.col(f"{k}_loc") + F.col(f"{k}_off")).alias(name)
          for name, k in zip(sums, values, strict=True)],
    )


def ordered_rank(df: DataFrame, order_col: str, group_cols: Sequence[str] = (),
                 name: str = "rank", n_ranges: int | None = None) -> DataFrame:
    """1-based row number by ``order_col`` (unique per group), computed without one big task."""
    out = ordered_prefix(df, order_col, {name: F.lit(1)}, group_cols, n_ranges, inclusive=True)
    return out.withColumn(name, F.col(name).cast("long"))
