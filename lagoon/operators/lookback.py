"""Bounded look-back windows per entity, safe for hot entities.

Lags 1..N and "the last N values" only look at the N rows before the current
one, in entity order.  The plain plan is one hash exchange on the entity and
one Window node.  Its weak point at scale is skew: every row of an entity
goes to a single task, and Spark's adaptive execution does not split window
partitions.  When one entity may hold a third of all rows, that task is the
whole job.

``lookback`` keeps the plain plan while no entity has more than ``hot_rows`` rows.
Otherwise all rows are cut into stored ranges of about ``bucket_rows`` rows by
(entity, order columns), see ``range_parts``, and the window runs per (entity, range).
There is no list of hot entities and no slot of time: a range simply ends where it is
full, inside one day or one instant as well, and for order columns of any type.

This is exact for every row whose N predecessors are in its own range.  An entity
that runs on into further ranges gets its last N rows of each range handed to the next:
the first N rows of each later range ("heads") are recomputed in a second, small window
over heads plus the last N rows of every range ("tails").  In entity order, the rows
just before a head in that reduced set are exactly its true N predecessors: each of
them is a head of the same range or a tail of an earlier one, including ranges with
fewer than N rows of the entity.  The reduced set holds at most ``2 N`` rows per range.

Entities that run over several ranges are fewer than the ranges.  Their table is
counted before it is broadcast; above ``broadcast_limit`` the join is left to Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lagoon.operators.prefix import join_null_safe
from lagoon.operators.ranges import PART, PART_ROWS, range_parts
from lagoon.session import materialize

DEFAULT_HOT_ROWS = 2_000_000
DEFAULT_BUCKET_ROWS = PART_ROWS
DEFAULT_BROADCAST_LIMIT = 200_000

_FIRST = "__lb_first"
_LAST = "__lb_last"
_RN = "__lb_rn"
_CNT = "__lb_cnt"
_HEAD = "__lb_head"


def entity_window(entity: str | Sequence[str], order_cols: Sequence[str]) -> WindowSpec:
    parts = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*parts).orderBy(*order_cols)


def lookback(
    df: DataFrame,
    entity: str,
    order_cols: Sequence[str],
    depth: int,
    build: Callable[[WindowSpec], list[Column]],
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
) -> DataFrame:
    """Append ``build(window)`` columns; ``build`` may look back at most ``depth`` rows.

    ``build`` receives a window ordered by ``order_cols`` and partitioned by
    the entity (or by entity and range when entities are split) and returns named
    columns.  It is called once per pass, so it must be a pure function of
    the spec.  ``order_cols`` should be unique inside an entity.
    """
    order_cols = list(order_cols)
    plain = df.select("*", *build(entity_window(entity, order_cols)))
    if not hot_rows or depth <= 0:
        return plain
    # One number: the rows of the busiest entity (a partial and final aggregate over one column).
    busiest = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if (busiest or 0) <= hot_rows:
        return plain

    ranged = range_parts(df, [entity, *order_cols], bucket_rows)
    spans = materialize(ranged.groupBy(entity).agg(F.min(PART).alias(_FIRST), F.max(PART).alias(_LAST))
                        .where(F.col(_FIRST) < F.col(_LAST)))
    if spans.count() <= broadcast_limit:
        spans = F.broadcast(spans)
    tagged = join_null_safe(ranged, spans, [entity], "left")

    w_part = entity_window([entity, PART], order_cols)
    pass1 = tagged.select(
        "*",
        *build(w_part),
        F.row_number().over(w_part).alias(_RN),
        F.count(F.lit(1)).over(Window.partitionBy(entity, PART)).alias(_CNT),
    )
    # Both branches below read the same columns (both ends of a span, although one would do), so their
    # exchanges are identical and AQE reuses the shuffle.  Entities in one range have no span, so no head.
    later, earlier = F.col(PART) > F.col(_FIRST), F.col(PART) < F.col(_LAST)
    is_head = F.coalesce(later & (F.col(PART) <= F.col(_LAST)) & (F.col(_RN) <= depth), F.lit(False))
    is_tail = F.coalesce(earlier & (F.col(PART) >= F.col(_FIRST)) & (F.col(_RN) > F.col(_CNT) - depth), F.lit(False))
    helpers = [PART, _FIRST, _LAST, _RN, _CNT]

    settled = pass1.where(~is_head).drop(*helpers)
    context = pass1.where(is_head | is_tail).select(*df.columns, is_head.alias(_HEAD))
    redone = (
        context.select("*", *build(entity_window(entity, order_cols)))
        .where(F.col(_HEAD))
        .drop(_HEAD)
    )
    return settled.unionByName(redone).select(*plain.columns)
