"""Small shared steps of the operators: size-checked broadcasts and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.session import materialize

BROADCAST_ROWS = 1_000_000


def stored(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder (reliable checkpoint)."""
    return materialize(df)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table of narrow rows for broadcast if it has at most ``limit`` rows.

    Beyond the limit the table comes back as it is and Spark shuffles the join
    (with AQE's skew splitting).
    """
    return F.broadcast(df) if df.count() <= limit else df
