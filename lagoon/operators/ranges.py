"""Stored range partitions: the shared first step of look-backs and running sums.

``range_parts`` evaluates its input once and stores it, cuts the stored rows into
contiguous ranges of about ``part_rows`` rows by Spark's range partitioner, and stores
them with the number of their range.  Ranges follow row counts, so neither a hot
entity, a burst, one crowded instant nor a string order key makes a large one; only rows
that are equal in all ``cols`` stay together.  Any orderable type will do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.session import scratch_path

PART = "__part"
PART_ROWS = 500_000


def stored_parquet(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder once and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def range_parts(df: DataFrame, cols: Sequence[str], part_rows: int = PART_ROWS, parts: int | None = None) -> DataFrame:
    """The rows of ``df`` with ``PART``, rising in the order of ``cols`` (nulls first), as a stored table."""
    once = stored_parquet(df, "range-input")
    # The count comes from Parquet footers; sampling and shuffling read the stored copy.
    parts = parts or max(1, -(-once.count() // int(part_rows)))
    if parts == 1:
        return once.withColumn(PART, F.lit(0).cast("long"))
    ranged = once.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in cols])
    return stored_parquet(ranged.withColumn(PART, F.spark_partition_id().cast("long")), "range-parts")
