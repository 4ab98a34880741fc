"""Readers for the Parquet tables a run is pointed at."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, e.g. ``read_table(spark, d, "orders")``.

    The read stays lazy, so Catalyst prunes columns and pushes filters into
    the Parquet scan (``ReadSchema`` / ``PushedFilters`` in ``explain``).
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
