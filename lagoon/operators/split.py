"""Leak-free splits, folds, shards and batch counts.

Every assignment is a pure function of a key: an md5 bucket of
``'<seed>|<key>'``.  Splitting needs no ``distinct`` of ids and no semi join
(a per-row predicate; the md5 is evaluated after the scan).  The same key
lands on the same side whatever the partitioning or the executor count.  Rows
with a null key are training rows, so the two sides hold every row.
``randomSplit`` does not have that property, so a validation set found again
at inference time would differ from the one used in training.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagoon.functions.columns import hash_mod, hash_percent


def is_validation(entity: str, validation_percent: int = 10, seed: int = 42) -> Column:
    return F.coalesce(hash_percent(entity, seed) >= F.lit(100 - validation_percent), F.lit(False))


def entity_split(df: DataFrame, entity: str, validation_percent: int = 10,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(train, validate)``: all rows of an entity fall on the same side."""
    flag = is_validation(entity, validation_percent, seed)
    return df.where(~flag), df.where(flag)


def row_split(df: DataFrame, key: str, test_percent: int = 20,
              seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Row-level ``(train, test)`` split on a unique row key."""
    flag = F.coalesce(hash_percent(key, seed) >= F.lit(100 - test_percent), F.lit(False))
    return df.where(~flag), df.where(flag)


def with_folds(df: DataFrame, entity: str, k: int = 3, seed: int = 42,
               fold_col: str = "fold") -> DataFrame:
    """Cross-validation folds by entity, so no history is cut across folds."""
    return df.withColumn(fold_col, hash_mod(entity, k, seed))


def shard_of(key: str, n_shards: int, seed: int = 42) -> Column:
    """Balanced row-hash shard in [0, n_shards)."""
    return hash_mod(key, n_shards, seed)


def shard_batch_counts(df: DataFrame, key: str, n_shards: int, batch_size: int,
                       seed: int = 42) -> DataFrame:
    """``(shard, n_rows, n_batches)`` with ``n_batches = ceil(n_rows / batch_size)``."""
    return (
        df.select(shard_of(key, n_shards, seed).alias("shard"))
        .groupBy("shard")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select("shard", "n_rows",
                F.ceil(F.col("n_rows") / F.lit(batch_size)).cast("long").alias("n_batches"))
    )
