"""Stored intermediate tables."""

import time

from pyspark.sql import functions as F

from lagoon.session import dropping_shuffles, materialize

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    names = env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {x for x in names if "/shuffle_" in x}


def _left(spark, before, seconds=10):
    """Shuffle files that are not in ``before``, after some time for Spark to drop them."""
    until = time.time() + seconds
    while (new := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def _grouped(spark):
    return spark.range(5000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s")).repartition(6, "s")


def test_materialize_leaves_rows_but_no_shuffle_files(spark):
    df, before, setting = _grouped(spark), _shuffle_files(spark), spark.conf.get(KEY, None)
    got = materialize(df)
    assert not _left(spark, before)
    assert got.exceptAll(df).count() == 0 and got.count() == 100
    assert spark.conf.get(KEY, None) == setting


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_dir):
    df, before = _grouped(spark), _shuffle_files(spark)
    with dropping_shuffles(spark):
        df.write.parquet(f"{tmp_dir}/out")
    assert not _left(spark, before)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 100
