"""Null entities, late stream rows, layouts of stream input, missing statics, edge cases of running sums."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lagoon.operators.collapse import FillMissing
from lagoon.operators.lag import ScaledLag
from lagoon.operators.metrics import auc_by_rank
from lagoon.operators.split import entity_split
from lagoon.streaming.projection import run_to_parquet, table_stream, with_parity

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("limit", [200_000, 0])
def test_hot_null_entity_equals_plain_plan(spark, limit):
    from pyspark.sql import Window

    from lagoon.operators.lookback import lookback
    rows = [(None if i % 3 else "a", i, float(i * 7 % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, t long, x double")

    def build(w):
        return [F.lag("x", i).over(w).alias(f"l{i}") for i in (1, 2)]

    got = lookback(df, "k", ["t"], 2, build, hot_rows=10, bucket_rows=5, broadcast_limit=limit)
    want = df.select("*", *build(Window.partitionBy("k").orderBy("t")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_split_keeps_null_keys(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    train, validate = entity_split(df, "k")
    assert train.count() + validate.count() == 3
    assert train.where("k is null").count() == 1


def test_auc_of_empty_and_nan_scores(spark):
    empty = spark.createDataFrame([], "y int, s double")
    assert auc_by_rank(empty, "y", "s").first().auc is None
    rows = [(1, math.nan), (0, 1.0), (1, 2.0), (0, 3.0)]
    got = auc_by_rank(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
    assert got.auc == pytest.approx(3 / 4)          # NaN ranks above every number


def test_missing_statics_are_flagged(spark):
    df = spark.createDataFrame([(1.5,), (None,), (math.nan,)], "c double")
    rows = FillMissing(inputCols=["c"]).transform(df).collect()
    assert [(r.c, r.c_missing) for r in rows] == [(1.5, 0.0), (0.0, 1.0), (0.0, 1.0)]


def test_forecaster_survives_unmatched_statics(spark):
    from lagoon.operators.models import gbt_forecaster
    rng = np.random.default_rng(1)
    rows = [(f"e{i % 6}", i, float(rng.normal()), None if i % 6 == 0 else float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, t long, y double, s double")
    model = gbt_forecaster("k", ["t"], ["y"], "y", 2, ["s"], max_iter=2).fit(df)
    assert model.transform(df).where("prediction is not null").count() == 120


def test_stream_reads_a_folder_of_part_files(spark, tmp_dir):
    spark.range(100).select(F.col("id").alias("value")).repartition(4).write.parquet(f"{tmp_dir}/events.parquet")
    sink = run_to_parquet(with_parity(table_stream(spark, tmp_dir, "events")), spark, "parity")
    assert spark.read.parquet(sink).where("is_even").count() == 50
    again = run_to_parquet(with_parity(table_stream(spark, tmp_dir, "events")), spark, "parity-timed",
                           processing_time="1 second")
    assert spark.read.parquet(again).count() == 100


def test_lags_do_not_leave_helper_columns(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)], "k string, t long, x double")
    out = ScaledLag(partition_col="k", order_cols=["t"], sequence_feature_cols=["x"], sequence_length=2,
                    no_scaling_cols=["x"]).fit(df).transform(df)
    assert out.columns == ["k", "t", "x", "x_lag_1", "x_lag_2", "x_lag_1_mask", "x_lag_2_mask"]
