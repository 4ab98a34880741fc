"""Metrics, prefix sums, splits and shards (FIXTURES C13-C16)."""

import math

import numpy as np
import pytest
from conftest import SF01
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from lagoon.operators.metrics import (auc_by_rank, batch_losses, mean_batch_loss, regression_metrics,
                                      weighted_loss)
from lagoon.operators.prefix import ordered_prefix, ordered_rank
from lagoon.operators.split import entity_split, shard_batch_counts, with_folds
from lagoon.sources.panels import events_panel
from lagoon.sources.tables import read_table


def test_regression_metrics_small(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    r = regression_metrics(df, "y", "p", digits=None).first()
    assert r["rmse"] == pytest.approx(math.sqrt(4 / 3))
    assert r["mae"] == pytest.approx(2 / 3)
    assert r["r2"] == pytest.approx(-1.0)


def test_regression_metrics_match_evaluator(spark):
    df = events_panel(spark, SF01).select("value", (F.col("value") * 0.9 + 3).alias("p"))
    r = regression_metrics(df, "value", "p", digits=None).first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="value", predictionCol="p", metricName=name).evaluate(df)
        assert r[name] == pytest.approx(ev, rel=1e-9)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "s double, y int")
    assert auc_by_rank(df, "y", "s", digits=None).first()["auc"] == pytest.approx(0.875)


def test_auc_matches_exact_evaluator(spark):
    ev = events_panel(spark, SF01).select(
        (F.col("event_type") == "error").cast("double").alias("y"), F.col("value").alias("s"))
    ours = auc_by_rank(ev, "y", "s", digits=None, n_ranges=7).first()["auc"]
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(ev)
    assert ours == pytest.approx(spark_auc, abs=1e-12)


def test_prefix_sums_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), int(k), float(v)) for g, k, v in zip(rng.integers(0, 3, 400), rng.permutation(400),
                                                           rng.normal(size=400), strict=True)]
    df = spark.createDataFrame(rows, "g int, k long, v double")
    got = {(r.g, r.k): (r.run, r.before) for r in
           ordered_prefix(ordered_prefix(df, "k", {"run": F.col("v")}, ["g"], n_ranges=9), "k",
                          {"before": F.col("v")}, ["g"], n_ranges=5, inclusive=False).collect()}
    for g in range(3):
        acc = 0.0
        for _, k, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            assert got[(g, k)][1] == pytest.approx(acc)
            acc += v
            assert got[(g, k)][0] == pytest.approx(acc)


def test_rank_is_row_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 2).alias("g"))
    ranked = ordered_rank(df, "k", ["g"], n_ranges=6)
    bad = ranked.where(F.col("rank") != F.floor(F.col("k") / 2) + 1).count()
    assert bad == 0


def test_loss_means(spark):
    batches = spark.createDataFrame([(0, 0, 3, 1.0), (0, 1, 1, 3.0)], "shard int, batch long, n long, loss double")
    assert weighted_loss(batches, None).first()["weighted_loss"] == pytest.approx(1.5)
    assert mean_batch_loss(batches, None).first()["mean_batch_loss"] == pytest.approx(2.0)


def test_batch_losses_cut_shards_in_batches(spark):
    df = spark.range(0, 10).select(F.col("id").alias("k"), F.lit(1.0).alias("y"), F.lit(0.0).alias("p"))
    b = batch_losses(df, "k", "y", "p", n_shards=4, batch_size=2).collect()
    assert sum(r["n"] for r in b) == 10
    per_shard = {}
    for r in b:
        per_shard[r["shard"]] = per_shard.get(r["shard"], 0) + r["n"]
    assert len(b) == sum(math.ceil(n / 2) for n in per_shard.values())


def test_shard_batch_counts(spark):
    df = spark.range(0, 10).select(F.col("id").alias("k"))
    rows = shard_batch_counts(df, "k", 4, 2).collect()
    assert sum(r["n_rows"] for r in rows) == 10
    assert all(r["n_batches"] == math.ceil(r["n_rows"] / 2) for r in rows)


def test_entity_split_disjoint_and_stable(spark):
    orders = read_table(spark, SF01, "orders")
    train, val = entity_split(orders, "o_custkey")
    t_ids = {r[0] for r in train.select("o_custkey").distinct().collect()}
    v_ids = {r[0] for r in val.select("o_custkey").distinct().collect()}
    assert not (t_ids & v_ids)
    assert train.count() + val.count() == orders.count()
    _, val2 = entity_split(orders.repartition(17), "o_custkey")
    assert {r[0] for r in val2.select("o_custkey").distinct().collect()} == v_ids


def test_folds_keep_entities_whole(spark):
    folds = with_folds(read_table(spark, SF01, "orders"), "o_custkey", 3)
    per_entity = folds.groupBy("o_custkey").agg(F.countDistinct("fold").alias("k"))
    assert per_entity.where("k > 1").count() == 0
    assert {r[0] for r in folds.select("fold").distinct().collect()} == {0, 1, 2}


def test_running_sums_evaluate_their_input_once(spark):
    """AUC over continuous scores and batch numbers: each input row is computed exactly once."""
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(3000).select("id", (F.hash("id") % 1000 / 7).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    df = df.repartition(6).mapInArrow(watched, df.schema)
    assert auc_by_rank(df, "y", "s", n_ranges=5).first().n_pos == 1000
    assert seen.value == 3000
    batches = batch_losses(df, "id", "y", "s", n_shards=3, batch_size=100)
    assert batches.agg(F.sum("n")).first()[0] == 3000
    assert seen.value == 6000


def test_prefix_sums_over_strings_and_nulls(spark):
    rows = [(None if i == 5 else f"k{i:03d}", i % 2, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, g int, v double").repartition(4)
    got = {(r.k, r.g): r.run for r in ordered_prefix(df, "k", {"run": F.col("v")}, ["g"], part_rows=17).collect()}
    run = {0: 0.0, 1: 0.0}
    for k, g, v in sorted(rows, key=lambda r: r[0] or ""):
        run[g] += v
        assert got[k, g] == run[g]
