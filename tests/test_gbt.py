"""The block trainer of boosted trees against Spark's own: same trees, one reading of the input, whatever the layout."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from lagoon.operators import gbt
from lagoon.operators.models import gbt_forecaster

COLS = ["a", "b", "c", "c2", "d", "z"]


def _rows(spark, n=900):
    rng = np.random.default_rng(4)
    a, b, c = np.round(rng.normal(size=n), 2), rng.integers(0, 4, n), rng.random(n) < 0.3
    d = rng.exponential(size=n) * (rng.random(n) < 0.6)
    y = 1000 + 50 * a * b + 30 * c + 20 * np.sin(3 * d) + rng.normal(size=n) * 10
    rows = [tuple(map(float, r)) for r in zip(a, b, c, c, d, np.zeros(n), y, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"{x} double" for x in [*COLS, "y"])).repartition(3)
    return VectorAssembler(inputCols=COLS, outputCol="features").transform(df)


def _trees(spark, model, tmp_dir, name):
    model.write().save(f"{tmp_dir}/{name}")
    return spark.read.parquet(f"{tmp_dir}/{name}/data").orderBy("treeID", "nodeData.id").select("treeID", "nodeData.*").collect()


def test_trees_equal_those_of_spark(spark, tmp_dir):
    df = _rows(spark)
    want, got = (cls(labelCol="y", maxIter=8, maxDepth=4, seed=1).fit(df) for cls in (GBTRegressor, gbt.BlockGBTRegressor))
    a, b = _trees(spark, want, tmp_dir, "spark"), _trees(spark, got, tmp_dir, "blocks")
    assert len(a) == len(b) > 8 * 15
    for x, y in zip(a, b, strict=True):
        assert (x.treeID, x.id, x.leftChild, x.rightChild, x.rawCount, x.split) == (y.treeID, y.id, y.leftChild, y.rightChild, y.rawCount, y.split)
        assert y.prediction == pytest.approx(x.prediction, abs=1e-4)
        assert y.gain == pytest.approx(x.gain, rel=1e-4, abs=1e-4) and y.impurity == pytest.approx(x.impurity, rel=1e-4, abs=1e-3)
    assert got.treeWeights == want.treeWeights and (got.getMaxDepth(), got.getLabelCol()) == (4, "y")
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-6)
    again = GBTRegressionModel.load(f"{tmp_dir}/blocks")
    rows = df.limit(50)
    assert again.transform(rows).select("prediction").collect() == got.transform(rows).select("prediction").collect()


def test_a_job_per_level_grows_the_same_trees_as_one_task(spark, tmp_dir, monkeypatch):
    df = _rows(spark)
    one = _trees(spark, gbt.BlockGBTRegressor(labelCol="y", maxIter=5, maxDepth=3, seed=1).fit(df), tmp_dir, "one")
    monkeypatch.setattr(gbt, "LOCAL_ROWS", 0)
    monkeypatch.setattr(gbt, "BLOCK_ROWS", 64)
    many = _trees(spark, gbt.BlockGBTRegressor(labelCol="y", maxIter=5, maxDepth=3, seed=1).fit(df), tmp_dir, "many")
    exact = [c for c in one[0].__fields__ if c not in ("impurity", "impurityStats")]       # squares are added as doubles
    assert [[r[c] for c in exact] for r in one] == [[r[c] for c in exact] for r in many]
    assert [r.impurity for r in many] == pytest.approx([r.impurity for r in one], abs=1e-6)


def test_the_forecaster_reads_its_vectors_once(spark):
    """Spark's own fit evaluates its input three times: to count, for thresholds, and for the bins."""
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = _rows(spark, 300).drop("features")
    df = VectorAssembler(inputCols=COLS, outputCol="features").transform(raw.mapInArrow(watched, raw.schema))
    trees = gbt_forecaster("e", ["t"], ["y"], "y", 2, ["a"], max_iter=3, max_depth=2).getStages()[-1]
    model = trees.fit(df)
    assert seen.value == 300 and model.getNumTrees == 3


def test_splits_leave_noise_alone_and_ties_go_to_the_first_input():
    s, n = np.array([10, 30, 10, 30, 20, 20]), np.array([2, 2, 2, 2, 2, 2])
    assert gbt.best_split(s, n, [2, 2, 2])[:2] == (0, 0)
    assert gbt.best_split(np.array([20, 20]), np.array([2, 2]), [2]) is None
    assert gbt.best_split(s, n, [2, 2, 2], least=3) is None


def test_other_fits_are_left_to_spark(spark):
    df = _rows(spark, 200).withColumn("w", F.lit(1.0) + F.col("c"))
    args = {"labelCol": "y", "maxIter": 2, "maxDepth": 2, "seed": 1, "weightCol": "w"}
    want, got = GBTRegressor(**args).fit(df), gbt.BlockGBTRegressor(**args).fit(df)
    assert got.toDebugString.split("\n")[1:] == want.toDebugString.split("\n")[1:]
    flat = gbt.BlockGBTRegressor(labelCol="z", maxIter=2, seed=1).fit(df)
    assert flat.transform(df).where("prediction <> 0").count() == 0
    with pytest.raises(Exception, match="Labels MUST NOT be Null or NaN"):
        gbt.BlockGBTRegressor(labelCol="y", maxIter=2).fit(df.withColumn("y", F.when(F.col("c") == 0, F.col("y"))))


def test_thresholds_of_many_rows_come_from_the_sample_that_spark_draws(spark, tmp_dir):
    _rows(spark, 12_000).drop("features").write.parquet(f"{tmp_dir}/rows")              # read in the same order each time
    df = VectorAssembler(inputCols=COLS, outputCol="features").transform(spark.read.parquet(f"{tmp_dir}/rows"))
    want, got = (cls(labelCol="y", maxIter=2, maxDepth=3, seed=7).fit(df) for cls in (GBTRegressor, gbt.BlockGBTRegressor))
    splits = [[line for line in m.toDebugString.split("\n")[1:] if "Predict" not in line] for m in (want, got)]
    assert splits[0] == splits[1] and len(splits[0]) > 20
