"""Histogram boosting against a plain NumPy brute force, and the saved forecaster."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lagoon.operators import boost
from lagoon.operators.boost import HistBoost, HistBoostModel
from lagoon.operators.models import boosted_forecaster

COLS = ["a", "b", "c"]


def _frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "y double, a double, b double, c double").repartition(parts)


def _data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    x[rng.random((n, 3)) < 0.2] = np.nan
    y = np.where(np.isnan(x[:, 0]), 7.0, x[:, 0]) + 2.0 * (np.nan_to_num(x[:, 1], nan=-1.0) > 5) + rng.normal(0, 0.1, n)
    return x, y


def _rows(x, y):
    return [(float(t), *[None if np.isnan(v) else float(v) for v in r]) for r, t in zip(x, y)]


def _brute_tree(x, r, depth, reg):
    """Tree by trying every value, both sides for the missing; nested tuples, leaves are sums over (n + reg)."""
    leaf = r.sum() / (len(r) + reg)
    if depth == 0:
        return leaf
    best = None
    for j in range(x.shape[1]):
        gone = np.isnan(x[:, j])
        for t in np.unique(x[~gone, j]):
            for missing_left in (True, False):
                left = np.where(gone, missing_left, x[:, j] <= t)
                if left.all() or not left.any():
                    continue
                gain = sum(r[s].sum() ** 2 / (s.sum() + reg) for s in (left, ~left))
                if best is None or gain > best[0] + 1e-7:
                    best = (gain, j, t, missing_left if gone.any() else left.sum() >= (~left).sum(), left)
    if best is None or best[0] - r.sum() ** 2 / (len(r) + reg) <= 1e-7:
        return leaf
    _, j, t, side, left = best
    return (j, t, side, _brute_tree(x[left], r[left], depth - 1, reg), _brute_tree(x[~left], r[~left], depth - 1, reg))


def _walk(tree, row):
    while isinstance(tree, tuple):
        j, t, side, left, right = tree
        tree = left if (side if np.isnan(row[j]) else row[j] <= t) else right
    return tree


def _brute(x, y, trees, depth, rate, reg=1.0):
    out = np.full(len(y), y.mean())
    for _ in range(trees):
        tree = _brute_tree(x, y - out, depth, reg)
        out = out + rate * np.array([_walk(tree, row) for row in x])
    return out


@pytest.mark.parametrize("every", [1, 3, 10])
def test_equals_brute_force(spark, every):
    x, y = _data()
    model = HistBoost(inputCols=COLS, labelCol="y", maxIter=4, maxDepth=3, learningRate=0.5, storeEvery=every).fit(_frame(spark, _rows(x, y)))
    got = model.transform(spark.createDataFrame([(i, *r) for i, r in enumerate(_rows(x, y))], "i int, y double, a double, b double, c double"))
    got = np.array([r.prediction for r in got.orderBy("i").collect()])
    assert np.allclose(got, _brute(x, y, 4, 3, 0.5), atol=1e-6)
    assert np.mean((got - y) ** 2) < 0.2 * y.var()


def test_trees_do_not_depend_on_partitions(spark):
    x, y = _data(seed=5)
    a, b = (HistBoost(inputCols=COLS, labelCol="y", maxIter=3, maxDepth=3).fit(_frame(spark, _rows(x, y), p)).forest for p in (1, 7))
    for name in ("feature", "split", "missing_left", "value"):
        assert (getattr(a, name) == getattr(b, name)).all()


def test_missing_rows_take_the_side_that_gains(spark):
    rows = [(0.0, float(i % 5), None, None) for i in range(50)] + [(10.0, 5.0, None, None)] * 10 + [(10.0, None, None, None)] * 10
    model = HistBoost(inputCols=COLS, labelCol="y", maxIter=1, maxDepth=1, learningRate=1.0, regLambda=0.0).fit(_frame(spark, rows))
    assert not model.forest.missing_left[0, 1] and model.forest.feature[0, 1] == 0
    got = {(r.a, r.prediction) for r in model.transform(_frame(spark, rows)).collect()}
    assert {a: round(p, 6) for a, p in got} == {**{float(i): 0.0 for i in range(5)}, 5.0: 10.0, None: 10.0}


def test_edges_of_the_fit(spark):
    constant = HistBoost(inputCols=COLS, labelCol="y").fit(_frame(spark, [(2.5, 1.0, None, 3.0)] * 4))
    assert len(constant.forest.feature) == 0
    scored = constant.transform(_frame(spark, [(None, None, float("nan"), 1.0)]).withColumn("prediction", F.lit("old")))
    assert scored.first().prediction == 2.5 and scored.columns.count("prediction") == 1
    rows = [(None, 1.0, 1.0, 1.0), (float("nan"), 2.0, 1.0, 1.0), (1.0, 1.0, None, 1.0), (3.0, 2.0, None, 1.0)]
    some = HistBoost(inputCols=COLS, labelCol="y", maxIter=1, learningRate=1.0, regLambda=0.0).fit(_frame(spark, rows))
    assert some.get("baseScore") == 2.0
    assert sorted(r.prediction for r in some.transform(_frame(spark, rows)).collect()) == pytest.approx([1.0, 1.0, 3.0, 3.0], abs=1e-6)
    with pytest.raises(ValueError, match="no row has a label"):
        HistBoost(inputCols=COLS, labelCol="y").fit(_frame(spark, [(None, 1.0, 1.0, 1.0)]))
    with pytest.raises(ValueError, match="maxBins"):
        HistBoost(inputCols=COLS, labelCol="y", maxBins=300).fit(_frame(spark, rows))


def test_whole_forecaster_reloads_to_the_same_predictions(spark, tmp_dir):
    rng = np.random.default_rng(1)
    rows = [(f"e{i % 6}", i, float(rng.normal()), None if i % 6 == 0 else float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, t long, y double, s double")
    model = boosted_forecaster("k", ["t"], ["y"], "y", 2, ["s"], max_iter=3).fit(df)
    model.write().overwrite().save(f"{tmp_dir}/model")
    loaded = PipelineModel.load(f"{tmp_dir}/model")
    assert isinstance(loaded.stages[-1], HistBoostModel)
    want = {r.t: r.prediction for r in model.transform(df).collect()}
    assert {r.t: r.prediction for r in loaded.transform(df).collect()} == want and len(want) == 120
    # Missing lags and statics reach the trees as such, never as 0.0.
    inputs = PipelineModel(loaded.stages[:-1]).transform(df)
    assert inputs.where("t < 6 AND y_lag_1 IS NULL").count() == 6
    assert inputs.where("k = 'e0' AND s_scaled IS NOT NULL").count() == 0


def test_levels_read_blocks_of_rows_and_not_a_record_per_row(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(float(rng.normal()), float(rng.normal()) if rng.random() > 0.2 else None, float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(3)
    fit = HistBoost(["a", "b"], "y", maxIter=3, maxDepth=2, maxBins=8, storeEvery=1)
    stored = []
    monkeypatch.setattr(boost, "_delete", lambda s, path: stored.append(s.read.parquet(path)))
    whole = fit.fit(df).forest
    assert len(stored) == 3 and all(0 < d.count() <= 3 for d in stored)
    assert all(sum(len(r.y) for r in d.collect()) == 8 * 3000 for d in stored)
    monkeypatch.setattr(boost, "BLOCK_ROWS", 7)
    cut = fit.fit(df).forest
    assert stored[3].count() > 400
    for name in ("feature", "split", "missing_left", "value"):
        assert np.array_equal(getattr(whole, name), getattr(cut, name))
