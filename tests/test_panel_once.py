"""Training queries join their panel once, whatever they fit and score; the net's gradient by falling length."""

import datetime

import numpy as np
import pytest

from lagoon.operators import seqnet
from lagoon.plans import training


def _tables(spark, folder, n=240, customers=30):
    rng = np.random.default_rng(6)
    day = datetime.datetime(2024, 1, 1)
    orders = [(k, int(rng.integers(0, customers)), float(rng.uniform(1, 1000)), day + datetime.timedelta(days=int(rng.integers(0, 400)))) for k in range(n)]
    lines = [(k, float(rng.integers(1, 50))) for k in range(n) for _ in range(int(rng.integers(1, 5)))]
    people = [(c, float(rng.uniform(-10, 100)), int(rng.integers(0, 9)), "HOUSEHOLD" if c % 3 else "OTHER") for c in range(customers)]
    for name, rows, schema in (("orders", orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"),
                               ("lineitem", lines, "l_orderkey long, l_quantity double"),
                               ("customer", people, "c_custkey long, c_acctbal double, c_nationkey int, c_mktsegment string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return n


@pytest.mark.parametrize("name", ["seqnet_train", "seqnet_score", "seqnet_eval", "gbt_forecast", "gbt_cv"])
def test_the_panel_is_joined_once(spark, tmp_dir, monkeypatch, name):
    n = _tables(spark, tmp_dir)
    seen = spark.sparkContext.accumulator(0)
    joined = training.orders_panel

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    def panel(*args):
        df = joined(*args)
        return df.mapInArrow(watched, df.schema)

    monkeypatch.setattr(training, "orders_panel", panel)
    monkeypatch.setattr(training, "GBT_TREES", 2)
    assert training.QUERIES[name](spark, tmp_dir).count() > 0
    assert seen.value == n


def test_gradient_does_not_depend_on_the_order_of_rows():
    shape = seqnet.NetShape(n_features=2, n_statics=2, seq_hidden=4, static_hidden=3)
    rng = np.random.default_rng(3)
    w, rows = seqnet.init_params(shape, 1), (rng.normal(size=(7, 4, 2)), np.array([0, 4, 1, 4, 2, 0, 3]), rng.normal(size=(7, 2)), rng.normal(size=7))
    loss, grad = seqnet.loss_and_grad(shape, w, *rows)
    back, turned = seqnet.loss_and_grad(shape, w, *(x[::-1] for x in rows))
    assert back == pytest.approx(loss) and np.allclose(turned, grad, atol=1e-12)
    y = seqnet.forward(seqnet.unpack(shape, w), *rows[:3])
    assert loss == pytest.approx(np.mean((y - rows[3]) ** 2))
    none = seqnet.loss_and_grad(shape, w, rows[0], np.zeros(7, int), *rows[2:])[1]
    parts = seqnet.unpack(shape, none)
    assert not parts["U"].any() and not parts["W"].any() and parts["Ws"].any()
