"""Sequencer and look-back windows on hand-made frames (FIXTURES C1-C5) and driver tables."""

import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from lagoon.operators.sequence import Sequencer, SequencerModel
from lagoon.plans.orders import sequencer
from lagoon.sources.panels import orders_panel

UNIT = {"x": {"mean": 0.0, "std": 1.0}}


def model(n=3, policy="skip", order=("t",), **kw):
    return SequencerModel(partition_col="e", order_cols=list(order), sequence_features_cols=["x"],
                          sequence_length=n, null_policy=policy, feature_stats=UNIT, **kw)


def frame(spark, rows, with_id=False):
    schema = "e string, t int, x double" + (", id long" if with_id else "")
    return spark.createDataFrame(rows, schema)


def by_t(df, key="t"):
    return {r[key]: (list(r["x_sequence"]), list(r["x_mask"])) for r in df.collect()}


def test_cold_start(spark):
    out = by_t(model().transform(frame(spark, [("a", 1, 1.0)])))
    assert out == {1: ([0.0, 0.0, 0.0], [0, 0, 0])}


def test_growing_history_oldest_first_padded_right(spark):
    rows = [("a", t, float(t)) for t in range(1, 6)]
    out = by_t(model().transform(frame(spark, rows)))
    assert out[1] == ([0.0, 0.0, 0.0], [0, 0, 0])
    assert out[2] == ([1.0, 0.0, 0.0], [1, 0, 0])
    assert out[3] == ([1.0, 2.0, 0.0], [1, 1, 0])
    assert out[4] == ([1.0, 2.0, 3.0], [1, 1, 1])
    assert out[5] == ([2.0, 3.0, 4.0], [1, 1, 1])


def test_null_inside_skip_and_mask(spark):
    rows = [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("a", 4, 4.0)]
    skip = by_t(model(policy="skip").transform(frame(spark, rows)))
    mask = by_t(model(policy="mask").transform(frame(spark, rows)))
    assert skip[4] == ([1.0, 3.0, 0.0], [1, 1, 0])
    assert mask[4] == ([1.0, 0.0, 3.0], [1, 0, 1])


def test_no_history_crosses_entities(spark):
    rows = [("a", t, float(t)) for t in range(1, 6)] + [("b", 1, 9.0), ("b", 2, 8.0)]
    out = model().transform(frame(spark, rows)).where("e = 'b'")
    got = {r["t"]: list(r["x_sequence"]) for r in out.collect()}
    assert got == {1: [0.0, 0.0, 0.0], 2: [9.0, 0.0, 0.0]}


def test_tie_breaker_decides(spark):
    rows = [("a", 1, 1.0, 2), ("a", 1, 2.0, 1), ("a", 2, 3.0, 3)]
    out = by_t(model(order=("t", "id")).transform(frame(spark, rows, with_id=True)), key="id")
    assert out[1][0] == [0.0, 0.0, 0.0]
    assert out[2][0] == [2.0, 0.0, 0.0]
    assert out[3][0] == [2.0, 1.0, 0.0]


def test_rounding_half_up_4_digits(spark):
    stats = {"x": {"mean": 0.0, "std": 1.0}}
    m = SequencerModel(partition_col="e", order_cols=["t"], sequence_features_cols=["x"],
                       sequence_length=1, feature_stats=stats)
    rows = [("a", 1, 0.00005), ("a", 2, 0.0), ("b", 1, -0.00005), ("b", 2, 0.0)]
    out = {r["e"]: r["x_sequence"][0] for r in m.transform(frame(spark, rows)).where("t = 2").collect()}
    assert out["a"] == pytest.approx(0.0001)
    assert out["b"] == pytest.approx(-0.0001)


def test_no_helper_columns_left(spark):
    df = frame(spark, [("a", 1, 1.0)])
    cols = model().transform(df).columns
    assert cols == ["e", "t", "x", "x_sequence", "x_mask"]


def test_fit_then_transform_scales(spark):
    df = frame(spark, [("a", 1, 1.0), ("a", 2, 3.0)])
    fitted = Sequencer(partition_col="e", order_cols=["t"], sequence_features_cols=["x"],
                       sequence_length=2).fit(df)
    assert fitted.column_stats("x")["mean"] == pytest.approx(2.0)
    out = by_t(fitted.transform(df))
    assert out[2][0][0] == pytest.approx(round((1.0 - 2.0) / fitted.column_stats("x")["std"], 4), rel=1e-6)


def test_properties_on_orders(spark):
    panel = orders_panel(spark, SF01)
    out = sequencer().fit(panel).transform(panel)
    n = 5
    checks = out.select(
        F.max(F.size("o_totalprice_sequence")).alias("max_len"),
        F.min(F.size("o_totalprice_sequence")).alias("min_len"),
        F.max(F.size("o_totalprice_mask")).alias("max_mask"),
    ).first()
    assert checks["max_len"] == checks["min_len"] == checks["max_mask"] == n
    # without nulls the mask sum is min(i, N) where i = rows before the current one
    ranked = out.withColumn(
        "i", F.row_number().over(__import__("pyspark").sql.Window.partitionBy("o_custkey")
                                 .orderBy("o_orderdate", "o_orderkey")) - 1)
    bad = ranked.where(F.aggregate("o_totalprice_mask", F.lit(0), lambda a, x: a + x)
                       != F.least(F.col("i"), F.lit(n))).count()
    assert bad == 0


def test_result_unchanged_under_repartition(spark):
    panel = orders_panel(spark, SF01)
    fitted = sequencer().fit(panel)
    a = fitted.transform(panel).select("o_orderkey", "sum_qty_sequence", "sum_qty_mask")
    b = fitted.transform(panel.repartition(13)).select("o_orderkey", "sum_qty_sequence", "sum_qty_mask")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("policy", ["skip", "mask"])
def test_hot_entity_split_is_exact(spark, policy):
    """Splitting hot customers into small time buckets (some shorter than N) changes nothing."""
    panel = orders_panel(spark, SF001)
    plain = sequencer(policy, hot_entity_rows=0).fit(panel)
    split = sequencer(policy, hot_entity_rows=8, bucket_rows=3).fit(panel)
    cols = ["o_orderkey"] + [f"{f}_{s}" for f in ("o_totalprice", "n_items", "sum_qty")
                             for s in ("sequence", "mask")]
    a = plain.transform(panel).select(*cols)
    b = split.transform(panel).select(*cols)
    assert b.count() == a.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
