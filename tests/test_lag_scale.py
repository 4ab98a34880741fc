"""Lags, collapse, scaler and statistics (FIXTURES C6-C12)."""

import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from lagoon.functions.columns import yes_no_flag
from lagoon.operators.collapse import CollapseMask
from lagoon.operators.lag import ScaledLag, ScaledLagModel
from lagoon.operators.scaler import ColumnScaler
from lagoon.operators.sequence import SequencerModel
from lagoon.operators.stats import StatsError, fit_column_stats
from lagoon.plans.events import lag_stage
from lagoon.sources.panels import events_panel


def frame(spark, rows):
    return spark.createDataFrame(rows, "e string, t int, x double")


def test_lag_values_and_missing_masks(spark):
    df = frame(spark, [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0)])
    m = ScaledLagModel(partition_col="e", order_cols=["t"], sequence_feature_cols=["x"], sequence_length=2,
                       feature_stats={"x": {"mean": 0.0, "std": 1.0}})
    r = {x["t"]: x for x in m.transform(df).collect()}
    assert (r[3]["x_lag_1"], r[3]["x_lag_1_mask"]) == (0.0, 1)     # null lag: 0.0 and mask 1
    assert (r[3]["x_lag_2"], r[3]["x_lag_2_mask"]) == (1.0, 0)
    assert (r[1]["x_lag_1"], r[1]["x_lag_1_mask"]) == (0.0, 1)


def test_unscaled_column_keeps_raw_lag(spark):
    df = frame(spark, [("a", 1, 7.0), ("a", 2, 8.0)])
    m = ScaledLag(partition_col="e", order_cols=["t"], sequence_feature_cols=["x"], sequence_length=1,
                  no_scaling_cols=["x"]).fit(df)
    r = {x["t"]: x for x in m.transform(df).collect()}
    assert r[2]["x_lag_1"] == 7.0 and r[1]["x_lag_1"] == 0.0 and r[1]["x_lag_1_mask"] == 1


def test_zero_std_names_the_column(spark):
    df = frame(spark, [("a", 1, 2.0), ("a", 2, 2.0)])
    with pytest.raises(StatsError, match="x"):
        fit_column_stats(df, ["x"])


def test_single_row_null_std_refused(spark):
    with pytest.raises(StatsError, match="x"):
        fit_column_stats(frame(spark, [("a", 1, 1.0)]), ["x"])


def test_empty_table_refused_not_crash(spark):
    with pytest.raises(StatsError):
        fit_column_stats(frame(spark, []), ["x"])


def test_model_refuses_zero_std_at_transform(spark):
    m = SequencerModel(partition_col="e", order_cols=["t"], sequence_features_cols=["x"],
                       sequence_length=2, feature_stats={"x": {"mean": 1.0, "std": 0.0}})
    with pytest.raises(StatsError, match="x"):
        m.transform(frame(spark, [("a", 1, 1.0)]))


def test_collapse_missing_mask_names_column(spark):
    df = spark.createDataFrame([(1.0,)], "x_lag_1 double")
    with pytest.raises(ValueError, match="x_lag_1_mask"):
        CollapseMask(inputCols=["x_lag_1"]).transform(df)


def test_collapse_sets_null_where_masked(spark):
    df = spark.createDataFrame([(1.5, 0), (0.0, 1)], "v double, v_mask int")
    out = [r["v"] for r in CollapseMask(inputCols=["v"]).transform(df).orderBy("v_mask").collect()]
    assert out == [1.5, None]


def test_flag(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("yes",), (None,)], "f string")
    assert [r[0] for r in df.select(yes_no_flag("f")).collect()] == [True, False, False, False]


def test_scaler_and_inverse(spark):
    df = frame(spark, [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 6.0)])
    m = ColumnScaler(inputCols=["x"]).fit(df)
    out = m.transform(df).select("x", m.inverse(F.col("x_scaled"), "x").alias("back")).collect()
    assert all(r["back"] == pytest.approx(r["x"]) for r in out)
    with pytest.raises(ValueError, match="nope"):
        m.column_stats("nope")


def test_stats_one_pass_matches_pandas(spark):
    events = events_panel(spark, SF01)
    stats = fit_column_stats(events, ["value"])["value"]
    pdf = events.select("value").toPandas()
    assert stats["mean"] == pytest.approx(pdf.value.mean(), rel=1e-12)
    assert stats["std"] == pytest.approx(pdf.value.std(ddof=1), rel=1e-12)


def test_lag_equals_sequence_element(spark):
    """lag i is element (h - i) of the unpadded history when no value is null."""
    events = events_panel(spark, SF01)
    lags = lag_stage().fit(events)
    stats = lags.column_stats("value")
    seq = SequencerModel(partition_col="user_id", order_cols=["ts", "event_id"],
                         sequence_features_cols=["value"], sequence_length=5,
                         feature_stats={"value": stats}, emit_history_len=True)
    both = lags.transform(events).join(seq.transform(events).select("event_id", "value_sequence",
                                                                      "value_history_len"), "event_id")
    bad = 0
    for i in range(1, 6):
        elem = F.element_at("value_sequence", F.col("value_history_len") - i + 1)
        bad += both.where((F.col("value_history_len") >= i) & (F.abs(elem - F.col(f"value_lag_{i}")) > 1e-6)).count()
    assert bad == 0


def test_lag_hot_split_exact(spark):
    events = events_panel(spark, SF001)
    plain = ScaledLag(partition_col="user_id", order_cols=["ts", "event_id"], sequence_feature_cols=["value"],
                      sequence_length=5, hot_entity_rows=0).fit(events)
    split = plain.copy()
    split._set(hot_entity_rows=20, bucket_rows=7)
    a = plain.transform(events)
    b = split.transform(events)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _bursty(spark):
    """Entity a: 40 rows over a year plus 360 rows inside 60 days; entity b: 30 rows."""
    import datetime as dt
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(days=9 * i), i, float(i)) for i in range(40)]
    rows += [("a", start + dt.timedelta(days=100, minutes=240 * i), 100 + i, float(i % 17)) for i in range(360)]
    rows += [("b", start + dt.timedelta(days=i), 1000 + i, float(i)) for i in range(30)]
    return spark.createDataFrame(rows, "e string, ts timestamp_ntz, id long, x double")


def test_ranges_follow_row_counts_not_time(spark):
    """A burst in one hot entity still yields ranges of about part_rows rows, in time order."""
    from lagoon.operators.ranges import PART, range_parts
    parts = range_parts(_bursty(spark), ["e", "ts", "id"], part_rows=40)
    spans = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("e", "ts", "id")).alias("lo"),
                                    F.max(F.struct("e", "ts", "id")).alias("hi")).orderBy(PART).collect()
    assert sum(r["n"] for r in spans) == 430
    assert max(r["n"] for r in spans) <= 80         # uniform time cuts would put 180+ rows in one range
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("kind", ["one instant", "text"])
def test_crowded_instants_and_text_orders_are_split_and_exact(spark, kind):
    """All rows of one day, or an order column of strings: the hot entity is still cut, and equals a brute force."""
    from lagoon.operators.lookback import lookback
    from lagoon.operators.ranges import PART, range_parts
    rows = [("hot" if i % 3 else None if i % 2 else f"e{i % 5}", "same" if kind == "one instant" else f"d{i * 7 % 400:03d}", i, float(i % 23))
            for i in range(400)]
    df = spark.createDataFrame(rows, "e string, d string, id long, x double").repartition(5)

    def build(w):
        return [F.collect_list("x").over(w.rowsBetween(-4, -1)).alias("h"), F.lag("x", 2).over(w).alias("l2")]

    got = {r["id"]: (r["h"], r["l2"]) for r in lookback(df, "e", ["d", "id"], 4, build, hot_rows=100, bucket_rows=30).collect()}
    past, want = {}, {}
    for e, _, i, x in sorted(rows, key=lambda r: (r[1], r[2])):
        have = past.setdefault(e, [])
        want[i] = (have[-4:], have[-2] if len(have) > 1 else None)
        have.append(x)
    assert got == want
    parts = range_parts(df, ["e", "d", "id"], part_rows=30).where("e = 'hot'")
    assert parts.select(PART).distinct().count() > 5
    assert parts.groupBy(PART).count().agg(F.max("count")).first()[0] <= 60


@pytest.mark.parametrize("limit", [1000, 0])      # broadcast mapping, and the shuffle-join branch
def test_lookback_bursty_hot_entity_exact(spark, limit):
    from lagoon.operators.lookback import lookback

    def build(w):
        return [F.lag("x", 1).over(w).alias("l1"), F.lag("x", 3).over(w).alias("l3"),
                F.collect_list("x").over(w.rowsBetween(-3, -1)).alias("h")]

    df = _bursty(spark)
    plain = lookback(df, "e", ["ts", "id"], 3, build, hot_rows=None)
    split = lookback(df, "e", ["ts", "id"], 3, build, hot_rows=50, bucket_rows=40, broadcast_limit=limit)
    assert split.count() == 430
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def _executed_plan(df) -> str:
    """The final adaptive plan after running ``df`` (without the initial-plan section)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("kind", ["lag", "skip", "mask"])
def test_hot_path_shuffles_input_once(spark, kind):
    """Settled rows and re-done heads share one input shuffle (AQE reuses the exchange)."""
    from lagoon.operators.sequence import Sequencer

    events = events_panel(spark, SF001)
    if kind == "lag":
        model = ScaledLag(partition_col="user_id", order_cols=["ts", "event_id"], sequence_feature_cols=["value"],
                          sequence_length=5, hot_entity_rows=20, bucket_rows=7).fit(events)
        out = model.transform(events).select("event_id", "value_lag_1")
    else:
        model = Sequencer(partition_col="user_id", order_cols=["ts", "event_id"], sequence_features_cols=["value"],
                          sequence_length=5, null_policy=kind, hot_entity_rows=20, bucket_rows=7).fit(events)
        out = model.transform(events).select("event_id", "value_sequence")
    plan = _executed_plan(out)
    assert "ReusedExchange" in plan
    assert plan.count("FileScan parquet") == 1      # the stored ranges
