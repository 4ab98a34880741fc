"""CSV loading, training-set round trips, persistence, streaming and the sequence net."""

import os
import subprocess
import sys

import numpy as np
import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from lagoon.operators import seqnet
from lagoon.sources.csv import HOUSEHOLD_SCHEMA, NullValuesError, read_csv_panel
from lagoon.sources.panels import events_panel
from lagoon.sources.training_sets import footer_counts, shard_rows, write_shards, write_training_set
from lagoon.streaming.history import ring_histories, run_histories
from lagoon.streaming.projection import run_to_parquet, run_until_batch, table_stream

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HOUSEHOLD_CSV = """Household_ID,Date,Energy_Consumption_kWh,Household_Size,Avg_Temperature_C,Has_AC,Peak_Hours_Usage_kWh
H1,2025-01-01,10.5,3,20.1,Yes,4.2
H1,2025-01-02,11.0,3,19.5,No,4.0
"""


def test_csv_panel_reads_and_flags(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h.csv")
    with open(path, "w") as f:
        f.write(HOUSEHOLD_CSV)
    df = read_csv_panel(spark, path, HOUSEHOLD_SCHEMA, flags={"Has_AC": "Yes"})
    assert [r["Has_AC"] for r in df.orderBy("Date").collect()] == [True, False]
    assert dict(df.dtypes)["Date"] == "date"


def test_csv_blank_row_rejected(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h.csv")
    with open(path, "w") as f:
        f.write(HOUSEHOLD_CSV + ",,,,,,\n")
    with pytest.raises(NullValuesError):
        read_csv_panel(spark, path, HOUSEHOLD_SCHEMA)


def test_shuffled_write_keeps_rows(spark):
    events = events_panel(spark, SF01)
    path = write_training_set(events, spark, "t-events", shuffle_key="event_id", n_files=3)
    back = spark.read.parquet(path)
    assert back.count() == events.count()
    assert back.exceptAll(events).count() == 0


def test_stored_shards_are_the_read_plan(spark):
    """One sorted file per shard and round; rounds hold the same rows for any number of shards; counts come from footers."""
    events = events_panel(spark, SF01)
    two, eight = (write_shards(events, spark, "t-shards", "event_id", n, 3) for n in (2, 8))
    a, b = spark.read.parquet(two), spark.read.parquet(eight)
    assert a.drop("shard", "round").exceptAll(events).count() == 0 and a.count() == b.count() == events.count()
    assert a.select("event_id", "round").exceptAll(b.select("event_id", "round")).count() == 0
    assert len(b.inputFiles()) == 24
    one = b.where("round = 1")
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    counts = {(r.shard, r.round): r.n_rows for r in shard_rows(spark, eight, ("shard", "round")).collect()}
    assert counts == {(r.shard, r.round): r["count"] for r in b.groupBy("shard", "round").count().collect()}
    whole = [r.n_rows for r in shard_rows(spark, eight).collect()]
    assert len(whole) == 8 and max(whole) - min(whole) < 0.15 * max(whole)


def test_footer_counts_read_no_column(spark):
    path = write_shards(spark.range(500).withColumnRenamed("id", "k"), spark, "t-footers", "k", 4, 1)
    names = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        plan = footer_counts(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [shard, round]" in plan
    assert {k: spark.conf.get(k) for k in names} == before
    assert sum(r.n_rows for r in shard_rows(spark, path).collect()) == 500
    assert {k: spark.conf.get(k) for k in names} == before


def test_saved_pipeline_loads_in_fresh_process(spark):
    from pyspark.ml import Pipeline

    from lagoon.plans.events import lag_stage
    from lagoon.session import scratch_path
    events = events_panel(spark, SF001)
    fitted = Pipeline(stages=[lag_stage()]).fit(events)
    path = scratch_path(spark, "t-model")
    fitted.write().overwrite().save(path)
    expected = fitted.transform(events).agg(F.sum("value_lag_3").alias("s")).first()["s"]
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.ml import PipelineModel\n"
        "from lagoon.session import local_session\n"
        "from lagoon.sources.panels import events_panel\n"
        "from pyspark.sql import functions as F\n"
        "s = local_session(2)\n"
        "m = PipelineModel.load(%r)\n"
        "print('SUM', m.transform(events_panel(s, %r)).agg(F.sum('value_lag_3')).first()[0])\n"
    ) % (REPO, path, SF001)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    got = [ln for ln in out.stdout.splitlines() if ln.startswith("SUM")]
    assert got and float(got[0].split()[1]) == pytest.approx(expected)


def test_ring_histories_match_definition():
    ring = np.array([np.nan, 1.0])
    seqs, masks, new_ring = ring_histories(ring, np.array([2.0, np.nan, 3.0]), 2)
    assert seqs.tolist() == [[1.0, 0.0], [1.0, 2.0], [2.0, 0.0]]
    assert masks.tolist() == [[1, 0], [1, 1], [1, 0]]
    assert np.isnan(new_ring[0]) and new_ring[1] == 3.0


def test_stream_equals_batch_over_several_batches(spark, tmp_dir):
    """Events split over 3 files, one file per micro-batch: state carries across batches."""
    from lagoon.operators.sequence import SequencerModel
    from lagoon.operators.stats import fit_column_stats
    events = events_panel(spark, SF001)
    src = os.path.join(tmp_dir, "src")
    for i, cut in enumerate(["ts < '2024-01-02'", "ts >= '2024-01-02' AND ts < '2024-01-03'", "ts >= '2024-01-03'"]):
        events.where(cut).coalesce(1).write.parquet(os.path.join(src, f"part{i}.parquet"))
    stats = fit_column_stats(events, ["value"])
    schema = events.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    got = spark.read.parquet(run_histories(spark, stream, "user_id", "ts", "event_id", "value", stats["value"]["mean"],
                                           stats["value"]["std"], 5, "1 hour", 12 * 3_600_000_000))
    batch = SequencerModel(partition_col="user_id", order_cols=["ts", "event_id"], sequence_features_cols=["value"],
                           sequence_length=5, feature_stats=stats).transform(events)
    a = batch.select("event_id", "value_sequence", "value_mask")
    assert got.count() == a.count()
    assert a.exceptAll(got).count() == 0


def test_file_stream_projection(spark):
    from lagoon.streaming.projection import with_parity
    stream = with_parity(table_stream(spark, SF001, "events").select("event_id"), "event_id")
    out = spark.read.parquet(run_to_parquet(stream, spark, "t-even"))
    assert out.count() == events_panel(spark, SF001).count()
    assert out.where((F.col("event_id") % 2 == 0) != F.col("is_even")).count() == 0


def test_run_until_batch_stops(spark):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    q = rate.withColumn("is_even", F.col("value") % 2 == 0).writeStream.format("noop").trigger(
        processingTime="200 milliseconds").start()
    last = run_until_batch(q, 2, poll_s=0.2, timeout_s=120)
    assert last >= 2 and not q.isActive


def test_gradient_check():
    shape = seqnet.NetShape(n_features=2, n_statics=2, seq_hidden=3, static_hidden=2)
    rng = np.random.default_rng(0)
    w = seqnet.init_params(shape, 1)
    seq, lengths = rng.normal(size=(5, 4, 2)), np.array([0, 1, 4, 2, 3])
    stat, tgt = rng.normal(size=(5, 2)), rng.normal(size=5)
    _, g = seqnet.loss_and_grad(shape, w, seq, lengths, stat, tgt)
    eps = 1e-6
    num = np.array([(seqnet.loss_and_grad(shape, w + eps * e, seq, lengths, stat, tgt)[0]
                     - seqnet.loss_and_grad(shape, w - eps * e, seq, lengths, stat, tgt)[0]) / (2 * eps)
                    for e in np.eye(len(w))])
    assert np.max(np.abs(num - g)) < 1e-6


def test_zero_history_rows_ignore_lstm():
    shape = seqnet.NetShape(n_features=2, n_statics=2, seq_hidden=3, static_hidden=2)
    p = seqnet.unpack(shape, seqnet.init_params(shape, 2))
    rng = np.random.default_rng(1)
    stat = rng.normal(size=(1, 2))
    a = seqnet.forward(p, rng.normal(size=(1, 4, 2)), np.array([0]), stat)
    b = seqnet.forward(p, rng.normal(size=(1, 4, 2)), np.array([0]), stat)
    assert a[0] == pytest.approx(b[0])


def _toy_set(spark, n_rows):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(n_rows):
        steps = rng.normal(size=(3, 2)).astype(float)
        length = int(rng.integers(0, 4))
        stat = rng.normal(size=2)
        target = float(stat[0] * 0.8 - stat[1] * 0.5 + (steps[:length, 0].sum() if length else 0.0) * 0.3)
        rows.append((k, steps.tolist(), length, stat.tolist(), target))
    return spark.createDataFrame(rows, "k long, steps array<array<float>>, length int, statics array<float>, target double")


def _trained(spark, df, shards, rounds, sync_every, epochs=6):
    shape = seqnet.NetShape(n_features=2, n_statics=2, seq_hidden=8, static_hidden=8)
    stored = spark.read.parquet(write_shards(df, spark, "toy", "k", shards, rounds))
    return seqnet.train(spark, stored, shape, 3, rounds, epochs, sync_every, lr=0.02)


def test_every_step_averaged_makes_the_shard_count_irrelevant(spark):
    """Gradients averaged at each step: 2 and 16 shards agree to 1e-4 of the loss and of the weights."""
    df = _toy_set(spark, 600)
    two, many = (_trained(spark, df, n, 6, 1) for n in (2, 16))
    for a, b in zip(two.epochs, many.epochs, strict=True):
        assert a["weighted_loss"] == pytest.approx(b["weighted_loss"], rel=1e-4)
        assert a["n_rows"] == b["n_rows"] == 600
    assert np.abs(two.params - many.params).max() < 1e-4 * np.abs(two.params).max() + 1e-4
    assert two.epochs[-1]["weighted_loss"] < 0.6 * two.epochs[0]["weighted_loss"]


def test_steps_between_averages_keep_shards_close(spark):
    """Four steps between averages: 2 and 16 shards end within a fifth of the first loss, both well below it."""
    df = _toy_set(spark, 600)
    two, many = (_trained(spark, df, n, 3, 4) for n in (2, 16))
    first = two.epochs[0]["weighted_loss"]
    last = [x.epochs[-1]["weighted_loss"] for x in (two, many)]
    assert max(last) < 0.7 * first and abs(last[0] - last[1]) < 0.2 * first


def test_empty_shards_and_rounds_contribute_nothing(spark):
    got = _trained(spark, _toy_set(spark, 20), 9, 5, 2, epochs=1)
    assert got.epochs[0]["n_rows"] == 20


def test_a_round_is_one_job_of_one_stage_and_reruns_agree_to_the_bit(spark):
    """A round has no shuffle: shards' sums come as one row each and are added in their order."""
    df = _toy_set(spark, 200)
    shape = seqnet.NetShape(n_features=2, n_statics=2, seq_hidden=8, static_hidden=8)
    stored = spark.read.parquet(write_shards(df, spark, "toy", "k", 4, 3))
    tracker, got = spark.sparkContext.statusTracker(), []
    try:
        for sync_every in (2, 2, 1):
            group = f"net-{len(got)}"
            spark.sparkContext.setJobGroup(group, group)
            got.append(seqnet.train(spark, stored, shape, 3, 3, 2, sync_every, lr=0.02))
            stages = [len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup(group)]
            assert stages == [1] * 6
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert np.array_equal(got[0].params, got[1].params) and got[0].epochs == got[1].epochs
    assert all(e["n_rows"] == 200 for x in got for e in x.epochs)


def test_saved_net_predicts_the_same_in_a_fresh_process(spark, tmp_dir):
    df = _toy_set(spark, 60)
    got = _trained(spark, df, 2, 2, 1, epochs=1)
    model = seqnet.SeqNetModel.of(seqnet.NetShape(2, 2, 8, 8), 3, got.params)
    model.write().overwrite().save(f"{tmp_dir}/net")
    unlabelled = df.drop("target")
    unlabelled.coalesce(1).write.parquet(f"{tmp_dir}/rows")
    want = {r.k: r.prediction for r in model.transform(spark.read.parquet(f"{tmp_dir}/rows")).collect()}
    code = (
        "from lagoon.session import local_session; from lagoon.operators.seqnet import SeqNetModel\n"
        "spark = local_session(2)\n"
        f"for r in SeqNetModel.load({tmp_dir + '/net'!r}).transform(spark.read.parquet({tmp_dir + '/rows'!r})).collect():\n"
        "    print('ROW', r.k, r.prediction.hex())\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, env=os.environ | {"PYTHONPATH": root})
    lines = [x.split() for x in out.stdout.splitlines() if x.startswith("ROW")]
    assert {int(k): float.fromhex(v) for _, k, v in lines} == want, out.stderr[-2000:]
    assert len(want) == 60
