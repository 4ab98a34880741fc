"""Event-time histories: files and triggers in any time order, hot entities, late rows, nulls."""

import datetime
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lagoon.streaming.history import LateRowsError, bucket_width, run_histories
from lagoon.streaming.projection import table_stream

START = datetime.datetime(2024, 1, 1)


def _stream(spark, folder, parts, files=1):
    os.makedirs(f"{folder}/events.parquet")
    for i, part in enumerate(parts):
        path = f"{folder}/events.parquet/part-{i}.parquet"
        rows = [(u, START + datetime.timedelta(seconds=t), i, x) for u, t, i, x in part]
        pd.DataFrame(rows, columns=["u", "t", "id", "x"]).astype({"t": "datetime64[us]", "x": "float64"}).to_parquet(path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return table_stream(spark, folder, "events", max_files_per_trigger=files)


def _want(rows, n=3):
    out, past = {}, {}
    for u, _, i, x in sorted(rows, key=lambda r: (r[1], r[2])):
        have = [v for v in past.setdefault(u, [])[-n:] if v is not None]
        out[i] = (have + [0.0] * (n - len(have)), [1] * len(have) + [0] * (n - len(have)))
        past[u].append(x)
    return out


def _got(spark, sink):
    rows = spark.read.parquet(sink).collect()
    out = {r.id: (r.x_sequence, r.x_mask) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("bucket_us", [7_000_000, 3_600_000_000])
def test_files_in_any_order_over_many_triggers(spark, tmp_dir, bucket_us):
    """A third of the rows belong to one user; ties of time go by key; nulls are skipped."""
    rng = np.random.default_rng(1)
    rows = [("hot" if i % 3 == 0 else f"u{i % 7}" if i % 11 else None, int(t), i, None if i % 13 == 0 else float(i % 50))
            for i, t in enumerate(rng.integers(0, 90, 180))]
    rows.sort(key=lambda r: r[1])
    mixed = [rows[120:], rows[:60], rows[60:120]]
    parts = [p[k::2] for k in (1, 0) for p in mixed]
    sink = run_histories(spark, _stream(spark, tmp_dir, parts), "u", "t", "id", "x", 0.0, 1.0, 3, "2 minutes", bucket_us)
    assert _got(spark, sink) == _want(rows)


def test_rows_leave_before_the_input_ends(spark, tmp_dir):
    """With a short delay the state is emptied as the watermark moves, and the ring carries on."""
    rows = [("a", 10 * i, i, float(i)) for i in range(40)]
    sink = run_histories(spark, _stream(spark, tmp_dir, [rows[i:i + 8] for i in range(0, 40, 8)]), "u", "t", "id", "x", 0.0, 1.0, 3,
                         "1 second", 20_000_000)
    assert _got(spark, sink) == _want(rows)
    files = spark.read.parquet(sink).withColumn("f", F.input_file_name()).where("id < 100").select("f").distinct().count()
    assert files > 2


def test_rows_behind_the_watermark_stop_the_run(spark, tmp_dir):
    rows = [("a", i, i, float(i)) for i in range(60)]
    stream = _stream(spark, tmp_dir, [rows[40:], rows[20:40], rows[:20]])
    with pytest.raises(LateRowsError, match="behind"):
        run_histories(spark, stream, "u", "t", "id", "x", 0.0, 1.0, 3, "1 second", 1_000_000)


def test_one_micro_batch_needs_one_run(spark, tmp_dir):
    rows = [("a" if i % 2 else "b", (i * 37) % 100, i, float(i)) for i in range(100)]
    stream = _stream(spark, tmp_dir, [rows[k::3] for k in range(3)], files=None)
    sink = run_histories(spark, stream, "u", "t", "id", "x", 0.0, 1.0, 3, "1 second", 9_000_000, one_batch=True)
    assert _got(spark, sink) == _want(rows)


@pytest.mark.parametrize("one_batch", [True, False])
def test_integer_entities_beside_a_null_one(spark, tmp_dir, one_batch):
    """A null entity (and the closing row, which has none) must not turn integer keys into floats."""
    df = spark.range(400).select((F.col("id") % 7).alias("u"), F.timestamp_seconds(1_700_000_000 + (F.col("id") * 37) % 400).alias("t"), "id",
                                 F.col("id").cast("double").alias("x")).withColumn("u", F.when(F.col("u") > 0, F.col("u")))
    df.repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    stream = table_stream(spark, tmp_dir, "events")
    sink = run_histories(spark, stream, "u", "t", "id", "x", 0.0, 1.0, 3, "1 second", 90_000_000, one_batch=one_batch)
    assert _got(spark, sink) == _want([(i % 7 or None, (i * 37) % 400, i, float(i)) for i in range(400)])


def test_several_micro_batches_said_to_be_one_stop_the_run(spark, tmp_dir):
    rows = [("a", i, i, float(i)) for i in range(30)]
    with pytest.raises(LateRowsError):
        run_histories(spark, _stream(spark, tmp_dir, [rows[:10], rows[10:20], rows[20:]]), "u", "t", "id", "x", 0.0, 1.0, 3, "1 second", 9_000_000, one_batch=True)


def test_bucket_width_follows_the_busiest_entity(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("u"), F.timestamp_seconds("id").alias("t"))
    assert bucket_width(df, "u", "t", bucket_rows=90) == (999_000_000 + 1) * 90 // 900
    assert bucket_width(df.where("id < 0"), "u", "t") == 1_000_000
