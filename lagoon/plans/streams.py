"""Registered streaming queries: the events table read as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagoon.functions.arrays import explode_arrays
from lagoon.operators.stats import fit_column_stats
from lagoon.plans.common import SEQ_LEN
from lagoon.sources.panels import EVENTS, events_panel
from lagoon.streaming.history import bucket_width, run_histories
from lagoon.streaming.projection import run_to_parquet, table_stream, with_parity

KEY = EVENTS.row_key
# Input cap per micro-batch of the stateless projection (whole files: a file is never split).
BATCH_BYTES = 256 * 1024 * 1024


def stream_is_even(spark, sf_dir):
    """Stateless projection on a stream (append, availableNow), read back from its sink."""
    stream = table_stream(spark, sf_dir, "events", max_bytes_per_trigger=BATCH_BYTES)
    projected = with_parity(stream.select(KEY), col=KEY)
    sink = run_to_parquet(projected, spark, "events-is-even")
    return spark.read.parquet(sink)


def stream_sequence(spark, sf_dir):
    """Stateful histories of ``value`` per user on a stream; same output as the batch sequencer."""
    stats = fit_column_stats(events_panel(spark, sf_dir), ["value"])["value"]
    # Part files need not be in time order, so all that is there is one micro-batch: no row is late.
    width = bucket_width(events_panel(spark, sf_dir), EVENTS.entity, EVENTS.order_cols[0])
    sink = run_histories(spark, table_stream(spark, sf_dir, "events"), EVENTS.entity, EVENTS.order_cols[0], KEY, "value",
                         stats["mean"], stats["std"], SEQ_LEN, "1 hour", width, "events-history", one_batch=True)
    back = spark.read.parquet(sink)
    return explode_arrays(back, [KEY], {"value": "value_sequence"}, "feature", "value").select(
        KEY, "feature", "pos", F.col("value"))


QUERIES = {
    "stream_is_even": stream_is_even,
    "stream_sequence": stream_sequence,
}
