"""Padded histories on a stream, in event time.

Row-frame windows are not supported on streams, so the batch Sequencer cannot run
there.  Here ``transformWithState`` keeps, per entity, a list state with the last N
values and a map state with the rows that still wait for the watermark.  Files and
micro-batches may come in any time order, as long as no row is later than ``delay``.

* Waiting rows lie in time buckets of ``bucket_us`` microseconds.  What a micro-batch
  brings for a bucket is stored in parts of at most an Arrow batch; nothing that is
  stored is read or written again before its bucket is due.
* A timer per bucket fires once the watermark passes the bucket's end.  Then the bucket,
  and only this one, is read, put in order and sent through the ring.  So an entity's
  rows leave in time order, and a task holds one bucket of one entity, however many rows
  the entity has.  ``bucket_width`` picks the width from the busiest entity.
* State is the ring plus the rows younger than the watermark, in RocksDB.
* Spark drops rows behind the watermark; ``run_histories`` raises if there were any.
* ``run_histories`` ends a finite input with one closing row far in the future, which
  moves the watermark past all buckets.

Rows of one instant must fit a task; a row without event time stops the run; event times
lie after 1970 (Spark's first watermark) and before 2262.  Scaling and
rounding happen in Spark before the state step (the same ``round`` as the batch path); the
output matches the batch ``SequencerModel`` with the ``skip`` null policy.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lagoon.functions.columns import rounded_zscore
from lagoon.session import scratch_path
from lagoon.streaming.projection import run_to_parquet

BUCKET_ROWS = 50_000
_LAST = "2262-01-01"     # pandas has no later nanoseconds; event times lie before it
# Chunks come as named tuples, so names may not begin with an underscore.
_ENTITY, _KEY, _AT, _T, _Z, _END = "hist_entity", "hist_key", "hist_at", "hist_t", "hist_z", "hist_end"
_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.numRecentProgressUpdates": "1000000",   # late rows are summed over all of them
}


class LateRowsError(ValueError):
    """Rows came later than the delay allows, so their histories are gone."""


def ring_histories(ring: np.ndarray, values: np.ndarray, length: int):
    """Histories of ``values`` given the previous ``ring`` (NaN = missing).

    Returns ``(sequences float32 (m, N), masks int32 (m, N), new_ring)``;
    missing values are skipped, histories are oldest first and right-padded.
    """
    full = np.concatenate([np.full(length - len(ring), np.nan), ring, values])
    win = sliding_window_view(full, length)[: len(values)]
    present = ~np.isnan(win)
    order = np.argsort(~present, axis=1, kind="stable")
    seqs = np.take_along_axis(np.where(present, win, 0.0), order, axis=1).astype(np.float32)
    masks = (np.arange(length)[None, :] < present.sum(axis=1)[:, None]).astype(np.int32)
    return seqs, masks, full[-length:]


class Histories(StatefulProcessor):
    """Waits for the watermark, then slides each entity's ring over its rows in order."""

    def __init__(self, key: str, feature: str, length: int, bucket_us: int) -> None:
        self.key, self.feature, self.length, self.bucket_us = key, feature, length, bucket_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getListState("ring", "value double")
        self.waiting = handle.getMapState("waiting", "bucket long", "parts int")
        self.rows = handle.getMapState("rows", "bucket long, part int", "t array<long>, id array<long>, z array<double>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            chunk = chunk[~chunk[_END].astype(bool)]
            if chunk.empty:
                continue
            if chunk[_T].isna().any():
                raise ValueError(f"a row of entity {key[0]!r} has no event time")
            t = chunk[_T].to_numpy(np.int64)
            ids, z = chunk[_KEY].to_numpy(np.int64), chunk[_Z].to_numpy(np.float64, na_value=np.nan)
            bucket = t // self.bucket_us
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=bucket[order[0]] - 1))
            for at in np.split(order, edges[1:]):
                b = int(bucket[at[0]])
                part = (self.waiting.getValue((b,)) or (0,))[0]
                if not part:
                    self.handle.registerTimer(self._due(b))
                self.rows.updateValue((b, part), (t[at].tolist(), ids[at].tolist(), z[at].tolist()))
                self.waiting.updateValue((b,), (part + 1,))
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        for b in sorted(k[0] for k in self.waiting.keys() if self._due(k[0]) <= now):
            parts = [self.rows.getValue((b, p)) for p in range(self.waiting.getValue((b,))[0])]
            t, ids, z = (np.concatenate([np.asarray(p[j]) for p in parts]) for j in range(3))
            order = np.lexsort((ids, t))
            ring = np.array([v[0] for v in self.ring.get()], dtype=np.float64)
            seqs, masks, ring = ring_histories(ring, z[order].astype(np.float64), self.length)
            self.ring.put([(float(v),) for v in ring])
            for p in range(len(parts)):
                self.rows.removeKey((b, p))
            self.waiting.removeKey((b,))
            yield pd.DataFrame({self.key: ids[order].astype(np.int64), f"{self.feature}_sequence": list(seqs), f"{self.feature}_mask": list(masks)})

    def close(self) -> None:
        pass

    def _due(self, bucket: int) -> int:
        return -(-(bucket + 1) * self.bucket_us // 1000)


def bucket_width(df: DataFrame, entity: str, time_col: str, bucket_rows: int = BUCKET_ROWS) -> int:
    """Microseconds in which the busiest entity has about ``bucket_rows`` rows, were they evenly spread (one aggregate)."""
    t = _micros(df, time_col)
    top = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi")).agg(
        F.max("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if not top["n"] or top["lo"] is None:
        return 1_000_000
    return max(1000, (top["hi"] - top["lo"] + 1) * bucket_rows // top["n"])


def _micros(df: DataFrame, col: str) -> Column:
    """Microseconds of a timestamp; one without a zone counts as UTC, so its order never depends on the session's zone."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        day = F.unix_date(F.col(col).cast("date")).cast("long") * 86_400
        seconds = day + F.hour(col) * 3600 + F.minute(col) * 60
        return seconds * 1_000_000 + (F.expr(f"extract(SECOND FROM `{col}`)") * 1_000_000).cast("long")
    return F.unix_micros(F.col(col).cast("timestamp"))


def _prepared(df: DataFrame, entity: str, time_col: str, key: str, feature: str, mean: float, std: float) -> DataFrame:
    # The state's key is a text that is never null: pandas turns integers beside a null into floats, which are other keys.
    group = F.coalesce(F.concat(F.lit("="), F.col(entity).cast("string")), F.lit(""))
    at = df.select(group.alias(_ENTITY), F.col(key).cast("long").alias(_KEY), _micros(df, time_col).alias(_T),
                   rounded_zscore(feature, mean, std).alias(_Z))
    return at.withColumns({_AT: F.timestamp_micros(_T), _END: F.lit(False)})


def stream_histories(df: DataFrame, entity: str, time_col: str, key: str, feature: str, mean: float, std: float,
                     length: int, delay: str, bucket_us: int, closing: DataFrame | None = None) -> DataFrame:
    """``(key, {feature}_sequence, {feature}_mask)`` of each streamed row, once the watermark has passed it.

    Rows are ordered by ``(time_col, key)``; ``closing`` is a stream of closing rows (see ``run_histories``).
    """
    # Spark also unpickles the processor in a driver-side worker that does not get the shipped package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = _prepared(df, entity, time_col, key, feature, mean, std)
    if closing is not None:
        rows = rows.unionByName(closing)
    out = f"{key} long, {feature}_sequence array<float>, {feature}_mask array<int>"
    return (rows.withWatermark(_AT, delay).groupBy(_ENTITY)
            .transformWithStateInPandas(Histories(key, feature, length, bucket_us), out, "append", "eventTime"))


def run_histories(spark: SparkSession, df: DataFrame, entity: str, time_col: str, key: str, feature: str, mean: float,
                  std: float, length: int, delay: str, bucket_us: int, name: str = "histories", one_batch: bool = False) -> str:
    """Run a finite stream to its end and return the Parquet sink with one history for each row.

    First all pending input is processed; then a closing row joins from a second, until then
    empty source and a second run from the same checkpoint sends out what still waits.  For a
    source without a cap, whose input is one micro-batch, ``one_batch`` lets the closing row come
    with it and saves the second run.  Raises ``LateRowsError`` if Spark dropped rows behind the
    watermark, also if a source said to be one micro-batch turns out to be several.
    """
    ends, checkpoint, sink = (scratch_path(spark, f"{name}-{x}") for x in ("end", "checkpoint", "sink"))
    shape = _prepared(df, entity, time_col, key, feature, mean, std).schema
    spark.createDataFrame([], shape).write.parquet(ends)
    closing = spark.readStream.schema(shape).parquet(ends)
    hist = stream_histories(df, entity, time_col, key, feature, mean, std, length, delay, bucket_us, closing)
    late = 0
    for last in (True,) if one_batch else (False, True):
        if last:
            (spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in shape])
             .withColumns({_ENTITY: F.lit(""), _AT: F.lit(_LAST).cast("timestamp"), _END: F.lit(True)}).write.mode("append").parquet(ends))
        progress: list[dict] = []
        run_to_parquet(hist, spark, name, sink=sink, checkpoint=checkpoint, conf=_CONF, progress=progress)
        late += sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    if late:
        raise LateRowsError(f"{late} rows came more than {delay} behind the latest one")
    return sink
