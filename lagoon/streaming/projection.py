"""Stateless stream projection and the stop-after-batch helper."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lagoon.session import scratch_path


def table_stream(spark: SparkSession, sf_dir: str, table: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A file stream over one Parquet table (a file or a folder of part files), with its declared schema.

    The schema comes from the table's own footer, so nothing is inferred
    while the stream runs.  ``max_files_per_trigger`` or
    ``max_bytes_per_trigger`` (at most one) caps the input of a micro-batch,
    and ``availableNow`` honours the cap by running several micro-batches.
    A file is never split between micro-batches.
    """
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    # A pattern: the file source takes a plain path for a folder, a pattern may match a file or a folder.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def with_parity(df: DataFrame, col: str = "value", out: str = "is_even") -> DataFrame:
    """Append ``col % 2 == 0``."""
    return df.withColumn(out, (F.col(col) % 2) == 0)


def run_to_parquet(df: DataFrame, spark: SparkSession, name: str, timeout_s: float | None = None,
                   processing_time: str | None = None, sink: str | None = None, checkpoint: str | None = None,
                   conf: dict[str, str] | None = None, progress: list | None = None) -> str:
    """Run a streaming DataFrame into a Parquet sink (append) and return the sink path.

    With no ``processing_time`` the trigger is ``availableNow``: every
    pending input is processed and the query stops by itself.  With a
    ``processing_time`` trigger the query is stopped once the input that was
    there has been processed.  Without ``timeout_s`` (availableNow only) there is
    no limit on the run.  Sink and checkpoint live below the shared scratch folder
    unless they are given.  ``conf`` holds while the query starts; ``progress`` gets the
    progress of its micro-batches.
    """
    sink = sink or scratch_path(spark, f"{name}-sink")
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-ckpt")))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    before = {k: spark.conf.get(k, None) for k in conf or {}}
    try:
        for k, v in (conf or {}).items():
            spark.conf.set(k, v)
        query = writer.start(sink)          # a query keeps the settings it starts with
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if processing_time:
        query.processAllAvailable()
        query.stop()
        return sink
    query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if query.isActive:
        query.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if query.exception():
        raise query.exception()
    if progress is not None:
        progress.extend(query.recentProgress)
    return sink


def run_until_batch(query: StreamingQuery, stop_at_batch: int, poll_s: float = 0.5,
                    timeout_s: float = 300) -> int:
    """Stop ``query`` once its last progress reports ``batchId >= stop_at_batch``.

    Returns the last batch id seen; raises ``TimeoutError`` (after stopping
    the query) if the target is not reached in time.
    """
    deadline = time.monotonic() + timeout_s
    last = -1
    while query.isActive:
        progress = query.lastProgress
        if progress:
            last = progress["batchId"]
            if last >= stop_at_batch:
                query.stop()
                break
        if time.monotonic() > deadline:
            query.stop()
            raise TimeoutError(f"batch {stop_at_batch} not reached, last was {last}")
        time.sleep(poll_s)
    query.awaitTermination()
    return last
