"""Session helpers and the shared scratch location.

Library code never invents a machine-local directory: intermediate tables,
stream checkpoints and saved models go below ``spark.checkpoint.dir`` (the
folder a cluster shares between executors).  Only when that setting is
absent -- a test or a laptop run -- do we create one ourselves and register
it on the session.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lagoon", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared scratch folder; created (local runs only) when unset.

    ``spark.checkpoint.dir`` is read from the session.  It cannot be changed
    at run time, so when it is absent (tests, a laptop) a local folder is
    registered as the context's checkpoint directory instead.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lagoon-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch folder."""
    return f"{checkpoint_root(spark)}/lagoon/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for functions that run in Python workers."""
    context = spark.sparkContext
    if getattr(context, "_lagoon_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lagoon-zip-"), "lagoon.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    context._lagoon_shipped = True


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made inside drop the files of their shuffles when they end.

    For results that are stored and read back.  Otherwise such files stay until the driver happens to
    collect its garbage, and a chain of stored steps holds the files of all of them.
    """
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP_KEY) if before is None else spark.conf.set(_CLEANUP_KEY, before)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small intermediate table once and cut its lineage.

    Reliable ``checkpoint`` (files under ``spark.checkpoint.dir``), so a
    table that is counted, broadcast and joined is not recomputed from the
    big input at every use, and a lost executor does not lose it.  The files of
    its shuffles go at once.
    """
    checkpoint_root(df.sparkSession)
    with dropping_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)      # a query made here: the one of ``df`` was made without the setting
