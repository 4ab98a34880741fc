"""Gradient-boosted regression trees on histograms, with a learned side for missing values.

Inputs may be null or NaN: nothing is filled.  Every split decides, by its gain, to which
side rows without the value go; where a node saw none, they follow the larger child.

Fitting, for squared loss:

1. The rows are stored once.  One aggregate gives the bin edges of all inputs (approximate
   quantiles, at most ``maxBins`` each; the maximum is one, so "has a value or not" is a split).
2. Values become one byte per input.  They are stored in blocks of up to ``BLOCK_ROWS`` rows, a block
   being one record of three byte strings (labels, margins, bins input by input): every level reads them
   all, and handing a task a record per row would cost far more than the few additions on it.
3. A tree level is one Spark job: every task adds the residuals of its rows to a histogram
   over (node, input, bin), and ``groupBy(cell).sum`` adds the tasks up.  The driver sees
   one row per non-empty cell, at most 2 ** depth x inputs x (maxBins + 2), whatever the data,
   and picks the splits.  The last level's sums are the leaves' values, so a tree of depth d
   takes d jobs.
4. After every ``storeEvery`` trees the margins are stored anew and the older copy is deleted;
   in between, tasks add the few newer trees to the stored margin.

Residuals are added as integers (2 ** -30 of the largest first residual), exactly, so trees do not
depend on partitioning, on the order of additions or on retried tasks.  Only the stored rows
are read again when an executor is lost.

Edges: rows whose label is null, NaN or infinite are left out of the fit and are scored like others;
an input without any value is never split on; a constant label gives no trees; no
labelled row at all is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagoon.operators.params import HasInputCols
from lagoon.operators.ranges import PART_ROWS, stored_parquet
from lagoon.session import scratch_path

EDGE_ACCURACY = 10_000
BLOCK_ROWS = 10_000
_BLOCK = "y binary, margin binary, bins binary"
_LOW_BITS = 20
_TASK_BITS = 31


@dataclass
class Forest:
    """Trees as heaps: node 1 is the root, the children of i are 2i and 2i + 1; ``feature`` -1 is a leaf."""

    edges: list[np.ndarray]      # rising bin edges of every input
    max_bins: int
    feature: np.ndarray          # trees x heap
    split: np.ndarray            # present values in bins 0..split go left
    missing_left: np.ndarray
    value: np.ndarray            # of leaves, learning rate included

    @classmethod
    def empty(cls, edges: list[np.ndarray], max_bins: int, depth: int, trees: int = 0) -> Forest:
        shape = (trees, 2 << depth)
        return cls(edges, max_bins, np.full(shape, -1, np.int32), np.zeros(shape, np.int32), np.ones(shape, bool), np.zeros(shape))

    @property
    def missing(self) -> int:
        return self.max_bins + 1

    def plus(self, tree: Forest) -> Forest:
        return Forest(self.edges, self.max_bins, *[np.vstack([getattr(self, c), getattr(tree, c)])
                                                   for c in ("feature", "split", "missing_left", "value")])

    def bins(self, values: np.ndarray) -> np.ndarray:
        """Bins of an n x inputs array of doubles (NaN: missing)."""
        out = np.empty(values.shape, np.uint8)
        for j, edges in enumerate(self.edges):
            out[:, j] = np.where(np.isnan(values[:, j]), self.missing, np.searchsorted(edges, values[:, j], side="left"))
        return out

    def nodes(self, tree: int, bins: np.ndarray) -> np.ndarray:
        """Heap index of the node that every row ends in."""
        rows, at = np.arange(len(bins)), np.ones(len(bins), np.int64)
        depth = self.feature.shape[1].bit_length() - 2
        for _ in range(depth):
            f = self.feature[tree, at]
            b = bins[rows, np.maximum(f, 0)]
            right = np.where(b == self.missing, ~self.missing_left[tree, at], b > self.split[tree, at])
            at = np.where(f < 0, at, 2 * at + right)
        return at

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins))
        for t in range(len(self.feature)):
            out += self.value[t, self.nodes(t, bins)]
        return out


def _doubles(batch: pa.RecordBatch, first: int, n: int) -> np.ndarray:
    """Columns ``first .. first + n`` as n doubles per row, nulls as NaN."""
    return np.column_stack([batch.column(first + j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(n)])


def _block(y: np.ndarray, margin: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
    """One record of a block of rows; ``bins`` is rows x inputs and stored input by input."""
    parts = (y.astype(np.float64, copy=False), margin, np.ascontiguousarray(bins.T))
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], names=["y", "margin", "bins"])


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(y, margin, bins) of every block of a batch, ``bins`` as rows x inputs."""
    for i in range(batch.num_rows):
        y, margin, bins = (np.frombuffer(batch.column(j)[i].as_buffer(), t) for j, t in enumerate((np.float64, np.float64, np.uint8)))
        yield y, margin, bins.reshape(width, len(y)).T


def quantile_edges(df: DataFrame, cols: list[str], max_bins: int) -> list[np.ndarray]:
    """At most ``max_bins`` distinct rising edges per column, from one aggregate; the last is the maximum."""
    shares = F.array(*[F.lit((i + 1) / max_bins) for i in range(max_bins)])
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(c), F.col(c)), shares, EDGE_ACCURACY).alias(f"e{i}")
                   for i, c in enumerate(cols)]).first()
    return [np.unique(np.asarray(row[f"e{i}"] or [], float)) for i in range(len(cols))]


def best_splits(g: np.ndarray, n: np.ndarray, widths: list[int], reg: float, least: int) -> list[tuple | None]:
    """Per node the split of largest gain, from residual sums and counts over (node, input, bin).

    The last bin holds the rows without a value.  Ties go to the smaller input, then bin, then
    to "missing left".  None where no split gains.  Else (input, bin, missing_left, left, right)
    with (sum, count) of both children.
    """
    out: list[tuple | None] = []
    usable = np.arange(g.shape[2] - 2)[None, :] < np.asarray(widths)[:, None]
    for gs, ns in zip(g, n):
        g_all, n_all = gs[0].sum(), ns[0].sum()
        parent = g_all * g_all / (n_all + reg)
        g_cum, n_cum = gs[:, :-2].cumsum(1), ns[:, :-2].cumsum(1)
        g_left = np.stack([g_cum + gs[:, -1:], g_cum], axis=2)              # missing left, missing right
        n_left = np.stack([n_cum + ns[:, -1:], n_cum], axis=2)
        g_right, n_right = g_all - g_left, n_all - n_left
        with np.errstate(invalid="ignore"):                                 # 0 / 0 in empty children, left out below
            gain = g_left ** 2 / (n_left + reg) + g_right ** 2 / (n_right + reg) - parent
        ok = usable[:, :, None] & (n_left >= least) & (n_right >= least)
        gain = np.where(ok, gain, -np.inf)
        j, b, side = np.unravel_index(int(gain.argmax()), gain.shape)
        if not gain[j, b, side] > 1e-9 * max(1.0, parent):
            out.append(None)
            continue
        left, right = (g_left[j, b, side], n_left[j, b, side]), (g_right[j, b, side], n_right[j, b, side])
        missing_left = side == 0 if ns[j, -1] else left[1] >= right[1]
        out.append((int(j), int(b), bool(missing_left), left, right))
    return out


def _level_cells(rows: DataFrame, newer: Forest, tree: Forest, slots: np.ndarray, base: float, unit: float) -> DataFrame:
    """Rows (cell, hi, lo, n) of stored blocks: residual sums and counts of the level's nodes; ``slots`` maps heap index to node or -1."""
    width, n_bins = len(tree.edges), tree.max_bins + 2
    n_cells = (int(slots.max()) + 1) * width * n_bins
    state = rows.sparkSession.sparkContext.broadcast((newer, tree, slots))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        newer, tree, slots = state.value
        g, n = np.zeros(n_cells, np.int64), np.zeros(n_cells, np.int64)
        for y, margin, bins in (block for batch in batches for block in _blocks(batch, width)):
            slot = slots[tree.nodes(0, bins)]
            live = slot >= 0
            if not live.all():
                y, margin, bins, slot = y[live], margin[live], np.asfortranarray(bins[live]), slot[live]
            r = np.rint((y - base - margin - newer.margin(bins)) / unit).astype(np.int64)
            # bincount adds doubles: whole residuals where no sum can reach 2 ** 53, else both halves, so the sums are exact.
            whole = int(np.abs(r).max(initial=0)) * len(r) < 1 << 53
            halves = [(r.astype(np.float64), 0)] if whole else [
                ((r >> _LOW_BITS).astype(np.float64), _LOW_BITS), ((r & ((1 << _LOW_BITS) - 1)).astype(np.float64), 0)]
            first = slot * (width * n_bins)
            for j in range(width):
                cell = first + (j * n_bins + bins[:, j].astype(np.int64))
                for part, shift in halves:
                    g += np.bincount(cell, part, n_cells).astype(np.int64) << shift
                n += np.bincount(cell, minlength=n_cells)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(g[at] >> _TASK_BITS), pa.array(g[at] & ((1 << _TASK_BITS) - 1)), pa.array(n[at])],
            names=["cell", "hi", "lo", "n"])

    cells = rows.select("y", "margin", "bins").mapInArrow(add, "cell long, hi long, lo long, n long")
    return cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("hi", "lo", "n")])


def _grow(rows: DataFrame, newer: Forest, depth: int, base: float, unit: float, rate: float, reg: float, least: int) -> Forest:
    """One tree on the residuals of ``rows``, a job per level."""
    tree = Forest.empty(newer.edges, newer.max_bins, depth, 1)
    shape = (len(tree.edges), tree.max_bins + 2)
    widths = [len(e) for e in tree.edges]
    open_nodes = [1]
    for _ in range(depth):
        slots = np.full(2 << depth, -1, np.int64)
        slots[open_nodes] = np.arange(len(open_nodes))
        got = _level_cells(rows, newer, tree, slots, base, unit).toArrow()
        g, n = np.zeros((len(open_nodes), *shape)), np.zeros((len(open_nodes), *shape))
        at = got["cell"].to_numpy()
        g.reshape(-1)[at] = got["hi"].to_numpy() * float(1 << _TASK_BITS) + got["lo"].to_numpy()
        n.reshape(-1)[at] = got["n"].to_numpy()
        children = []
        for node, found in zip(open_nodes, best_splits(g, n, widths, reg, least)):
            if found is None:
                continue
            tree.feature[0, node], tree.split[0, node], tree.missing_left[0, node] = found[:3]
            for child, (g_sum, n_sum) in zip((2 * node, 2 * node + 1), found[3:]):
                tree.value[0, child] = rate * unit * g_sum / (n_sum + reg)
                children.append(child)
        open_nodes = children
        if not open_nodes:
            break
    return tree


def _mean_and_spread(rows: DataFrame) -> tuple[float | None, float]:
    """Mean of ``y`` from an exact sum, so that it does not depend on the order of rows, and the largest distance from it."""
    lo, hi = rows.agg(F.min("y"), F.max("y")).first()
    if lo is None:
        return None, 0.0
    unit = 2.0 ** (max(np.frexp([lo, hi])[1]) - 52)
    total, n = rows.agg(F.sum(F.rint(F.col("y") / unit).cast("decimal(20,0)")), F.count("y")).first()
    mean = float(total) * unit / n
    return mean, max(hi - mean, mean - lo) if hi > lo else 0.0


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class _BoostParams(HasInputCols):
    labelCol = Param(Params._dummy(), "labelCol", "Column to predict.", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "Output column.", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "Number of trees.", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "Depth of a tree.", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "Most bin edges per input (at most 253).", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "Share of a leaf's value that is added.", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "Rows of residual 0 added to every node (L2 penalty).", TypeConverters.toFloat)
    minRows = Param(Params._dummy(), "minRows", "Least rows of a child.", TypeConverters.toInt)
    storeEvery = Param(Params._dummy(), "storeEvery", "Trees between two stored margins.", TypeConverters.toInt)
    baseScore = Param(Params._dummy(), "baseScore", "Mean label of the fitted rows.", TypeConverters.toFloat)

    def _boost_defaults(self) -> None:
        self._setDefault(inputCols=[], predictionCol="prediction", maxIter=100, maxDepth=5, maxBins=32, learningRate=0.1,
                         regLambda=1.0, minRows=1, storeEvery=10, baseScore=0.0)


class HistBoost(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``HistBoostModel`` (see the module's text)."""

    def __init__(self, inputCols=None, labelCol=None, predictionCol=None, maxIter=None, maxDepth=None, maxBins=None,
                 learningRate=None, regLambda=None, minRows=None, storeEvery=None):
        super().__init__()
        self._boost_defaults()
        self._set_from(inputCols=inputCols, labelCol=labelCol, predictionCol=predictionCol, maxIter=maxIter, maxDepth=maxDepth,
                       maxBins=maxBins, learningRate=learningRate, regLambda=regLambda, minRows=minRows, storeEvery=storeEvery)

    def _fit(self, df: DataFrame) -> HistBoostModel:
        spark, cols, max_bins = df.sparkSession, self.get("inputCols"), self.get("maxBins")
        if not 1 <= max_bins <= 253:
            raise ValueError(f"maxBins must be between 1 and 253, not {max_bins}")
        depth, every = self.get("maxDepth"), self.get("storeEvery")
        names = [f"x{j}" for j in range(len(cols))]
        typed = df.select(F.col(self.get("labelCol")).cast("double").alias("y"), *[F.col(c).cast("double").alias(x) for c, x in zip(cols, names)])
        rows = stored_parquet(typed.where(F.abs("y") < F.lit(float("inf"))), "boost-input")
        base, spread = _mean_and_spread(rows)
        if base is None:
            raise ValueError(f"no row has a label in {self.get('labelCol')!r}")
        forest = Forest.empty(quantile_edges(rows, names, max_bins), max_bins, depth)

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    some = batch.slice(at, BLOCK_ROWS)
                    yield _block(_doubles(some, 0, 1)[:, 0], np.zeros(some.num_rows), forest.bins(_doubles(some, 1, len(cols))))

        kept = scratch_path(spark, "boost-rows")
        # Levels cost CPU, not reading: the blocks are spread over all cores once (the count is of footers).
        parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // PART_ROWS))
        rows.mapInArrow(binned, _BLOCK).repartition(parts).write.parquet(kept)
        rows, newer = spark.read.parquet(kept), Forest.empty(forest.edges, max_bins, depth)
        unit = spread / float(1 << 30)
        for i in range(self.get("maxIter") if spread > 0 and cols else 0):
            tree = _grow(rows, newer, depth, base, unit, self.get("learningRate"), self.get("regLambda"), self.get("minRows"))
            if (tree.feature < 0).all():
                break                                   # nothing gains any more, nor will it later
            forest, newer = forest.plus(tree), newer.plus(tree)
            if len(newer.feature) == every and i + 1 < self.get("maxIter"):
                older, kept = kept, scratch_path(spark, "boost-rows")
                self._moved(rows, newer).write.parquet(kept)
                rows, newer = spark.read.parquet(kept), Forest.empty(forest.edges, max_bins, depth)
                _delete(spark, older)
        _delete(spark, kept)
        model = HistBoostModel(forest=forest)
        model._set(baseScore=float(base))
        return self._copyValues(model)

    @staticmethod
    def _moved(rows: DataFrame, newer: Forest) -> DataFrame:
        """The stored blocks with the newer trees added to their margins."""
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for y, margin, bins in _blocks(batch, len(newer.edges)):
                    yield _block(y, margin + newer.margin(bins), bins)

        return rows.select("y", "margin", "bins").mapInArrow(add, _BLOCK)


class HistBoostModel(Model, _BoostParams, MLWritable, MLReadable):
    """Boosted trees as an ML stage: appends the prediction; needs the inputs, not the label.

    Saved as the usual JSON metadata plus Parquet tables of nodes and of bin edges.
    """

    def __init__(self, forest: Forest | None = None):
        super().__init__()
        self._boost_defaults()
        self.forest = forest

    def write(self) -> MLWriter:
        return _BoostWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BoostReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, out, base = self.get("inputCols"), self.get("predictionCol"), self.get("baseScore")
        if not cols:
            return df.withColumn(out, F.lit(base))
        forest = df.sparkSession.sparkContext.broadcast(self.forest)
        fields = [f for f in df.schema.fields if f.name != out]
        inputs = [F.col(c).cast("double").alias(f"__x{j}") for j, c in enumerate(cols)]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    y = base + forest.value.margin(forest.value.bins(_doubles(batch, len(fields), len(cols))))
                    yield pa.RecordBatch.from_arrays([*batch.columns[:len(fields)], pa.array(y)], names=[*[f.name for f in fields], out])

        schema = T.StructType([*fields, T.StructField(out, T.DoubleType())])
        return df.select(*[f.name for f in fields], *inputs).mapInArrow(score, schema)


class _BoostWriter(MLWriter):
    def __init__(self, instance: HistBoostModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark, forest = self.sparkSession, self.instance.forest
        DefaultParamsWriter.saveMetadata(self.instance, path, spark,
                                         extraMetadata={"heap": int(forest.feature.shape[1]), "trees": len(forest.feature)})
        nodes = [(t, i, int(forest.feature[t, i]), int(forest.split[t, i]), bool(forest.missing_left[t, i]), float(forest.value[t, i]))
                 for t in range(len(forest.feature)) for i in range(1, forest.feature.shape[1])
                 if forest.feature[t, i] >= 0 or forest.value[t, i] != 0]
        spark.createDataFrame(nodes, "tree int, node int, feature int, split int, missing_left boolean, value double").coalesce(1) \
            .write.parquet(f"{path}/nodes")
        edges = [(j, float(e)) for j, es in enumerate(forest.edges) for e in es]
        spark.createDataFrame(edges, "feature int, edge double").coalesce(1).write.parquet(f"{path}/edges")


class _BoostReader(MLReader):
    def __init__(self, cls: type[HistBoostModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> HistBoostModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        edges: list[list[float]] = [[] for _ in model.get("inputCols")]
        for r in spark.read.parquet(f"{path}/edges").orderBy("feature", "edge").collect():
            edges[r["feature"]].append(r["edge"])
        depth = metadata["heap"].bit_length() - 2
        forest = Forest.empty([np.asarray(e, float) for e in edges], model.get("maxBins"), depth, metadata["trees"])
        for r in spark.read.parquet(f"{path}/nodes").collect():
            for name in ("feature", "split", "missing_left", "value"):
                getattr(forest, name)[r["tree"], r["node"]] = r[name]
        model.forest = forest
        return model
