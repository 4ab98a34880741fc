"""Spark's ``GBTRegressor`` trained on blocks of binned rows.

``BlockGBTRegressor`` is the same estimator (same params, same algorithm, a Spark ``GBTRegressionModel`` as its result);
only the training loop is another.  Spark's own spends over a microsecond on every row and level, 500 times for 100
trees of depth 5.  Here:

1. Label and features are stored.  The thresholds are chosen as Spark's trees choose them, from the same sample (of
   about ``SAMPLE_ROWS`` rows, read from the input itself; all stored rows, if they are no more).
2. Values become bins.  Inputs are packed into joint codes of at most ``CELLS`` values (two inputs of 32 bins, ten of two),
   so one count over a code serves several inputs; its sums over the other inputs are each input's histogram.  Rows are
   stored in blocks of up to ``BLOCK_ROWS``, a block being one record of byte strings: what is left of the labels, and the codes.
3. A tree level is one Spark job of one stage: every task adds its rows to the histograms of the level's nodes and returns
   them as one row (about 10 kB per node for 36 inputs); the driver adds them up and picks the splits.  Only the smaller
   child of a split is counted, the other one is the parent less it.  Every ``STORE_EVERY`` trees the blocks are stored
   anew and the older copy is deleted; in between, tasks apply the newer trees.
4. Up to ``LOCAL_ROWS`` rows one task does the same on blocks in its memory, without a job per level.

Labels are added as integers (2 ** -32 of twice the largest label), exactly, so trees do not depend on partitioning, on
the order of additions, on reruns or on where they are grown.

What this loop has no code for goes to Spark's own: weights, a validation column, other losses, subsampling, subsets of
inputs, categorical inputs, depths over ``DEPTH``, more bins than ``BINS``, and rows that Spark refuses.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagoon.operators.boost import _delete
from lagoon.session import scratch_path

BLOCK_ROWS = 16_384
CELLS = 1024
DEPTH = 8
BINS = 256
LOCAL_ROWS = 2_000_000
STORE_EVERY = 2
STORED_ROWS = 2_000_000      # of a file of blocks, at most
SAMPLE_ROWS = 10_000
LABEL_BITS = 32
_BLOCK = "left binary, codes binary"
_SUMS = "sums binary, counts binary, squares binary"
_NODE = "tree int, node int, feature int, threshold double, gain double, n long, total double, squares double"

#: Of a node of a tree: input (-1: a leaf), bin, gain, rows, sum of labels.  A tree maps heap indices (root 1) to nodes.
Node = tuple[int, int, float, int, int]
Tree = dict[int, Node]


def thresholds(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Rising thresholds of one input from sampled values, as Spark's trees choose them.

    ``expected`` is the number of rows the sample stands for; what it has beyond the values other than 0 is taken as zeros.
    """
    values = values[values != 0]
    distinct, counts = np.unique(values, return_counts=True)
    counts, zeros = counts.astype(np.float64), expected - len(values)
    if zeros > np.finfo(float).eps * len(values) * 100:
        at = np.searchsorted(distinct, 0.0)
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, zeros)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride, out, seen = expected / (most + 1), [], counts[0]
    target = stride
    for middle, count in zip(middles, counts[1:], strict=True):
        before, seen = seen, seen + count
        if abs(before - target) < abs(seen - target):
            out.append(middle)
            target += stride
    return np.asarray(out)


def packed(widths: Sequence[int], cells: int = CELLS) -> list[list[int]]:
    """Inputs of two bins or more in groups whose joint code has at most ``cells`` values (one input may exceed it)."""
    groups: list[list[int]] = []
    for j in sorted((j for j, w in enumerate(widths) if w > 1), key=lambda j: (-widths[j], j)):
        for group in groups:
            if int(np.prod([widths[i] for i in group])) * widths[j] <= cells:
                group.append(j)
                break
        else:
            groups.append([j])
    return groups


@dataclass
class Layout:
    """Thresholds of all inputs, and how their bins are packed into codes."""

    edges: list[np.ndarray]
    widths: list[int] = field(init=False)
    groups: list[list[int]] = field(init=False)
    known: dict[tuple[int, int], tuple[int, np.ndarray]] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.widths = [len(e) + 1 for e in self.edges]
        self.groups = packed(self.widths)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Joint codes, groups x rows, of a rows x inputs array."""
        out = np.zeros((len(self.groups), len(x)), np.uint16)
        for g, group in enumerate(self.groups):
            for j in group:
                out[g] = out[g] * self.widths[j] + np.searchsorted(self.edges[j], x[:, j], side="left").astype(np.uint16)
        return out

    def shape(self, g: int) -> tuple[int, ...]:
        return tuple(self.widths[j] for j in self.groups[g])

    def bins(self, g: int, j: int) -> np.ndarray:
        """The bin of input ``j`` for every value of code ``g``."""
        return np.indices(self.shape(g))[self.groups[g].index(j)].ravel()

    def right(self, j: int, at: int) -> tuple[int, np.ndarray]:
        """The group of input ``j``, and for every value of its code whether the bin lies above ``at``."""
        if (j, at) not in self.known:
            g = next(g for g, group in enumerate(self.groups) if j in group)
            self.known[j, at] = g, self.bins(g, j) > at
        return self.known[j, at]

    def inputs(self) -> list[int]:
        return sorted(j for group in self.groups for j in group)

    def per_input(self, counted: list[np.ndarray]) -> np.ndarray:
        """Nodes x bins of all inputs (in their order) from nodes x cells of every group."""
        found = {}
        for g, cells in enumerate(counted):
            cells = cells.reshape(len(cells), *self.shape(g))
            for axis, j in enumerate(self.groups[g], 1):
                found[j] = cells.sum(axis=tuple(a for a in range(1, cells.ndim) if a != axis))
        return np.hstack([found[j] for j in self.inputs()])


@dataclass
class Task:
    """What training needs besides the rows."""

    layout: Layout
    trees: int
    depth: int
    rate: float
    unit: float
    least: int
    least_gain: float

    def weight(self, t: int) -> float:
        return self.rate if t else 1.0


class _Block:
    """Rows in a task: what is left of their labels, codes, and the rows that reach the nodes of a tree."""

    def __init__(self, left: np.ndarray, codes: np.ndarray):
        self.left, self.codes = left, codes
        self.label = left
        self.rows: dict[int, np.ndarray] = {}

    def begin(self, t: int, unit: float) -> None:
        """Labels of tree ``t`` in units: the first fits the labels themselves, later ones the negative gradient."""
        self.label = np.rint((2.0 * self.left if t else self.left) / unit)
        self.rows = {1: np.arange(len(self.left))}

    def divide(self, k: int, layout: Layout, node: Node, wanted: set[int] | None = None) -> None:
        """Hand the rows of node ``k`` to its children (only to those in ``wanted``, if given)."""
        g, to_right = layout.right(node[0], node[1])
        rows = self.rows.pop(k)
        right = to_right.take(self.codes[g].take(rows))
        for child, side in ((2 * k, False), (2 * k + 1, True)):
            if wanted is None or child in wanted:
                self.rows[child] = rows.take(np.flatnonzero(right if side else ~right))

    def finish(self, t: int, tree: Tree, task: Task) -> np.ndarray:
        """Take the finished tree's values off; the sums of squared labels of its leaves (rising heap index)."""
        leaves = [k for k in sorted(tree) if tree[k][0] < 0]
        squares, step = np.zeros(len(leaves)), np.empty(len(self.left))
        for i, k in enumerate(leaves):
            rows = self.rows[k]
            label = self.label.take(rows)
            squares[i] = label @ label
            step[rows] = task.weight(t) * (tree[k][4] * task.unit / tree[k][3])
        self.left = self.left - step
        return squares


def _counted(blocks: Iterator[_Block], nodes: list[int], layout: Layout, with_counts: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums of labels and numbers of rows (or none), nodes x bins, of a task's blocks."""
    cells = [int(np.prod(layout.shape(g))) for g in range(len(layout.groups))]
    sums = [np.zeros((len(nodes), c), np.int64) for c in cells]
    counts = [np.zeros((len(nodes), c), np.int64) for c in cells]
    for b in blocks:
        parts = [b.rows[k] for k in nodes]
        whole = nodes == [1]
        rows = parts[0] if whole else np.concatenate(parts)
        if not len(rows):
            continue
        label = b.label if whole else b.label.take(rows)
        # bincount adds doubles: exact where no sum can reach 2 ** 53.
        if np.abs(label).max() * len(label) >= 1 << 53:
            raise OverflowError("what is left of the labels exceeds them")
        slot = None if whole else np.repeat(np.arange(len(nodes)), [len(p) for p in parts])
        for g, c in enumerate(cells):
            at = b.codes[g] if whole else np.add(b.codes[g].take(rows), slot * c, dtype=np.int64)
            sums[g] += np.bincount(at, label, len(nodes) * c).astype(np.int64).reshape(-1, c)
            if with_counts:
                counts[g] += np.bincount(at, minlength=len(nodes) * c).reshape(-1, c)
    return layout.per_input(sums), layout.per_input(counts) if with_counts else np.zeros((0, 0), np.int64)


def best_split(s: np.ndarray, n: np.ndarray, widths: Sequence[int], least: int = 1, least_gain: float = 0.0, unit: float = 1.0) -> tuple | None:
    """The split of largest variance gain from sums and counts of a node's bins, all inputs one after the other.

    Ties go to the smaller input, then bin.  (input's place, bin, gain, n left, sum left), or None where nothing gains.
    """
    starts = np.concatenate([[0], np.cumsum(widths)])[:-1]
    place = np.repeat(np.arange(len(widths)), widths)
    n_all, s_all = int(n[:widths[0]].sum()), int(s[:widths[0]].sum())
    n_cum, s_cum = np.cumsum(n), np.cumsum(s)
    n_left = n_cum - (n_cum - n)[starts][place]
    s_left = s_cum - (s_cum - s)[starts][place]
    n_right = n_all - n_left
    ok = (n_left >= least) & (n_right >= least)
    ok[starts + np.asarray(widths) - 1] = False
    near, far = s_left.astype(np.float64) * n_all, n_left.astype(np.float64) * s_all
    gap = near - far
    gap[np.abs(gap) <= 1e-14 * (np.abs(near) + np.abs(far))] = 0.0
    with np.errstate(invalid="ignore", divide="ignore"):      # 0 / 0 in empty children, left out
        gain = np.where(ok, (gap * unit / n_all) ** 2 / (n_left.astype(np.float64) * n_right), -1.0)
    at = int(gain.argmax())
    if not (gain[at] > 0 and gain[at] >= least_gain):
        return None
    return int(place[at]), int(at - starts[place[at]]), float(gain[at]), int(n_left[at]), int(s_left[at])


class _Local:
    """Rows of one task, in its memory."""

    def __init__(self, blocks: list[_Block], task: Task):
        self.blocks, self.task, self.squares = blocks, task, np.zeros(0)

    def begin(self, t: int, with_counts: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        for b in self.blocks:
            b.begin(t, self.task.unit)
        return *_counted(self.blocks, [1], self.task.layout, with_counts), self.squares

    def level(self, t: int, tree: Tree, split: list[int], wanted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        for b in self.blocks:
            for k in split:
                b.divide(k, self.task.layout, tree[k])
        return _counted(self.blocks, wanted, self.task.layout, True)

    def end(self, t: int, tree: Tree, split: list[int]) -> None:
        for b in self.blocks:
            for k in split:
                b.divide(k, self.task.layout, tree[k])
        self.squares = sum((b.finish(t, tree, self.task) for b in self.blocks), np.zeros(sum(v[0] < 0 for v in tree.values())))

    def last_squares(self) -> np.ndarray:
        return self.squares


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            left, codes = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in enumerate((np.float64, np.uint16)))
            yield _Block(left, codes.reshape(-1, len(left)))


def _caught_up(b: _Block, newer: list[tuple[int, Tree]], task: Task) -> np.ndarray:
    """Take the newer trees off a stored block; the leaves' squares of the last one."""
    squares = np.zeros(0)
    for t, tree in newer:
        b.begin(t, task.unit)
        for k in sorted(tree):
            if tree[k][0] >= 0:
                b.divide(k, task.layout, tree[k])
        squares = b.finish(t, tree, task)
    return squares


def _level(task: Task, newer: list[tuple[int, Tree]], t: int, tree: Tree, wanted: list[int], with_counts: bool):
    """One row of a task: the histograms of the wanted nodes of tree ``t``, and the leaves' squares of the last newer tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = np.zeros(sum(v[0] < 0 for v in newer[-1][1].values()) if newer else 0)
        above = {k >> i for k in wanted for i in range(k.bit_length())}

        def blocks() -> Iterator[_Block]:
            for b in _blocks_of(batches):
                np.add(squares, _caught_up(b, newer, task), out=squares)
                if wanted:
                    b.begin(t, task.unit)
                    for k in sorted(above - set(wanted)):
                        b.divide(k, task.layout, tree[k], above)
                    yield b

        sums, counts = _counted(blocks(), wanted, task.layout, with_counts)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (sums, counts, squares)], names=["sums", "counts", "squares"])
    return run


class _Stored:
    """Rows in stored blocks, a job per level."""

    def __init__(self, spark: SparkSession, path: str, task: Task):
        self.spark, self.path, self.task = spark, path, task
        self.rows, self.newer = spark.read.parquet(path), []

    def _job(self, t: int, tree: Tree, wanted: list[int], with_counts: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = self.rows.mapInArrow(_level(self.task, self.newer, t, tree, wanted, with_counts), _SUMS).toArrow()
        parts = [[np.frombuffer(x.as_buffer(), kind) for x in got[c]] for c, kind in (("sums", np.int64), ("counts", np.int64), ("squares", np.float64))]
        sums, counts, squares = (np.sum(p, axis=0) for p in parts)
        if wanted:
            sums = sums.reshape(len(wanted), -1)
        return sums, counts.reshape(sums.shape) if with_counts else counts, squares

    def begin(self, t: int, with_counts: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._job(t, {}, [1], with_counts)

    def level(self, t: int, tree: Tree, split: list[int], wanted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        return self._job(t, tree, wanted, True)[:2]

    def end(self, t: int, tree: Tree, split: list[int]) -> None:
        if len(self.newer) == STORE_EVERY:
            newer, task = self.newer, self.task

            def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in _blocks_of(batches):
                    _caught_up(b, newer, task)
                    yield _record(b.left, b.codes)

            older, self.path = self.path, scratch_path(self.spark, "gbt-rows")
            _write(self.rows.mapInArrow(moved, _BLOCK), self.path)
            self.rows, self.newer = self.spark.read.parquet(self.path), []
            _delete(self.spark, older)
        self.newer = [*self.newer, (t, tree)]

    def last_squares(self) -> np.ndarray:
        return self._job(self.task.trees, {}, [], False)[2]


def grown(rows: _Local | _Stored, task: Task) -> Iterator[tuple[Tree, list[float]]]:
    """The trees, one after the other, with the sums of squared labels of their leaves (rising heap index)."""
    inputs = task.layout.inputs()
    widths = [task.layout.widths[j] for j in inputs]
    root_counts, before = None, None
    for t in range(task.trees):
        s, n, squares = rows.begin(t, root_counts is None)
        if root_counts is None:
            root_counts = n
        if before is not None:
            yield before, squares.tolist()
        hist = {1: (s[0], root_counts[0])}
        tree: Tree = {1: (-1, 0, -1.0, int(root_counts[0][:widths[0]].sum()), int(s[0][:widths[0]].sum()))}
        live = [1]
        for level in range(task.depth):
            split, wanted = [], []
            for k in live:
                found = best_split(*hist[k], widths, task.least, task.least_gain, task.unit)
                if found is None:
                    continue
                place, at, gain, n_left, s_left = found
                _, _, _, n_all, s_all = tree[k]
                tree[k] = (inputs[place], at, gain, n_all, s_all)
                tree[2 * k], tree[2 * k + 1] = (-1, 0, -1.0, n_left, s_left), (-1, 0, -1.0, n_all - n_left, s_all - s_left)
                split.append(k)
                wanted.append(2 * k + (2 * n_left > n_all))
            if not split or level == task.depth - 1:
                break
            s, n = rows.level(t, tree, split, wanted)
            for i, k in enumerate(wanted):
                whole = hist.pop(k // 2)
                hist[k], hist[k ^ 1] = (s[i], n[i]), (whole[0] - s[i], whole[1] - n[i])
            live = [child for k in split for child in (2 * k, 2 * k + 1)]
        rows.end(t, tree, split)
        before = tree
    yield before, rows.last_squares().tolist()


def _nodes(trees: Iterator[tuple[Tree, list[float]]], task: Task) -> Iterator[tuple]:
    """Rows ``_NODE`` of all trees, labels in their own units."""
    for t, (tree, leaf_squares) in enumerate(trees):
        squares = dict(zip((k for k in sorted(tree) if tree[k][0] < 0), leaf_squares, strict=True))
        for k in sorted(tree, reverse=True):
            if tree[k][0] >= 0:
                squares[k] = squares[2 * k] + squares[2 * k + 1]
        for k, (j, at, gain, n, s) in tree.items():
            threshold = float(task.layout.edges[j][at]) if j >= 0 else 0.0
            yield t, k, j, threshold, gain, n, s * task.unit, squares[k] * task.unit ** 2


def _in_one_task(task: Task):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The buffers of a batch are used again for the next one.
        blocks = [_Block(b.left.copy(), b.codes.copy()) for b in _blocks_of(batches)]
        names, types = zip(*[c.split() for c in _NODE.split(", ")], strict=True)
        arrow = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
        columns = zip(*_nodes(grown(_Local(blocks, task), task), task), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, arrow[x]) for c, x in zip(columns, types, strict=True)], names=names)
    return run


def _record(left: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (left, codes)], names=["left", "codes"])


def _write(blocks: DataFrame, path: str) -> None:
    """Bins do not compress; readers hold a row group at once."""
    blocks.write.option("compression", "uncompressed").option("parquet.block.size", 32 << 20).parquet(path)


def _binned(layout: Layout, width: int):
    """Stored rows (y, x) as blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            kept.append((batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64), layout.codes(x)))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                y, codes = np.concatenate([k[0] for k in kept]), np.hstack([k[1] for k in kept])
                for at in range(0, n - BLOCK_ROWS + 1, BLOCK_ROWS):
                    yield _record(y[at:at + BLOCK_ROWS], codes[:, at:at + BLOCK_ROWS])
                done = n - n % BLOCK_ROWS
                kept, n = [(y[done:], codes[:, done:])], n - done
        if n:
            yield _record(np.concatenate([k[0] for k in kept]), np.hstack([k[1] for k in kept]))
    return run


def _nested(nodes: dict[int, tuple]) -> list[tuple]:
    """Rows of Spark's model format, numbered in preorder, of a tree given by heap index."""
    order, todo = [], [1]
    while todo:
        k = todo.pop()
        order.append(k)
        if nodes[k][0] >= 0:
            todo += [2 * k + 1, 2 * k]
    number = {k: i for i, k in enumerate(order)}
    out = []
    for k in order:
        j, threshold, gain, n, total, squares = nodes[k]
        leaf = j < 0
        impurity = max(0.0, (squares - total * total / n) / n)
        out.append((number[k], total / n, impurity, [float(n), total, squares], n, gain, -1 if leaf else number[2 * k],
                    -1 if leaf else number[2 * k + 1], (j, [] if leaf else [threshold], -1)))
    return out


class BlockGBTRegressor(GBTRegressor):
    """``GBTRegressor`` with the training loop of this module; saved, it is a plain ``GBTRegressor``."""

    def _own_loop(self, dataset: DataFrame) -> bool:
        get = self.getOrDefault
        attributes = dataset.schema[get("featuresCol")].metadata.get("ml_attr", {}).get("attrs", {})
        return (not self.isDefined("weightCol") and not self.isDefined("validationIndicatorCol") and get("lossType") == "squared"
                and get("subsamplingRate") == 1.0 and get("featureSubsetStrategy") == "all" and get("minWeightFractionPerNode") == 0.0
                and get("impurity") == "variance" and 1 <= get("maxDepth") <= DEPTH and get("maxBins") <= BINS
                and not attributes.get("nominal") and not attributes.get("binary"))

    def _fit(self, dataset: DataFrame):
        if not self._own_loop(dataset):
            return super()._fit(dataset)
        get, spark = self.getOrDefault, dataset.sparkSession
        path = scratch_path(spark, "gbt-input")
        dataset.select(F.col(get("labelCol")).cast("double").alias("y"), vector_to_array(get("featuresCol")).alias("x")).write.parquet(path)
        try:
            trees, width = self._trees(dataset, spark.read.parquet(path))
        finally:
            _delete(spark, path)
        return self._copyValues(self._model(spark, trees, width)) if trees else super()._fit(dataset)

    def _sampled(self, dataset: DataFrame, share: float) -> DataFrame:
        """The rows that Spark's fit samples for its thresholds: drawn by partition, so from the dataset as it is laid out."""
        spark = dataset.sparkSession
        rows = dataset.select(F.col(self.getOrDefault("labelCol")).alias("y"), vector_to_array(self.getOrDefault("featuresCol")).alias("x"))._jdf
        seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(self.getOrDefault("seed")).nextInt()
        return DataFrame(spark._jsparkSession.createDataFrame(rows.rdd().sample(False, share, seed), rows.schema()), spark).select("x")

    def _trees(self, dataset: DataFrame, stored: DataFrame) -> tuple[list[dict[int, tuple]], int]:
        """Nodes by heap index of every tree, and the number of inputs; no trees for rows that are left to Spark."""
        get, inf, spark = self.getOrDefault, float("inf"), dataset.sparkSession
        refused = (F.col("y").isNull() | F.isnan("y") | (F.abs("y") == inf) | F.col("x").isNull() | F.isnan(F.array_max("x"))
                   | (F.array_max("x") == inf) | (F.array_min("x") == -inf))
        n, bad, largest, width, widest = stored.agg(
            F.count(F.lit(1)), F.sum(F.coalesce(refused, F.lit(True)).cast("long")), F.max(F.abs("y")), F.min(F.size("x")), F.max(F.size("x"))).first()
        if not n or bad or width != widest:
            return [], 0                                       # Spark's fit names what is wrong
        share = min(1.0, max(get("maxBins") ** 2, SAMPLE_ROWS) / n)
        sampled = stored.select("x") if share == 1.0 else self._sampled(dataset, share)
        x = np.asarray(sampled.toArrow()["x"].combine_chunks().flatten()).reshape(-1, width)
        layout = Layout([thresholds(x[:, j], share * n, min(get("maxBins"), n) - 1) for j in range(width)])
        if not layout.groups:
            return [], 0                                       # constant inputs
        task = Task(layout, get("maxIter"), get("maxDepth"), get("stepSize"), max(2.0 * largest, 1e-300) / (1 << LABEL_BITS),
                    get("minInstancesPerNode"), get("minInfoGain"))
        blocks = stored.mapInArrow(_binned(layout, width), _BLOCK)
        if n <= LOCAL_ROWS:
            nodes = blocks.repartition(1).mapInArrow(_in_one_task(task), _NODE).collect()
        else:
            path = scratch_path(spark, "gbt-rows")
            _write(blocks.repartition(max(spark.sparkContext.defaultParallelism, -(-n // STORED_ROWS))), path)
            rows = _Stored(spark, path, task)
            nodes = list(_nodes(grown(rows, task), task))
            _delete(spark, rows.path)
        trees: list[dict[int, tuple]] = [{} for _ in range(get("maxIter"))]
        for t, k, *rest in nodes:
            trees[t][k] = tuple(rest)
        return trees, width

    def _model(self, spark: SparkSession, trees: list[dict[int, tuple]], width: int) -> GBTRegressionModel:
        """Spark's model of the trees, through the form in which Spark saves models."""
        path = scratch_path(spark, "gbt-model")
        given, usual = ({p.name: v for p, v in params.items()} for params in (self._paramMap, self._defaultParamMap))
        of_tree = {p.name for p in DecisionTreeRegressor().params} - {"varianceCol"}

        def about(name: str, uid: str, **more) -> str:
            kept = [{k: v for k, v in x.items() if "GBT" in name or k in of_tree} for x in (given, usual)]
            return json.dumps({"class": f"org.apache.spark.ml.regression.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                               "uid": uid, "paramMap": kept[0], "defaultParamMap": kept[1], **more})

        texts = spark.createDataFrame([(about("GBTRegressionModel", self.uid, numFeatures=width, numTrees=len(trees)),)], "value string")
        texts.coalesce(1).write.text(f"{path}/metadata")
        split = "struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>"
        node = (f"struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
                f"leftChild:int,rightChild:int,split:{split}>")
        rows = [(t, row) for t, nodes in enumerate(trees) for row in _nested(nodes)]
        spark.createDataFrame(rows, f"treeID int, nodeData {node}").coalesce(1).write.parquet(f"{path}/data")
        rates = [1.0, *[self.getOrDefault("stepSize")] * (len(trees) - 1)]
        rows = [(t, about("DecisionTreeRegressionModel", f"{self.uid}_{t}", numFeatures=width), rate) for t, rate in enumerate(rates)]
        spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        return GBTRegressionModel.load(path)
