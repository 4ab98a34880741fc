"""Nearest neighbours by a forest of random-projection trees and one shared priority queue.

1. Identical vectors form one class; a class keeps its ``k + 1`` smallest ids,
   which is all that ranking by (score, id) can ever show.
2. ``TREES`` trees are fitted on a bounded, hash-ordered sample of at most
   ``SAMPLE`` vectors: a node splits at the median of the projection on a
   direction drawn from two centres of random points.  The trees are broadcast
   (their size is bounded by the sample); every class is placed in one leaf per tree.
3. A query walks all trees through one priority queue ordered by the sum of
   squared margins of the splits it crossed, until ``PROBE`` times the leaves of
   one tree were taken.
4. Vectors and queries meet per block of neighbouring leaves.  Each block's
   candidates are ranked by exact double-precision inner product (all that the
   rounding of a matrix product leaves in question are summed again in component order, those of
   many queries at once); a block sends its ``k + 1`` best per query, and these
   partial lists are merged per query by one sort, which brings repeats together.

Recall depends on ``PROBE`` (the README has measured figures); scores are exact.

Nulls and edges: rows with a null id, a null or empty vector, a null or
non-finite component, or only zeros take no part, nor do vectors whose length
is not the table's most frequent one; repeated rows are separate candidates
(a query leaves out its own id only); fewer than ``k`` others give fewer ranks;
empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagoon.llm.tables import stored

TREES, SAMPLE, LEAF, PROBE = 8, 50_000, 64, 1.25
BLOCK_ROWS = 8192
#: More than the relative rounding error of one addition or product in double and in single precision, and than what underflow loses.
SLACK, SLACK_SINGLE, TINY = 2.0 ** -51, 2.0 ** -22, 1e-37


class Tree:
    """Arrays of one tree: inner node i has a direction, an offset and two children (< 0: leaf ~child)."""

    def __init__(self, points: np.ndarray, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        normals, offsets, children, self.leaves = [], [], [], 0

        def grow(rows: np.ndarray) -> int:
            split = _split(points, rows, rng) if len(rows) > leaf else None
            if split is None:
                self.leaves += 1
                return ~(self.leaves - 1)
            me = len(normals)
            normals.append(split[0])
            offsets.append(split[1])
            children.append([0, 0])
            children[me] = [grow(split[2]), grow(split[3])]
            return me

        self.root = grow(np.arange(len(points)))
        width = points.shape[1] if points.ndim == 2 else 0
        self.normals = np.array(normals, np.float32).reshape(len(normals), width)
        self.offsets = np.array(offsets, np.float32)
        self.children = np.array(children, np.int64).reshape(len(children), 2)
        self.child_pairs = self.children.tolist()

    def place(self, vectors: np.ndarray) -> np.ndarray:
        at = np.full(len(vectors), self.root, np.int64)
        live = np.flatnonzero(at >= 0)
        while len(live):
            node = at[live]
            right = np.einsum("ij,ij->i", vectors[live], self.normals[node]) > self.offsets[node]
            at[live] = self.children[node, right.astype(np.int64)]
            live = live[at[live] >= 0]
        return ~at


def _split(points: np.ndarray, rows: np.ndarray, rng: np.random.Generator):
    few = rows if len(rows) <= 512 else rng.choice(rows, 512, replace=False)
    one, two = points[rng.choice(few, 2, replace=False)]
    for _ in range(4):
        side = points[few] @ (one - two) > (one + two) @ (one - two) / 2
        if side.all() or not side.any():
            break
        one, two = points[few[side]].mean(axis=0), points[few[~side]].mean(axis=0)
    normal = (one - two) / (np.linalg.norm(one - two) or 1.0)
    at = points[rows] @ normal
    middle = np.float32(np.median(at))
    right = at > middle
    if right.all() or not right.any():
        return None
    return normal, middle, rows[~right], rows[right]


def leaves_of(forest: list[Tree], query: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """The first ``wanted`` leaves (tree, leaf) of the shared priority queue."""
    margins = [(t.normals @ query - t.offsets).tolist() for t in forest]
    children = [t.child_pairs for t in forest]
    queue = [(0.0, i, t.root) for i, t in enumerate(forest)]
    heapq.heapify(queue)
    out = []
    while queue and len(out) < wanted:
        far, i, node = heapq.heappop(queue)
        while node >= 0:
            m = margins[i][node]
            left, right = children[i][node]
            node, other = (right, left) if m > 0 else (left, right)
            heapq.heappush(queue, (far + m * m, i, other))
        out.append((i, ~node))
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in component order in double precision."""
    total = np.zeros(len(a))
    for j in range(a.shape[1] if a.ndim == 2 else 0):
        total += a[:, j].astype(np.float64) * b[:, j].astype(np.float64)
    return total


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    if not n:
        return np.zeros((0, 0), np.float32)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(n, -1)


def _place(forest, per_block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"), batch.num_rows)
            for i, tree in enumerate(trees):
                leaf = tree.place(vectors)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(leaf), i)), pa.array(leaf // per_block), pa.array(leaf), batch.column("class"),
                     batch.column("vector")], names=["tree", "block", "leaf", "class", "vector"])
    return run


class Probes:
    """The first ``wanted`` leaves of ``leaves_of`` for many queries at once.

    The queue yields leaves in rising order of their sums, so its first ones are those of the smallest sums, which
    are formed for all leaves level by level, with the same additions.  Where the last sum taken is also the
    next one's, the queue itself decides.
    """

    def __init__(self, forest: list[Tree], wanted: int):
        self.forest, self.wanted = forest, wanted
        nodes = np.concatenate([[0], np.cumsum([len(t.normals) for t in forest])])
        self.leaf_base = np.concatenate([[0], np.cumsum([t.leaves for t in forest])])
        # Inner nodes of all trees are numbered on; leaves follow them.
        children = [np.where(t.children >= 0, t.children + n, nodes[-1] + base + ~t.children)
                    for t, n, base in zip(forest, nodes, self.leaf_base)]
        self.children, self.inner = np.concatenate(children), int(nodes[-1])
        self.roots = np.array([n + t.root if t.root >= 0 else self.inner + base + ~t.root
                               for t, n, base in zip(forest, nodes, self.leaf_base)], np.int64)
        self.levels, level = [], self.roots[self.roots < self.inner]
        while len(level):
            self.levels.append(level)
            level = self.children[level].reshape(-1)
            level = level[level < self.inner]

    def __call__(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, tree, leaf), ordered."""
        margin = np.empty((self.inner, len(queries)))
        for r, query in enumerate(queries):
            margin[:, r] = np.concatenate([t.normals @ query - t.offsets for t in self.forest])
        far = np.zeros((self.inner + int(self.leaf_base[-1]), len(queries)))
        for level in self.levels:
            m, (left, right) = margin[level], self.children[level].T
            crossed = far[level] + m * m
            far[left] = np.where(m > 0, crossed, far[level])
            far[right] = np.where(m > 0, far[level], crossed)
        sums = far[self.inner:].T
        if self.wanted >= sums.shape[1]:
            taken = np.ones(sums.shape, dtype=bool)
        else:
            last = np.partition(sums, self.wanted - 1, axis=1)[:, self.wanted - 1]
            taken = sums <= last[:, None]
            for r in np.flatnonzero(taken.sum(axis=1) != self.wanted):
                taken[r] = False
                taken[r, [self.leaf_base[i] + leaf for i, leaf in leaves_of(self.forest, queries[r], self.wanted)]] = True
        row, at = np.nonzero(taken)
        tree = np.searchsorted(self.leaf_base, at, side="right") - 1
        return row, tree, at - self.leaf_base[tree]


def _probe(forest, per_block: int, wanted: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = Probes(forest.value, wanted)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"), batch.num_rows)
            for start in range(0, batch.num_rows, 256):
                row, tree, leaf = probes(vectors[start:start + 256])
                block = leaf // per_block
                new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(tree, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
                leaves = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(leaf, pa.int64()))
                at = pa.array(start + row[new], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree[new], pa.int64()), pa.array(block[new], pa.int64()), leaves,
                     batch.column("class").take(at), batch.column("vector").take(at)],
                    names=["tree", "block", "leaves", "query", "vector"])
    return run


def _rank(k: int):
    def run(near: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("query", pa.int64()), ("hits", pa.list_(pa.struct([("far", pa.float64()), ("class", pa.int64())])))])
        if not near.num_rows or not asked.num_rows:
            return schema.empty_table()
        vectors, names = _matrix(near.column("vector"), near.num_rows), near.column("class").to_numpy()
        queries, leaf = _matrix(asked.column("vector"), asked.num_rows), near.column("leaf").to_numpy()
        low, width = int(leaf.min()), int(leaf.max() - leaf.min()) + 1
        open_leaves = np.zeros((asked.num_rows, width), dtype=bool)
        lists = asked.column("leaves").combine_chunks()
        owner = np.repeat(np.arange(asked.num_rows), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten().to_numpy() - low
        inside = (flat >= 0) & (flat < width)
        open_leaves[owner[inside], flat[inside]] = True
        who, parts = asked.column("query").to_numpy(), []
        longest = np.linalg.norm(vectors.astype(np.float64), axis=1).max()
        lengths = np.linalg.norm(queries.astype(np.float64), axis=1)
        # Single precision is enough to leave out candidates, where no sum can overflow.
        kind, error = (np.float32, SLACK_SINGLE) if longest * lengths.max() < 1e30 else (np.float64, SLACK)
        turned = np.ascontiguousarray(vectors.T, kind)
        # Both sums of a product are off by at most ``slack``, whatever their order (the last term is for underflow).
        slack = error * vectors.shape[1] * (longest * lengths) + vectors.shape[1] * TINY
        take = min(k + 1, len(names))
        for start in range(0, len(queries), 128):
            some = queries[start:start + 128]
            opened = open_leaves[start:start + 128][:, leaf - low]
            rough = some.astype(kind) @ turned
            np.putmask(rough, ~opened, -np.inf)
            last = np.partition(rough, len(names) - take, axis=1)[:, len(names) - take].astype(np.float64)
            row, at = np.nonzero(opened & (rough >= (last - 4 * slack[start:start + 128])[:, None]))
            score = inner_products(some[row], vectors[at])
            order = np.lexsort((names[at], -score, row))
            row, at, score = row[order], at[order], score[order]
            shown = np.arange(len(row)) - np.searchsorted(row, row, side="left") <= k
            parts.append((np.bincount(row[shown], minlength=len(some)), -score[shown], names[at[shown]]))
        n, far, name = (np.concatenate(x) for x in zip(*parts))
        hits = pa.StructArray.from_arrays([pa.array(far), pa.array(name, pa.int64())], names=["far", "class"])
        ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        return pa.table([pa.array(who, pa.int64()), pa.ListArray.from_arrays(ends, hits)], schema=schema)
    return run


def _merge(k: int):
    def run(lists: pa.Table) -> pa.Table:
        hits = lists.column("hits").combine_chunks().flatten()
        far, name = hits.field("far").to_numpy(), hits.field("class").to_numpy()
        order = np.lexsort((name, far))
        far, name = far[order], name[order]
        new = np.ones(len(name), dtype=bool)
        new[1:] = name[1:] != name[:-1]                       # a class has the same score in all its leaves
        best = np.flatnonzero(new)[:k + 1]
        return pa.table({"query": lists.column("query").slice(0, 1).take(pa.array(np.zeros(len(best), np.int64))),
                         "class": pa.array(name[best], pa.int64()), "score": pa.array(-far[best], pa.float64())})
    return run


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("vector"))
    big = F.lit(float("inf"))
    fine = rows.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0)
                      & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
                      & F.exists("vector", lambda x: x != 0))
    usual = fine.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if usual is None:
        return spark.createDataFrame([], empty)
    fine = stored(fine.where(F.size("vector") == usual.n).withColumn("key", F.transform("vector", lambda x: x + F.lit(0.0).cast("float"))))
    classes = stored(fine.groupBy("key").agg(F.min("vec_id").alias("class")).select("class", F.col("key").alias("vector")))
    member = fine.join(classes.withColumnRenamed("vector", "key"), "key").select("class", "vec_id")
    first = Window.partitionBy("class").orderBy("vec_id")
    shown = member.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).select("class", "vec_id")
    asked = stored(member.where(F.col("vec_id") % every == 0).select("vec_id", "class"))

    total = classes.count()
    sample = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("vector").toArrow()
    points = _matrix(sample.column("vector"), sample.num_rows)
    trees = [Tree(points, max(8, round(LEAF * len(points) / max(total, 1))) if total > LEAF * 4 else max(8, total // 4), 17 + i)
             for i in range(TREES)]
    forest = spark.sparkContext.broadcast(trees)
    per_tree = max(t.leaves for t in trees)
    per_block = max(1, round(BLOCK_ROWS * per_tree / max(total, 1)))
    placed = classes.mapInArrow(_place(forest, per_block), "tree long, block long, leaf long, class long, vector array<float>")
    wanted = max(TREES, int(np.ceil(PROBE * per_tree)))
    queries = classes.join(asked.select("class").distinct(), "class", "left_semi")
    probes = queries.repartition(max(8, spark.sparkContext.defaultParallelism), "class").mapInArrow(
        _probe(forest, per_block, wanted), "tree long, block long, leaves array<long>, query long, vector array<float>")
    partial = placed.groupBy("tree", "block").cogroup(probes.groupBy("tree", "block")).applyInArrow(
        _rank(k), "query long, hits array<struct<far:double,class:bigint>>")
    hits = partial.groupBy("query").applyInArrow(_merge(k), "query long, class long, score double")
    pairs = asked.withColumnRenamed("class", "query").withColumnRenamed("vec_id", "query_id").join(hits, "query")
    found = pairs.join(shown, "class").where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
