"""Hard negatives by length buckets and coordinate lists (maximum inner product search with windows).

The index is the table of vectors, range-partitioned and sorted by falling length and
written as Parquet.  A batch of ``bucket_rows`` neighbours is a length bucket.  For a
bucket a task sorts one list per coordinate of the normalised vectors.

An anchor ``q`` that needs an inner product of at least ``t`` from a bucket whose longest
vector has length ``l`` needs a cosine of at least ``t / (|q| l)``: above 1 the bucket is
skipped.  Below, a vector within that angle of ``q`` has in each coordinate ``f`` a value
whose angle to the axis differs from ``q``'s by no more, so only a slice of the sorted list
of ``f`` is feasible.  The slices of ``q``'s largest coordinates (its focus) are
intersected, starting from the shortest; what is left is verified by exact integer products.
Thresholds are the worst place an anchor still has to fill and rise along a task's buckets.

Anchors go out in blocks of ``block`` rows (broadcast: at most ``block`` vectors and their
windows), and each block is one pass over the index for positives and one for negatives.
No pair of rows is ever a row of a table: a task keeps the best few per anchor.

Rows and edges: null ids, null labels, null vectors and null or non-finite components take
no part (a null id could not be returned).  Rows of one id are rows of their own.  Vectors
of different lengths have no product and never meet; empty and zero vectors have product 0.
Equal scores go by smaller id.  Products must fit 64 bits.  An empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagoon.session import scratch_path

BUCKET_ROWS = 4096
PART_ROWS = 40_000
BLOCK = 32_768
FOCUS = 4
_SLACK = 1e-9
_EXACT = float(2**53)


def whole_vectors(rows: DataFrame, vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, label, vec`` of the rows that take part; ``vec`` holds floor(scale * x)."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    fine = F.forall(F.col("_x"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("_x"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("_x").isNotNull() & F.coalesce(fine, F.lit(False)))
            .select("vec_id", "label", F.transform("_x", lambda v: F.floor(v * scale).cast("long")).alias("vec")))


def build_index(vectors: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """The vectors by falling length, numbered (``_row``) and stored in the shared folder."""
    spark = vectors.sparkSession
    square = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    named = vectors.select("vec_id", "label", "vec", F.sqrt(square).alias("norm"))
    parts = max(1, -(-named.count() // part_rows))
    path = scratch_path(spark, "hardneg-index")
    (named.repartitionByRange(parts, F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id")
     .withColumn("_row", F.monotonically_increasing_id()).write.parquet(path))
    return spark.read.parquet(path)


# ---------------------------------------------------------------- inside tasks


class Bucket:
    """Neighbours by length with one sorted list of directions per coordinate."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vecs: np.ndarray, norms: np.ndarray) -> None:
        self.ids, self.rows, self.labels, self.vecs, self.top = ids, rows, labels, vecs, float(norms.max())
        self.unit = vecs / np.where(norms > 0, norms, 1.0)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(self.unit.T, self.order, axis=1)

    def candidates(self, unit: np.ndarray, norm: float, threshold: float, focus: int = FOCUS) -> np.ndarray | None:
        """Rows whose product with the anchor may reach ``threshold``; None for all of them."""
        if threshold <= 0:
            return None
        reach = norm * self.top
        if threshold > reach * (1 + _SLACK):
            return np.zeros(0, np.int64)
        angle = np.arccos(min(1.0, threshold / reach)) + _SLACK
        axes = np.argsort(-np.abs(unit), kind="stable")[:focus]
        own = np.arccos(np.clip(unit[axes], -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, own + angle)) - _SLACK
        high = np.cos(np.maximum(0.0, own - angle)) + _SLACK
        start = np.array([np.searchsorted(self.sorted[f], a, "left") for f, a in zip(axes, low, strict=True)])
        stop = np.array([np.searchsorted(self.sorted[f], b, "right") for f, b in zip(axes, high, strict=True)])
        size = stop - start
        turn = np.argsort(size, kind="stable")
        if not len(turn) or size[turn[0]] >= len(self.ids):
            return None
        f = turn[0]
        found = self.order[axes[f]][start[f]:stop[f]]
        for f in turn[1:]:
            if size[f] < len(self.ids):
                values = self.unit[found, axes[f]]
                found = found[(values >= low[f]) & (values <= high[f])]
        return np.sort(found)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if len(flat) else np.zeros((rows, 0), np.int64)


def _buckets(batch: pa.RecordBatch, bucket_rows: int) -> Iterator[tuple[int, Bucket]]:
    """The buckets of a batch, each with the number of its coordinates."""
    width = np.diff(batch.column("vec").offsets.to_numpy())
    for dim in np.unique(width).tolist():
        some = batch if (width == dim).all() else batch.take(pa.array(np.flatnonzero(width == dim)))
        for at in range(0, some.num_rows, bucket_rows):
            part = some.slice(at, bucket_rows)
            vecs = _matrix(part.column("vec"), part.num_rows)
            yield dim, Bucket(*(part.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "_row", "label")),
                              vecs, part.column("norm").to_numpy(zero_copy_only=False))


def _products(bucket: Bucket, queries: np.ndarray) -> np.ndarray:
    """Exact integer products, in floating point where every sum stays below 2^53."""
    most = float(np.abs(bucket.vecs).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1])
    if most < _EXACT:
        return (bucket.vecs.astype(np.float64) @ queries.T.astype(np.float64)).astype(np.int64)
    return bucket.vecs.astype(np.int64) @ queries.T.astype(np.int64)


def _scored(bucket: Bucket, block: dict, thresholds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(anchor, candidates, scores)`` for the anchors that have candidates in the bucket."""
    vecs, norms, unit = block["vecs"], block["norms"], block["unit"]
    n = len(bucket.ids)
    for at in range(0, len(vecs), 256):
        some = {}
        for a in range(at, min(at + 256, len(vecs))):
            found = bucket.candidates(unit[a], norms[a], thresholds[a])
            if found is None or len(found):
                some[a] = found
        wide = [a for a, found in some.items() if found is None or 2 * len(found) > n]
        if wide:
            table = _products(bucket, vecs[wide])
            place = {a: i for i, a in enumerate(wide)}
        for a, found in some.items():
            if a in place if wide else False:
                scores = table[:, place[a]]
                yield (a, np.arange(n), scores) if found is None else (a, found, scores[found])
            else:
                sub = Bucket.__new__(Bucket)
                sub.vecs = bucket.vecs[found]
                yield a, found, _products(sub, vecs[a:a + 1])[:, 0]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by falling score, then rising id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _positives(shared, k: int, bucket_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = shared.value
        kept = {dim: [(np.zeros(0, np.int64),) * 3] * len(b["vecs"]) for dim, b in blocks.items()}
        least = {dim: np.full(len(b["vecs"]), -np.inf) for dim, b in blocks.items()}
        for batch in batches:
            for dim, bucket in _buckets(batch, bucket_rows):
                if dim not in blocks:
                    continue
                block, have, floor = blocks[dim], kept[dim], least[dim]
                for a, found, scores in _scored(bucket, block, floor):
                    good = (scores >= floor[a]) & (bucket.labels[found] == block["labels"][a]) & (bucket.rows[found] != block["rows"][a])
                    if not good.any():
                        continue
                    s, i, r = (np.concatenate([x, y]) for x, y in zip(
                        have[a], (scores[good], bucket.ids[found[good]], bucket.rows[found[good]]), strict=True))
                    pick = _best(s, i, k)
                    have[a] = (s[pick], i[pick], r[pick])
                    if len(pick) == k:
                        floor[a] = float(s[pick[-1]])
        for dim, block in blocks.items():
            n = [len(s) for s, _, _ in kept[dim]]
            s, i, r = (np.concatenate([x[j] for x in kept[dim]]) for j in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(block["rows"], n), pa.int64()), *(pa.array(x, pa.int64()) for x in (i, r, s))],
                                             names=["_anchor", "positive_id", "_row", "positive_score"])
    return run


def _negatives(shared, k: int, low: int, high: int, bucket_rows: int):
    """``low`` and ``high``: the window of 100 * score, in positive scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = shared.value
        state = {}
        for dim, block in blocks.items():
            floors = [-(-low * p // 100) for p in block["positives"]]
            tops = [high * p // 100 for p in block["positives"]]
            kept = [[(np.zeros(0, np.int64),) * 2] * len(p) for p in block["positives"]]
            needs = np.array([min((float(f) for f, t in zip(a, b, strict=True) if f <= t), default=np.inf) for a, b in zip(floors, tops, strict=True)])
            state[dim] = (floors, tops, kept, needs)
        for batch in batches:
            for dim, bucket in _buckets(batch, bucket_rows):
                if dim not in blocks:
                    continue
                block = blocks[dim]
                floors, tops, kept, needs = state[dim]
                for a, found, scores in _scored(bucket, block, needs):
                    good = (scores >= needs[a]) & (bucket.labels[found] != block["labels"][a])
                    if not good.any():
                        continue
                    s, i = scores[good], bucket.ids[found[good]]
                    turn = np.lexsort((i, -s))
                    s, i = s[turn], i[turn]
                    for w in range(len(floors[a])):
                        if floors[a][w] > tops[a][w]:
                            continue
                        begin = int(np.searchsorted(-s, -tops[a][w], "left"))
                        stop = min(begin + k, int(np.searchsorted(-s, -floors[a][w], "right")))
                        if stop > begin:
                            both = np.concatenate([kept[a][w][0], s[begin:stop]]), np.concatenate([kept[a][w][1], i[begin:stop]])
                            pick = _best(*both, k)
                            kept[a][w] = (both[0][pick], both[1][pick])
                            if len(pick) == k:
                                floors[a][w] = int(both[0][pick[-1]])
                    needs[a] = min((float(f) for f, t in zip(floors[a], tops[a], strict=True) if f <= t), default=np.inf)
        for dim, block in blocks.items():
            kept = state[dim][2]
            n = [[len(s) for s, _ in windows] for windows in kept]
            out = [np.repeat(block["rows"], [sum(x) for x in n]), np.concatenate([np.zeros(0, np.int64), *(np.repeat(np.arange(len(x)), x) for x in n)]),
                   *(np.concatenate([np.zeros(0, np.int64), *(x[j] for windows in kept for x in windows)]) for j in (1, 0))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["_anchor", "_window", "negative_id", "negative_score"])
    return run


# ---------------------------------------------------------------- blocks of anchors


def _block(spark, anchors: list, positives: dict | None = None):
    """A broadcast of one block: by number of coordinates, its rows, labels, vectors and windows."""
    by_dim: dict[int, list] = {}
    for r in anchors:
        by_dim.setdefault(len(r["vec"]), []).append(r)
    out = {}
    for dim, some in by_dim.items():
        vecs = np.array([r["vec"] for r in some], np.int64).reshape(len(some), dim)
        norms = np.array([r["norm"] for r in some])
        out[dim] = {"rows": np.array([r["_row"] for r in some], np.int64), "labels": np.array([r["label"] for r in some], np.int64), "vecs": vecs,
                    "norms": norms, "unit": vecs / np.where(norms > 0, norms, 1.0)[:, None],
                    "positives": [np.array(positives.get(r["_row"], []), object) for r in some] if positives is not None else None}
    return spark.sparkContext.broadcast(out)


def mined(index: DataFrame, every: int = 50, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
          bucket_rows: int = BUCKET_ROWS, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` over an index (see ``build_index``).

    ``block`` bounds the anchors of one broadcast (they are dealt by a hash, so a block
    holds about as many); ``low`` and ``high`` are percent of the positive's score.
    """
    spark = index.sparkSession
    anchors = index.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-anchors.count() // block))
    found = []
    for b in range(blocks):
        mine = anchors.where(F.pmod(F.xxhash64("_row"), F.lit(blocks)) == b).select("_row", "vec_id", "label", "vec", "norm").collect()
        if not mine:
            continue
        shared = _block(spark, mine)
        best = index.mapInArrow(_positives(shared, n_positives, bucket_rows), "_anchor long, positive_id long, _row long, positive_score long")
        w = Window.partitionBy("_anchor").orderBy(F.desc("positive_score"), "positive_id", "_row")
        top = best.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n_positives).collect()  # n_positives per anchor
        windows: dict[int, list] = {}
        names: dict[tuple[int, int], int] = {}
        for r in sorted(top, key=lambda r: (r["_anchor"], r["_n"])):
            names[r["_anchor"], len(windows.setdefault(r["_anchor"], []))] = r["positive_id"]
            windows[r["_anchor"]].append(r["positive_score"])
        if not names:
            continue
        ids = {r["_row"]: r["vec_id"] for r in mine}
        said = spark.createDataFrame([(a, i, ids[a], p, windows[a][i]) for (a, i), p in names.items()],
                                     "_anchor long, _window long, anchor_id long, positive_id long, positive_score long")
        shared = _block(spark, mine, windows)
        near = index.mapInArrow(_negatives(shared, n_negatives, low, high, bucket_rows), "_anchor long, _window long, negative_id long, negative_score long")
        w = Window.partitionBy("_anchor", "_window").orderBy(F.desc("negative_score"), "negative_id")
        ranked = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_negatives)
        path = scratch_path(spark, "hardneg")
        (ranked.join(F.broadcast(said), ["_anchor", "_window"])
         .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.parquet(path))
        found.append(path)
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return spark.read.parquet(*found)
