"""Steps whose work once grew faster than their input."""

import numpy as np
import pyarrow as pa

from lagoon.llm import ann


def test_candidates_of_many_queries_are_scored_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    vectors, queries = rng.normal(size=(700, 8)).astype(np.float32), rng.normal(size=(100, 8)).astype(np.float32)
    vectors[1], queries[1] = 1e25, 1e25                          # no sum of these fits single precision
    leaf, kind, calls = np.sort(rng.integers(0, 10, 700)), pa.list_(pa.float32()), []
    opened = [sorted(rng.choice(10, 4, replace=False).tolist()) for _ in queries]
    opened[2] = [99]
    near = pa.table({"class": rng.permutation(700), "vector": pa.array(vectors.tolist(), kind), "leaf": leaf})
    asked = pa.table({"query": np.arange(100) + 1000, "vector": pa.array(queries.tolist(), kind), "leaves": pa.array(opened, pa.list_(pa.int64()))})
    plain = ann.inner_products
    monkeypatch.setattr(ann, "inner_products", lambda a, b: calls.append(len(a)) or plain(a, b))
    got, names = ann._rank(5)(near, asked), near.column("class").to_numpy()
    assert got.column("query").to_pylist() == list(range(1000, 1100))
    for q, hits in enumerate(got.column("hits").to_pylist()):
        at = np.flatnonzero(np.isin(leaf, opened[q]))
        score = plain(np.repeat(queries[q:q + 1], len(at), axis=0), vectors[at])
        want = sorted(zip((-score).tolist(), names[at].tolist()))[:6]
        assert [(h["far"], h["class"]) for h in hits] == want
    assert len(calls) <= 2                                       # once a query before


def test_neighbour_lists_are_merged_by_one_sort(spark):
    kind = pa.list_(pa.struct([("far", pa.float64()), ("class", pa.int64())]))
    rng, score = np.random.default_rng(6), np.random.default_rng(7).integers(0, 30, 200).astype(float)
    lists = [[{"far": -score[c], "class": c} for c in rng.choice(200, 21, replace=False).tolist()] for _ in range(40)] + [[]]
    got = ann._merge(20)(pa.table({"query": [4] * 41, "hits": pa.array(lists, kind)}))
    want = sorted({(h["far"], h["class"]) for hits in lists for h in hits})[:21]
    assert list(zip(got["query"].to_pylist(), got["class"].to_pylist(), got["score"].to_pylist())) == [(4, c, -far) for far, c in want]
    assert ann._merge(20)(pa.table({"query": [4], "hits": pa.array([[]], kind)})).num_rows == 0
    rows = [(i, [float(i % 7 + 1), float(i % 11)]) for i in range(80)]
    plan = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3)._jdf.queryExecution().toString()
    assert "array_distinct" not in plan                          # it took time as the square of a query's hits


def test_leaves_of_many_queries_are_those_of_the_queue():
    rng = np.random.default_rng(8)
    for points in (rng.normal(size=(900, 6)), rng.integers(0, 3, (900, 6)).astype(float), np.ones((50, 6))):
        points = points.astype(np.float32)
        forest = [ann.Tree(points, leaf, 3 + leaf) for leaf in (8, 9, 2000)]
        queries = np.concatenate([points[:40], np.zeros((1, 6), np.float32)])
        for wanted in (3, 60, 10_000):
            want = [(r, i, leaf) for r, q in enumerate(queries) for i, leaf in sorted(ann.leaves_of(forest, q, wanted))]
            assert list(zip(*(x.tolist() for x in ann.Probes(forest, wanted)(queries)))) == want
