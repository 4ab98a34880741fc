"""Property tests: bounded look-back windows against a brute force in plain Python.

Random small panels (ties in time, bursts, nulls) go through ``lookback``
with random hot-entity thresholds, bucket sizes, slot counts and both join
branches.  The result must equal a per-entity sort-and-slice in Python.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lagoon.operators.lookback import lookback

DEPTH = 3
START = dt.datetime(2024, 1, 1)

rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.one_of(st.integers(0, 5), st.integers(0, 10_000)),      # bursts and spread-out times
        st.one_of(st.none(), st.floats(-100, 100, allow_nan=False).map(lambda x: round(x, 3))),
    ),
    min_size=1, max_size=80,
)


def brute_force(rows):
    by_entity = {}
    for rid, (e, t, x) in enumerate(rows):
        by_entity.setdefault(e, []).append((t, rid, x))
    out = set()
    for items in by_entity.values():
        items.sort()
        xs = [x for _, _, x in items]
        for k, (_, rid, _) in enumerate(items):
            lags = tuple(xs[k - i] if k - i >= 0 else None for i in (1, 2, 3))
            hist = tuple(x for x in xs[max(0, k - DEPTH):k] if x is not None)
            out.add((rid, *lags, hist))
    return out


def build(w):
    return [F.lag("x", i).over(w).alias(f"l{i}") for i in (1, 2, 3)] + [
        F.collect_list("x").over(w.rowsBetween(-DEPTH, -1)).alias("h")]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, hot_rows=st.integers(1, 30), bucket_rows=st.integers(1, 12),
       broadcast=st.booleans())
def test_lookback_equals_brute_force(spark, rows, hot_rows, bucket_rows, broadcast):
    data = [(e, START + dt.timedelta(minutes=t), rid, x) for rid, (e, t, x) in enumerate(rows)]
    df = spark.createDataFrame(data, "e string, ts timestamp_ntz, id long, x double")
    out = lookback(df, "e", ["ts", "id"], DEPTH, build, hot_rows=hot_rows, bucket_rows=bucket_rows,
                   broadcast_limit=1000 if broadcast else 0)
    got = {(r["id"], r["l1"], r["l2"], r["l3"], tuple(r["h"])) for r in out.collect()}
    assert out.count() == len(rows)
    assert got == brute_force(rows)
