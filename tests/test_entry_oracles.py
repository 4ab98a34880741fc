"""Driver contract and a sample of SQL oracles on sf0.001."""

import math

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as entry

TABLES = "customer orders lineitem events".split()

CHEAP = ["panel_load", "fit_stats", "sequence_long", "mask_long", "sequence_null_mask", "lag_scaled",
         "collapse_mask", "stacked_long", "split_overlap", "regression_metrics", "auc_by_rank",
         "weighted_loss", "mean_batch_loss", "batch_counts", "history_len"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_orderkey", "feature", "pos", "value"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"sequence_long", "lag_scaled", "auc_by_rank", "stream_sequence"} <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", CHEAP)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    o_cols, o_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert _rows(s_cols, s_rows) == _rows(o_cols, o_rows)
