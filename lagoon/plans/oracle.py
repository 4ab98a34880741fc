"""Independent SQL (DuckDB dialect) for each registered query.

Each string recomputes a query from the raw tables with plain SQL: joins,
aggregates, window frames and lists.  It shares no code path with the
Spark implementation; only names and constants are common.
"""

from __future__ import annotations

from lagoon.plans.common import (BATCH_SIZE, EVENT_FEATURES, N_SHARDS, ORDER_FEATURES,
                                 ORDER_STATS_COLS, SEED, SEQ_LEN, STATIC_SCALED,
                                 VALIDATION_PERCENT)

N = SEQ_LEN

PANEL = """lt AS (
  SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS sum_qty
  FROM lineitem GROUP BY l_orderkey
), panel AS (
  SELECT o.o_custkey, o.o_orderdate, o.o_orderkey, o.o_totalprice, lt.n_items, lt.sum_qty,
         c.c_acctbal, c.c_nationkey, coalesce(c.c_mktsegment = 'HOUSEHOLD', false) AS is_household
  FROM orders o
  LEFT JOIN lt ON o.o_orderkey = lt.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""


def bucket(expr: str, n: int, seed: int = SEED) -> str:
    return f"CAST(('0x' || substr(md5('{seed}|' || CAST({expr} AS VARCHAR)), 1, 8))::BIGINT % {n} AS INTEGER)"


def is_train(entity: str) -> str:
    return f"{bucket(entity, 100)} < {100 - VALIDATION_PERCENT}"


def stats_cte(name: str, source: str, cols) -> str:
    body = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in cols)
    return f"{name} AS (SELECT {body} FROM {source})"


def z(col: str, st: str = "st", digits: int | None = 4, value: str | None = None) -> str:
    v = value or col
    expr = f"(CAST({v} AS DOUBLE) - (SELECT m_{col} FROM {st})) / (SELECT s_{col} FROM {st})"
    return f"round({expr}, {digits})" if digits is not None else expr


def window(entity: str, order: str) -> str:
    return f"WINDOW w AS (PARTITION BY {entity} ORDER BY {order} ROWS BETWEEN {N} PRECEDING AND 1 PRECEDING)"


ORDER_W = window("o_custkey", "o_orderdate, o_orderkey")


def seq_hist_cte(source: str = "panel", st: str = "st", policy: str = "skip") -> str:
    """``hist``: o_orderkey, o_custkey and one history list h_<f> per feature."""
    cols = []
    for f in ORDER_FEATURES:
        if policy == "skip":
            cols.append(f"coalesce(list(z_{f}) FILTER (WHERE z_{f} IS NOT NULL) OVER w, []) AS h_{f}")
        else:
            cols.append(f"coalesce(list({{'v': coalesce(z_{f}, 0.0), 'm': CASE WHEN z_{f} IS NULL THEN 0 ELSE 1 END}}) "
                        f"OVER w, []) AS h_{f}")
    zs = ", ".join(f"{z(f, st)} AS z_{f}" for f in ORDER_FEATURES)
    return (f"zed AS (SELECT o_orderkey, o_custkey, o_orderdate, {zs} FROM {source}), "
            f"hist AS (SELECT o_orderkey, o_custkey, {', '.join(cols)} FROM zed {ORDER_W})")


SEQ_PREFIX = f"WITH {PANEL}, {stats_cte('st', 'panel', ORDER_FEATURES)}, {seq_hist_cte()}"


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


SEQUENCE_LONG = SEQ_PREFIX + "\n" + _union(
    f"SELECT o_orderkey, '{f}' AS feature, CAST(unnest(range(1, {N + 1})) AS INTEGER) AS pos, "
    f"CAST(unnest(list_resize(h_{f}, {N}, 0.0)) AS FLOAT) AS value FROM hist"
    for f in ORDER_FEATURES)

MASK_LONG = SEQ_PREFIX + "\n" + _union(
    f"SELECT o_orderkey, feature, CAST(pos AS INTEGER) AS pos, CAST(CASE WHEN pos <= n THEN 1 ELSE 0 END AS INTEGER) AS mask "
    f"FROM (SELECT o_orderkey, '{f}' AS feature, len(h_{f}) AS n, unnest(range(1, {N + 1})) AS pos FROM hist)"
    for f in ORDER_FEATURES)

SEQUENCE_NULL_MASK = (
    f"WITH {PANEL}, {stats_cte('st', 'panel', ORDER_FEATURES)}, {seq_hist_cte(policy='mask')}\n"
    + _union(
        f"SELECT o_orderkey, feature, CAST(pos AS INTEGER) AS pos, CAST(cell.v AS FLOAT) AS value, "
        f"CAST(cell.m AS INTEGER) AS mask FROM (SELECT o_orderkey, '{f}' AS feature, "
        f"unnest(range(1, {N + 1})) AS pos, unnest(list_resize(h_{f}, {N}, {{'v': 0.0, 'm': 0}})) AS cell FROM hist)"
        for f in ORDER_FEATURES))

_F0 = ORDER_FEATURES[0]

HISTORY_LEN = SEQ_PREFIX + "\n" + _union(
    f"SELECT o_orderkey, CAST(len(h_{_F0}) AS INTEGER) AS valid_len, '{f}' AS feature, "
    f"CAST(len(h_{f}) AS INTEGER) AS history_len, CAST({N} - len(h_{f}) AS INTEGER) AS pad_len FROM hist"
    for f in ORDER_FEATURES)

DROP_COLD_START = SEQ_PREFIX + f"\nSELECT o_orderkey, o_custkey FROM hist WHERE len(h_{_F0}) > 0"

STACKED_LONG = SEQ_PREFIX + "\n" + _union(
    f"SELECT o_orderkey, CAST(pos AS INTEGER) AS step, {j + 1} AS feature_index, "
    f"CAST(CASE WHEN pos <= len(h_{f}) THEN h_{f}[pos] ELSE 0.0 END AS FLOAT) AS value, "
    f"CAST(CASE WHEN pos <= len(h_{f}) THEN 1 ELSE 0 END AS FLOAT) AS mask "
    f"FROM (SELECT o_orderkey, h_{f}, unnest(range(1, {N + 1})) AS pos FROM hist)"
    for j, f in enumerate(ORDER_FEATURES))

PANEL_LOAD = f"WITH {PANEL} SELECT * FROM panel"

FIT_STATS = f"WITH {PANEL}, {stats_cte('st', 'panel', ORDER_STATS_COLS)}\n" + _union(
    f"SELECT '{c}' AS col, round(m_{c}, 6) AS mean, round(s_{c}, 6) AS std FROM st" for c in ORDER_STATS_COLS)

SCALE_COLUMNS = (f"WITH {PANEL}, {stats_cte('st', 'panel', STATIC_SCALED)}\nSELECT o_orderkey, "
                 + ", ".join(f"round({z(c, digits=None)}, 6) AS {c}_scaled" for c in STATIC_SCALED)
                 + " FROM panel")

INVERSE_SCALE = (f"WITH {PANEL}, {stats_cte('st', 'panel', STATIC_SCALED)}\n"
                 f"SELECT o_orderkey, round(({z('o_totalprice', digits=None)}) * (SELECT s_o_totalprice FROM st) "
                 f"+ (SELECT m_o_totalprice FROM st), 6) AS o_totalprice_restored FROM panel")


def _lags(features, entity, order, source, st, fill: bool, scaled: set) -> str:
    cols = []
    for i in range(1, N + 1):
        for f in features:
            lag = f"lag({f}, {i}) OVER w"
            val = z(f, st, 4, value=lag) if f in scaled else f"CAST({lag} AS DOUBLE)"
            if fill:
                cols.append(f"coalesce({val}, 0.0) AS {f}_lag_{i}")
                cols.append(f"CAST(CASE WHEN {lag} IS NULL THEN 1 ELSE 0 END AS INTEGER) AS {f}_lag_{i}_mask")
            else:
                cols.append(f"{val} AS {f}_lag_{i}")
    return (f"SELECT {{key}}, {', '.join(cols)} FROM {source} "
            f"WINDOW w AS (PARTITION BY {entity} ORDER BY {order})")


COLLAPSE_MASK = (f"WITH {PANEL}, {stats_cte('st', 'panel', ORDER_FEATURES)}\n"
                 + _lags(ORDER_FEATURES, "o_custkey", "o_orderdate, o_orderkey", "panel", "st",
                         fill=False, scaled=set(ORDER_FEATURES)).format(key="o_orderkey"))

LAG_SCALED = (f"WITH {stats_cte('st', 'events', EVENT_FEATURES)}\n"
              + _lags(EVENT_FEATURES, "user_id", "ts, event_id", "events", "st",
                      fill=True, scaled=set(EVENT_FEATURES)).format(key="event_id"))

LAG_UNSCALED = _lags(EVENT_FEATURES, "user_id", "ts, event_id", "events", "st",
                     fill=True, scaled=set()).format(key="event_id")

DISTINCT_ENTITIES = "SELECT DISTINCT o_custkey FROM orders"

SPLIT_TRAIN = f"SELECT o_orderkey, o_custkey FROM orders WHERE {is_train('o_custkey')}"
SPLIT_VALIDATE = f"SELECT o_orderkey, o_custkey FROM orders WHERE NOT ({is_train('o_custkey')})"

SPLIT_OVERLAP = f"""WITH sides AS (
  SELECT o_custkey, max(CASE WHEN {is_train('o_custkey')} THEN 1 ELSE 0 END) AS in_train,
         max(CASE WHEN {is_train('o_custkey')} THEN 0 ELSE 1 END) AS in_validate
  FROM orders GROUP BY o_custkey)
SELECT CAST(sum(in_train) AS BIGINT) AS n_train_entities, CAST(sum(in_validate) AS BIGINT) AS n_validate_entities,
       CAST(sum(in_train * in_validate) AS BIGINT) AS n_overlap FROM sides"""

TRAIN_ROUNDTRIP = (
    f"WITH {PANEL}, train AS (SELECT * FROM panel WHERE {is_train('o_custkey')}), "
    f"{stats_cte('st', 'train', ORDER_FEATURES)}, {seq_hist_cte(source='train')}\n"
    f"SELECT o_orderkey, o_custkey, CAST(len(h_{_F0}) AS INTEGER) AS valid_len, "
    f"CAST(CASE WHEN len(h_{_F0}) > 0 THEN h_{_F0}[len(h_{_F0})] END AS FLOAT) AS last_scaled FROM hist")

VALIDATE_ROUNDTRIP = (
    f"WITH {PANEL}, train AS (SELECT * FROM panel WHERE {is_train('o_custkey')}), "
    f"validate AS (SELECT * FROM panel WHERE NOT {is_train('o_custkey')}), "
    f"{stats_cte('st', 'train', ORDER_FEATURES)}, {seq_hist_cte(source='validate')}\n"
    f"SELECT o_orderkey, o_custkey, CAST(len(h_{_F0}) AS INTEGER) AS valid_len, "
    f"CAST(CASE WHEN len(h_{_F0}) > 0 THEN h_{_F0}[len(h_{_F0})] END AS FLOAT) AS last_scaled FROM hist")

CSV_PANEL = (f"WITH {PANEL} SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_totalprice, c_acctbal, is_household "
             "FROM panel WHERE c_acctbal IS NOT NULL")

FOLD_STATS = (
    f"WITH {PANEL}, folded AS (SELECT *, {bucket('o_custkey', 3)} AS fold FROM panel WHERE {is_train('o_custkey')})\n" + _union(
        f"SELECT CAST({f} AS INTEGER) AS fold, '{c}' AS col, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std "
        f"FROM folded WHERE fold <> {f}" for f in range(3) for c in ORDER_STATS_COLS))

ROW_SPLIT_TEST = f"SELECT event_id, user_id FROM events WHERE {bucket('event_id', 100)} >= 80"

ENTITY_FOLDS = (f"SELECT o_custkey, {bucket('o_custkey', 3)} AS fold, count(*) AS n_rows FROM orders "
                f"WHERE {is_train('o_custkey')} GROUP BY 1, 2")

SHARD_COUNTS = (f"SELECT {bucket('o_orderkey', N_SHARDS)} AS shard, count(*) AS n_rows FROM orders "
                f"WHERE {is_train('o_custkey')} GROUP BY 1")

BATCH_COUNTS = (f"SELECT shard, n_rows, CAST(ceil(n_rows / {BATCH_SIZE}) AS BIGINT) AS n_batches "
                f"FROM ({SHARD_COUNTS})")

PREVIEW_TOPK = ("SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders "
                "ORDER BY o_custkey, o_orderdate, o_orderkey LIMIT 5")

ASSEMBLE_LONG = (f"WITH {PANEL}, {stats_cte('st', 'panel', STATIC_SCALED)}\n" + _union(
    f"SELECT o_orderkey, {i + 1} AS pos, CAST({expr} AS FLOAT) AS value FROM panel"
    for i, expr in enumerate([z("c_acctbal", digits=None), z("c_nationkey", digits=None),
                              "CASE WHEN is_household THEN 1.0 ELSE 0.0 END"])))

PRED = (f"pred AS (SELECT event_id, value AS label, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id "
        f"ROWS BETWEEN {N} PRECEDING AND 1 PRECEDING) AS prediction FROM events)")

REGRESSION_METRICS = (f"WITH {PRED}\nSELECT count(*) AS n, round(sqrt(avg((label - prediction) * (label - prediction))), 6) AS rmse, "
                      "round(avg(abs(label - prediction)), 6) AS mae, "
                      "round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) AS r2 "
                      "FROM pred WHERE prediction IS NOT NULL")

MAE_PCT_OF_MEAN = (f"WITH {PRED}, m AS (SELECT avg(abs(label - prediction)) FILTER (WHERE prediction IS NOT NULL) AS mae, "
                   "avg(label) AS mean_label FROM pred)\n"
                   "SELECT round(mae, 6) AS mae, round(mean_label, 6) AS mean_label, round(mae / mean_label * 100.0, 6) AS mae_pct FROM m")

BATCHES = (f"WITH {PRED}, sh AS (SELECT event_id, {bucket('event_id', N_SHARDS)} AS shard, "
           "(label - prediction) * (label - prediction) AS se FROM pred WHERE prediction IS NOT NULL), "
           "rk AS (SELECT shard, se, row_number() OVER (PARTITION BY shard ORDER BY event_id) AS rn FROM sh), "
           f"b AS (SELECT shard, (rn - 1) // {BATCH_SIZE} AS batch, count(*) AS n, avg(se) AS loss FROM rk GROUP BY 1, 2)\n")

WEIGHTED_LOSS = BATCHES + ("SELECT round(sum(loss * n) / greatest(sum(n), 1), 6) AS weighted_loss, "
                           "CAST(sum(n) AS BIGINT) AS n_rows FROM b")

MEAN_BATCH_LOSS = BATCHES + "SELECT round(avg(loss), 6) AS mean_batch_loss, count(*) AS n_batches FROM b"

AUC_BY_RANK = """WITH s AS (
  SELECT CAST(value AS DOUBLE) AS score, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
         CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS DOUBLE) AS neg
  FROM events WHERE value IS NOT NULL GROUP BY 1),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c"""

STREAM_IS_EVEN = "SELECT event_id, event_id % 2 = 0 AS is_even FROM events"

STREAM_SEQUENCE = (f"WITH {stats_cte('st', 'events', ['value'])}, "
                   f"zed AS (SELECT event_id, user_id, ts, {z('value')} AS z_value FROM events), "
                   f"hist AS (SELECT event_id, coalesce(list(z_value) FILTER (WHERE z_value IS NOT NULL) OVER w, []) AS h "
                   f"FROM zed {window('user_id', 'ts, event_id')})\n"
                   f"SELECT event_id, 'value' AS feature, CAST(unnest(range(1, {N + 1})) AS INTEGER) AS pos, "
                   f"CAST(unnest(list_resize(h, {N}, 0.0)) AS FLOAT) AS value FROM hist")

ORACLES = {
    "panel_load": PANEL_LOAD,
    "fit_stats": FIT_STATS,
    "scale_columns": SCALE_COLUMNS,
    "inverse_scale": INVERSE_SCALE,
    "collapse_mask": COLLAPSE_MASK,
    "sequence_long": SEQUENCE_LONG,
    "mask_long": MASK_LONG,
    "sequence_null_mask": SEQUENCE_NULL_MASK,
    "history_len": HISTORY_LEN,
    "drop_cold_start": DROP_COLD_START,
    "assemble_long": ASSEMBLE_LONG,
    "stacked_long": STACKED_LONG,
    "distinct_entities": DISTINCT_ENTITIES,
    "split_train": SPLIT_TRAIN,
    "split_validate": SPLIT_VALIDATE,
    "split_overlap": SPLIT_OVERLAP,
    "train_roundtrip": TRAIN_ROUNDTRIP,
    "validate_roundtrip": VALIDATE_ROUNDTRIP,
    "csv_panel": CSV_PANEL,
    "fold_stats": FOLD_STATS,
    "row_split_test": ROW_SPLIT_TEST,
    "entity_folds": ENTITY_FOLDS,
    "shard_counts": SHARD_COUNTS,
    "batch_counts": BATCH_COUNTS,
    "preview_topk": PREVIEW_TOPK,
    "lag_scaled": LAG_SCALED,
    "lag_unscaled": LAG_UNSCALED,
    "model_roundtrip": LAG_SCALED,
    "regression_metrics": REGRESSION_METRICS,
    "mae_pct_of_mean": MAE_PCT_OF_MEAN,
    "weighted_loss": WEIGHTED_LOSS,
    "mean_batch_loss": MEAN_BATCH_LOSS,
    "auc_by_rank": AUC_BY_RANK,
    "stream_is_even": STREAM_IS_EVEN,
    "stream_sequence": STREAM_SEQUENCE,
}
