"""Settings shared by the registered queries and their SQL oracles."""

from __future__ import annotations

from lagoon.sources.panels import EVENTS, ORDERS

SEQ_LEN = 5
SEED = 42
VALIDATION_PERCENT = 10       # entities whose hash bucket is >= 90 validate
N_SHARDS = 4
BATCH_SIZE = 500
ORDER_FEATURES = list(ORDERS.features)            # o_totalprice, n_items, sum_qty
ORDER_STATS_COLS = ORDER_FEATURES + ["c_acctbal", "c_nationkey"]
STATIC_SCALED = ["o_totalprice", "c_acctbal", "c_nationkey"]
STATIC_INPUTS = ["c_acctbal_scaled", "c_nationkey_scaled", "is_household"]
EVENT_FEATURES = list(EVENTS.features)            # value
