"""All registered queries and their SQL oracles."""

from __future__ import annotations

from lagoon.plans import events, orders, streams, training
from lagoon.plans.oracle import ORACLES

QUERIES = {**orders.QUERIES, **events.QUERIES, **streams.QUERIES, **training.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
