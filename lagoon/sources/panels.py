"""Panels: a DataFrame plus the roles of its columns.

A panel is a set of entities (households, customers, users), each with rows
over time.  ``PanelSpec`` names the roles; the two builders below derive the
panels used throughout the library from the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagoon.functions.columns import yes_no_flag
from lagoon.sources.tables import read_table


@dataclass(frozen=True)
class PanelSpec:
    entity: str
    order_cols: tuple[str, ...]
    features: tuple[str, ...]
    statics: tuple[str, ...] = ()
    target: str | None = None
    key: str | None = None          # unique row key (defaults to the last order column)
    extra: dict = field(default_factory=dict)

    @property
    def row_key(self) -> str:
        return self.key or self.order_cols[-1]


# Orders panel: one row per order, entity = customer, ordered by date with the
# order key as tie-breaker (dates alone tie for some customers).
ORDERS = PanelSpec(
    entity="o_custkey",
    order_cols=("o_orderdate", "o_orderkey"),
    features=("o_totalprice", "n_items", "sum_qty"),
    statics=("c_acctbal", "c_nationkey", "is_household"),
    target="o_totalprice",
    key="o_orderkey",
)

# Events panel: one row per event, entity = user, ordered by time.
EVENTS = PanelSpec(
    entity="user_id",
    order_cols=("ts", "event_id"),
    features=("value",),
    target="value",
    key="event_id",
)


def orders_panel(spark: SparkSession, sf_dir: str, with_statics: bool = True) -> DataFrame:
    """orders LEFT JOIN per-order line totals LEFT JOIN customer.

    Line items are aggregated per order *before* the join (partial hash
    aggregate, so a hot order key is combined map-side), which leaves a
    one-row-per-key side on both joins.  Orders without lines keep null
    ``n_items``/``sum_qty`` -- real missing values for the sequence paths.
    Join strategy is left to AQE (broadcast only when the runtime size is
    under the threshold; skewed customer partitions are split).

    ``with_statics=False`` leaves out the customer join for callers that only
    use the sequence features.  Catalyst cannot drop a left join by itself,
    because it does not know that ``c_custkey`` is unique.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_items"), F.sum("l_quantity").alias("sum_qty"))
    )
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    features = ["o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "n_items", "sum_qty"]
    if not with_statics:
        return joined.select(*features)
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", "c_nationkey",
        yes_no_flag("c_mktsegment", "HOUSEHOLD").alias("is_household"))
    return joined.join(customer, joined.o_custkey == customer.c_custkey, "left").select(
        *features, "c_acctbal", "c_nationkey",
        F.coalesce(F.col("is_household"), F.lit(False)).alias("is_household"),
    )


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value")
