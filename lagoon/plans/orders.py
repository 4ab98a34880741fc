"""Registered queries over the orders panel (entity = customer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagoon.functions.arrays import explode_arrays, valid_length
from lagoon.functions.columns import hash_percent
from lagoon.operators.assemble import ArrayAssembler, stack_sequences
from lagoon.operators.collapse import CollapseMask
from lagoon.operators.lag import ScaledLag, lag_names
from lagoon.operators.scaler import ColumnScaler
from lagoon.operators.sequence import Sequencer
from lagoon.operators.split import entity_split
from lagoon.operators.stats import stats_frame
from lagoon.plans.common import (BATCH_SIZE, N_SHARDS, ORDER_FEATURES, ORDER_STATS_COLS, SEED,
                                 SEQ_LEN, STATIC_INPUTS, STATIC_SCALED, VALIDATION_PERCENT)
from lagoon.session import scratch_path
from lagoon.sources.csv import load_csv_panel
from lagoon.sources.panels import ORDERS, orders_panel
from lagoon.sources.tables import read_table
from lagoon.sources.training_sets import read_training_set, shard_rows, write_shards, write_training_set

KEY = ORDERS.row_key


def sequencer(null_policy: str = "skip", **kw) -> Sequencer:
    return Sequencer(partition_col=ORDERS.entity, order_cols=list(ORDERS.order_cols),
                     sequence_features_cols=ORDER_FEATURES, sequence_length=SEQ_LEN,
                     null_policy=null_policy, **kw)


def sequenced(spark: SparkSession, sf_dir: str, null_policy: str = "skip", **kw) -> DataFrame:
    """Order histories without the customer statics (no customer join)."""
    panel = orders_panel(spark, sf_dir, with_statics=False)
    return sequencer(null_policy, **kw).fit(panel).transform(panel)


def panel_load(spark, sf_dir):
    return orders_panel(spark, sf_dir)


def fit_stats(spark, sf_dir):
    return stats_frame(orders_panel(spark, sf_dir), ORDER_STATS_COLS, digits=6)


def _scaler_model(panel):
    return ColumnScaler(inputCols=STATIC_SCALED).fit(panel)


def scale_columns(spark, sf_dir):
    panel = orders_panel(spark, sf_dir)
    out = _scaler_model(panel).transform(panel)
    return out.select(KEY, *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in STATIC_SCALED])


def inverse_scale(spark, sf_dir):
    panel = orders_panel(spark, sf_dir)
    model = _scaler_model(panel)
    out = model.transform(panel)
    restored = model.inverse("o_totalprice_scaled", "o_totalprice")
    return out.select(KEY, F.round(restored, 6).alias("o_totalprice_restored"))


def collapse_mask(spark, sf_dir):
    panel = orders_panel(spark, sf_dir, with_statics=False)
    lags = ScaledLag(partition_col=ORDERS.entity, order_cols=list(ORDERS.order_cols),
                     sequence_feature_cols=ORDER_FEATURES, sequence_length=SEQ_LEN).fit(panel)
    names = lag_names(ORDER_FEATURES, SEQ_LEN)
    out = CollapseMask(inputCols=names).transform(lags.transform(panel))
    return out.select(KEY, *names)


def sequence_long(spark, sf_dir):
    df = sequenced(spark, sf_dir)
    return explode_arrays(df, [KEY], {f: f"{f}_sequence" for f in ORDER_FEATURES}, "feature", "value")


def mask_long(spark, sf_dir):
    df = sequenced(spark, sf_dir)
    return explode_arrays(df, [KEY], {f: f"{f}_mask" for f in ORDER_FEATURES}, "feature", "mask")


def _value_mask_cells(f: str):
    seq, mask = F.col(f"{f}_sequence"), F.col(f"{f}_mask")
    return F.array(*[F.struct(F.get(seq, F.lit(i)).alias("value"), F.get(mask, F.lit(i)).alias("mask"))
                     for i in range(SEQ_LEN)])


def sequence_null_mask(spark, sf_dir):
    df = sequenced(spark, sf_dir, null_policy="mask")
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), _value_mask_cells(f).alias("z"))
                      for f in ORDER_FEATURES])
    return (
        df.select(KEY, F.inline(cells))
        .select(KEY, "feature", F.posexplode("z").alias("p", "s"))
        .select(KEY, "feature", (F.col("p") + 1).alias("pos"),
                F.col("s.value").alias("value"), F.col("s.mask").alias("mask"))
    )


def history_len(spark, sf_dir):
    df = sequenced(spark, sf_dir, emit_history_len=True)
    first = ORDER_FEATURES[0]
    rows = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"{f}_history_len").alias("history_len"),
                 (F.lit(SEQ_LEN) - F.col(f"{f}_history_len")).alias("pad_len"))
        for f in ORDER_FEATURES
    ])
    return df.select(KEY, valid_length(F.col(f"{first}_mask"), SEQ_LEN).alias("valid_len"), F.inline(rows))


def drop_cold_start(spark, sf_dir):
    df = sequenced(spark, sf_dir, drop_cold_start=True)
    return df.select(KEY, ORDERS.entity)


def _static_features(spark, sf_dir):
    panel = orders_panel(spark, sf_dir)
    scaled = _scaler_model(panel).transform(panel)
    return ArrayAssembler(inputCols=STATIC_INPUTS, outputCol="static_features").transform(scaled)


def assemble_long(spark, sf_dir):
    df = _static_features(spark, sf_dir)
    return (
        df.select(KEY, F.posexplode("static_features").alias("p", "value"))
        .select(KEY, (F.col("p") + 1).alias("pos"), "value")
    )


def stacked_long(spark, sf_dir):
    df = sequenced(spark, sf_dir)
    steps, masks = stack_sequences(ORDER_FEATURES, SEQ_LEN)
    s, m = F.col("__s"), F.col("__m")
    cells = F.array(*[
        F.struct(F.lit(i + 1).alias("step"), F.lit(j + 1).alias("feature_index"),
                 F.get(F.get(s, F.lit(i)), F.lit(j)).alias("value"),
                 F.get(F.get(m, F.lit(i)), F.lit(j)).alias("mask"))
        for i in range(SEQ_LEN) for j in range(len(ORDER_FEATURES))
    ])
    return df.select(KEY, steps.alias("__s"), masks.alias("__m")).select(KEY, F.inline(cells))


def distinct_entities(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(ORDERS.entity).distinct()


def _split(spark, sf_dir, source=None):
    df = source if source is not None else read_table(spark, sf_dir, "orders")
    return entity_split(df, ORDERS.entity, VALIDATION_PERCENT, SEED)


def split_train(spark, sf_dir):
    return _split(spark, sf_dir)[0].select(KEY, ORDERS.entity)


def split_validate(spark, sf_dir):
    return _split(spark, sf_dir)[1].select(KEY, ORDERS.entity)


def split_overlap(spark, sf_dir):
    panel = read_table(spark, sf_dir, "orders")
    side = F.when(hash_percent(ORDERS.entity, SEED) >= 100 - VALIDATION_PERCENT, "validate").otherwise("train")
    per_entity = (panel.select(ORDERS.entity, side.alias("side"))
                  .groupBy(ORDERS.entity)
                  .agg(F.max((F.col("side") == "train").cast("int")).alias("in_train"),
                       F.max((F.col("side") == "validate").cast("int")).alias("in_validate")))
    return per_entity.agg(
        F.sum("in_train").cast("long").alias("n_train_entities"),
        F.sum("in_validate").cast("long").alias("n_validate_entities"),
        F.sum(F.col("in_train") * F.col("in_validate")).cast("long").alias("n_overlap"),
    )


def train_roundtrip(spark, sf_dir):
    """Fit on train only, write the shuffled train set, read it back."""
    train, _ = _split(spark, sf_dir, orders_panel(spark, sf_dir))
    featured = sequencer().fit(train).transform(train)
    path = write_training_set(featured, spark, "orders-train", shuffle_key=KEY, seed=SEED)
    return _last_scaled(read_training_set(spark, path))


def _last_scaled(back):
    first = ORDER_FEATURES[0]
    n = valid_length(F.col(f"{first}_mask"), SEQ_LEN)
    return back.select(
        KEY, ORDERS.entity, n.alias("valid_len"),
        F.when(n > 0, F.element_at(F.col(f"{first}_sequence"), n)).alias("last_scaled"),
    )


def _stored_shards(spark, sf_dir):
    """The training orders as a trainer's shards, one round (keys only: the counts need no more)."""
    train, _ = _split(spark, sf_dir)
    return write_shards(train.select(KEY), spark, "orders-shards", KEY, N_SHARDS, 1, SEED)


def shard_counts(spark, sf_dir):
    """Rows per stored shard, from Parquet footers."""
    return shard_rows(spark, _stored_shards(spark, sf_dir)).select("shard", "n_rows")


def batch_counts(spark, sf_dir):
    """Batches of each stored shard, from Parquet footers."""
    rows = shard_rows(spark, _stored_shards(spark, sf_dir))
    return rows.select("shard", "n_rows", F.ceil(F.col("n_rows") / F.lit(BATCH_SIZE)).cast("long").alias("n_batches"))


CSV_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderdate", T.DateType()),
    T.StructField("o_totalprice", T.DoubleType()), T.StructField("c_acctbal", T.DoubleType()), T.StructField("is_household", T.StringType()),
])


def csv_panel(spark, sf_dir):
    """The orders panel written as CSV with a yes/no column, loaded and checked in one pass."""
    panel = orders_panel(spark, sf_dir).where("c_acctbal IS NOT NULL")
    path = scratch_path(spark, "orders-csv")
    (panel.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "c_acctbal",
                  F.when(F.col("is_household"), "Yes").otherwise("No").alias("is_household"))
     .write.option("header", True).csv(path))
    loaded, _ = load_csv_panel(spark, path, CSV_SCHEMA, flags={"is_household": "Yes"})
    return loaded.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def validate_roundtrip(spark, sf_dir):
    """Fit on train, write the validation set, read it back."""
    train, validate = _split(spark, sf_dir, orders_panel(spark, sf_dir))
    path = write_training_set(sequencer().fit(train).transform(validate), spark, "orders-validate", shuffle_key=KEY, seed=SEED)
    return _last_scaled(read_training_set(spark, path))


def preview_topk(spark, sf_dir, k: int = 5):
    """First k rows in entity/time order: a TakeOrdered, no global sort."""
    cols = [ORDERS.entity, *ORDERS.order_cols, "o_totalprice"]
    return orders_panel(spark, sf_dir, with_statics=False).select(*cols).orderBy(ORDERS.entity, *ORDERS.order_cols).limit(k)


QUERIES = {
    "panel_load": panel_load,
    "fit_stats": fit_stats,
    "scale_columns": scale_columns,
    "inverse_scale": inverse_scale,
    "collapse_mask": collapse_mask,
    "sequence_long": sequence_long,
    "mask_long": mask_long,
    "sequence_null_mask": sequence_null_mask,
    "history_len": history_len,
    "drop_cold_start": drop_cold_start,
    "assemble_long": assemble_long,
    "stacked_long": stacked_long,
    "distinct_entities": distinct_entities,
    "split_train": split_train,
    "split_validate": split_validate,
    "split_overlap": split_overlap,
    "csv_panel": csv_panel,
    "train_roundtrip": train_roundtrip,
    "validate_roundtrip": validate_roundtrip,
    "shard_counts": shard_counts,
    "batch_counts": batch_counts,
    "preview_topk": preview_topk,
}
