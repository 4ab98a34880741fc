"""Registered training queries: boosted trees, grouped CV, logistic scores, sequence net."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lagoon.functions.arrays import float_array
from lagoon.operators import seqnet
from lagoon.operators.assemble import stack_sequences
from lagoon.operators.collapse import FillMissing
from lagoon.operators.folds import fold_moments, stats_without
from lagoon.operators.lag import lag_names
from lagoon.operators.metrics import auc_by_rank, batch_losses, mean_batch_loss, regression_metrics, weighted_loss
from lagoon.operators.models import boosted_forecaster, gbt_forecaster, grouped_cv, logistic_scorer
from lagoon.operators.ranges import stored_parquet
from lagoon.operators.scaler import ColumnScaler
from lagoon.operators.split import entity_split, row_split, with_folds
from lagoon.plans.common import (BATCH_SIZE, EVENT_FEATURES, ORDER_FEATURES, ORDER_STATS_COLS, SEED, SEQ_LEN,
                                 STATIC_INPUTS, STATIC_SCALED, VALIDATION_PERCENT)
from lagoon.plans.events import lag_stage
from lagoon.plans.orders import sequencer
from lagoon.session import scratch_path
from lagoon.sources.panels import EVENTS, ORDERS, events_panel, orders_panel
from lagoon.sources.training_sets import read_training_set, write_shards

KEY = ORDERS.row_key
GBT_TREES = 100
BOOST_TREES, BOOST_DEPTH, BOOST_RATE = 20, 4, 0.3
SEQNET_EPOCHS = 6
SEQNET_SHARDS = 8
SEQNET_BATCH = 2 * BATCH_SIZE    # rows of a step over all shards: the original workflow has two workers
SEQNET_SYNC_EVERY = 64


def _gbt():
    return gbt_forecaster(ORDERS.entity, ORDERS.order_cols, ORDER_FEATURES, "o_totalprice", SEQ_LEN,
                          ["c_acctbal", "c_nationkey"], flags=["is_household"], max_iter=GBT_TREES, seed=SEED)


def _stored_panel(spark, sf_dir):
    """The orders panel, joined once: fits and scores read it many times."""
    return stored_parquet(orders_panel(spark, sf_dir), "panel")


def gbt_forecast(spark, sf_dir):
    """Fit on training customers, predict the validation customers' orders."""
    train, validate = entity_split(_stored_panel(spark, sf_dir), ORDERS.entity, VALIDATION_PERCENT, SEED)
    model = _gbt().fit(train)
    return model.transform(validate).select(KEY, "o_totalprice", "prediction")


def _boost_model(spark, sf_dir, train):
    """The forecaster that this application has fitted on ``sf_dir``, read from its folder; fitted and saved first if there is none."""
    known = spark.sparkContext.__dict__.setdefault("_lagoon_boosts", {})
    if sf_dir not in known:
        pipeline = boosted_forecaster(ORDERS.entity, ORDERS.order_cols, ORDER_FEATURES, "o_totalprice", SEQ_LEN,
                                      ["c_acctbal", "c_nationkey"], ["is_household"], BOOST_TREES, BOOST_DEPTH, BOOST_RATE)
        path = scratch_path(spark, "boost-model")
        pipeline.fit(train).write().overwrite().save(path)
        known[sf_dir] = path
    return PipelineModel.load(known[sf_dir])


def boost_forecast(spark, sf_dir):
    """Validation customers' orders predicted by the saved and reloaded forecaster, whose trees take missing values."""
    train, validate = entity_split(orders_panel(spark, sf_dir), ORDERS.entity, VALIDATION_PERCENT, SEED)
    return _boost_model(spark, sf_dir, train).transform(validate).select(KEY, "o_totalprice", "prediction")


def boost_eval(spark, sf_dir):
    """Validation metrics of the saved and reloaded forecaster."""
    return regression_metrics(boost_forecast(spark, sf_dir), "o_totalprice", "prediction").select("n", "rmse", "mae", "r2")


def gbt_cv(spark, sf_dir):
    """3 entity folds, parallelism 2; fold metric and validation metrics of the best model."""
    train, validate = entity_split(_stored_panel(spark, sf_dir), ORDERS.entity, VALIDATION_PERCENT, SEED)
    model, rmse = grouped_cv(with_folds(train, ORDERS.entity, 3, SEED), ORDERS.entity, ORDERS.order_cols, ORDER_FEATURES,
                             "o_totalprice", SEQ_LEN, ["c_acctbal", "c_nationkey"], ["is_household"], max_iter=GBT_TREES, seed=SEED)
    metrics = regression_metrics(model.transform(validate), "o_totalprice", "prediction")
    return metrics.select(F.lit(float(sum(rmse) / len(rmse))).alias("cv_rmse"), "n", "rmse", "mae", "r2")


def fold_stats(spark, sf_dir):
    """Mean and std that each fold's model sees (the other folds' rows), from one aggregate over all folds."""
    train, _ = entity_split(orders_panel(spark, sf_dir), ORDERS.entity, VALIDATION_PERCENT, SEED)
    moments = fold_moments(with_folds(train, ORDERS.entity, 3, SEED), ORDER_STATS_COLS)
    rows = [(f, c, s["mean"], s["std"]) for f in sorted(moments) for c, s in stats_without(moments, f).items()]
    out = spark.createDataFrame(rows, "fold int, col string, mean double, std double")
    return out.select("fold", "col", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def row_split_test(spark, sf_dir):
    """The 20 % of events that the logistic model is tested on."""
    return row_split(events_panel(spark, sf_dir), EVENTS.row_key, 20, SEED)[1].select(EVENTS.row_key, EVENTS.entity)


def entity_folds(spark, sf_dir):
    """The fold of every customer in cross-validation."""
    train, _ = entity_split(orders_panel(spark, sf_dir, with_statics=False), ORDERS.entity, VALIDATION_PERCENT, SEED)
    return with_folds(train, ORDERS.entity, 3, SEED).groupBy(ORDERS.entity, "fold").agg(F.count(F.lit(1)).alias("n_rows"))


def _logit(spark, sf_dir):
    events = events_panel(spark, sf_dir)
    # The lags of a test row may reach into training rows, the statistics may not see test rows.
    known, _ = row_split(events, EVENTS.row_key, 20, SEED)
    lagged = lag_stage().fit(known).transform(events).withColumn(
        "label", (F.col("event_type") == "error").cast("double"))
    lags = lag_names(EVENT_FEATURES, SEQ_LEN)
    train, test = row_split(lagged, EVENTS.row_key, 20, SEED)
    scored = logistic_scorer([*lags, *[f"{c}_mask" for c in lags], "value"], "label").fit(train).transform(test)
    return scored.select(EVENTS.row_key, "label", "prediction", vector_to_array("probability")[1].alias("p_error"),
                         vector_to_array("rawPrediction")[1].alias("raw_error"))


def logit_scores(spark, sf_dir):
    """P(event is an error) from the user's recent values, with its raw score; 80/20 row split."""
    return _logit(spark, sf_dir)


def logit_auc(spark, sf_dir):
    """AUC of the logistic model's raw score on its test rows."""
    return auc_by_rank(_logit(spark, sf_dir), "label", "raw_error")


# ------------------------------------------------------------------ sequence net

NET_STATICS = [*STATIC_INPUTS, *[f"{c}_missing" for c in STATIC_INPUTS]]
SHAPE = seqnet.NetShape(n_features=len(ORDER_FEATURES), n_statics=len(NET_STATICS))


def _model_inputs(scaler, seq_model, df):
    feats = FillMissing(inputCols=STATIC_INPUTS).transform(seq_model.transform(scaler.transform(df)))
    steps, _ = stack_sequences(ORDER_FEATURES, SEQ_LEN)
    return feats.select(
        KEY, ORDERS.entity,
        steps.alias("steps"),
        # Slots in use, not values present: the mask policy keeps a slot for a null.
        F.col(f"{ORDER_FEATURES[0]}_history_len").alias("length"),
        float_array(NET_STATICS).alias("statics"),
        F.col("o_totalprice_scaled").alias("target"),
    )


def _split_inputs(spark, sf_dir):
    """Model inputs of the training and validation customers, from statistics of the training ones; and the scaler."""
    train, validate = entity_split(_stored_panel(spark, sf_dir), ORDERS.entity, VALIDATION_PERCENT, SEED)
    scaler = ColumnScaler(inputCols=STATIC_SCALED).fit(train)
    seq_model = sequencer(null_policy="mask", emit_history_len=True).fit(train)
    return _model_inputs(scaler, seq_model, train), _model_inputs(scaler, seq_model, validate), scaler


def _fit_seqnet(spark, train, epochs=SEQNET_EPOCHS, shards=SEQNET_SHARDS, sync_every=SEQNET_SYNC_EVERY):
    """Train on stored shards and save the net: its epochs and the path of the model."""
    rounds = seqnet.round_count(train.count(), SEQNET_BATCH, sync_every)     # the count needs no history
    path = write_shards(train, spark, "seqnet-train", KEY, shards, rounds, SEED)
    result = seqnet.train(spark, read_training_set(spark, path), SHAPE, SEQ_LEN, rounds, epochs, sync_every, seed=SEED)
    saved = scratch_path(spark, "seqnet-model")
    seqnet.SeqNetModel.of(SHAPE, SEQ_LEN, result.params).write().overwrite().save(saved)
    return result.epochs, saved


def _net_model(spark, sf_dir, train):
    """The net that this application has trained on ``sf_dir``, read from its folder; trained first if there is none."""
    known = spark.sparkContext.__dict__.setdefault("_lagoon_nets", {})
    if sf_dir not in known:
        known[sf_dir] = _fit_seqnet(spark, train)[1]
    return seqnet.SeqNetModel.load(known[sf_dir])


def seqnet_train(spark, sf_dir):
    """Loss per epoch of the synchronously trained sequence net; the net is saved."""
    epochs, saved = _fit_seqnet(spark, _split_inputs(spark, sf_dir)[0])
    spark.sparkContext.__dict__.setdefault("_lagoon_nets", {})[sf_dir] = saved
    return spark.createDataFrame(epochs, "epoch int, weighted_loss double, n_rows long, n_batches long")


def seqnet_score(spark, sf_dir):
    """Validation predictions of the saved net, back in the target's own units; the label is not read."""
    train, validate, scaler = _split_inputs(spark, sf_dir)
    scored = _net_model(spark, sf_dir, train).transform(validate.select(KEY, "steps", "length", "statics"))
    back = scaler.inverse(F.col("prediction"), "o_totalprice")
    return scored.select(KEY, F.col("prediction").alias("prediction_scaled"), back.alias("prediction"))


def seqnet_eval(spark, sf_dir):
    """Validation loss of the saved net in scaled units: the mean of batch means, and by rows."""
    train, validate, _ = _split_inputs(spark, sf_dir)
    scored = _net_model(spark, sf_dir, train).transform(validate.select(KEY, "steps", "length", "statics", "target"))
    batches = batch_losses(scored, KEY, "target", "prediction", 1, BATCH_SIZE, SEED)
    return mean_batch_loss(batches).crossJoin(weighted_loss(batches))         # one row each


QUERIES = {
    "gbt_forecast": gbt_forecast,
    "gbt_cv": gbt_cv,
    "boost_forecast": boost_forecast,
    "boost_eval": boost_eval,
    "fold_stats": fold_stats,
    "row_split_test": row_split_test,
    "entity_folds": entity_folds,
    "logit_scores": logit_scores,
    "logit_auc": logit_auc,
    "seqnet_train": seqnet_train,
    "seqnet_score": seqnet_score,
    "seqnet_eval": seqnet_eval,
}
