"""Registered queries over the events panel (entity = user)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from lagoon.operators.lag import ScaledLag, lag_names
from lagoon.operators.lookback import lookback
from lagoon.operators.metrics import (auc_by_rank as _auc, batch_losses, mae_percent_of_mean,
                                      mean_batch_loss as _mean_batch_loss,
                                      regression_metrics as _regression_metrics,
                                      weighted_loss as _weighted_loss)
from lagoon.plans.common import BATCH_SIZE, EVENT_FEATURES, N_SHARDS, SEED, SEQ_LEN
from lagoon.session import scratch_path
from lagoon.sources.panels import EVENTS, events_panel

KEY = EVENTS.row_key


def lag_stage(no_scaling_cols=None) -> ScaledLag:
    return ScaledLag(partition_col=EVENTS.entity, order_cols=list(EVENTS.order_cols),
                     sequence_feature_cols=EVENT_FEATURES, sequence_length=SEQ_LEN,
                     no_scaling_cols=no_scaling_cols or [])


def _lag_output(df):
    names = lag_names(EVENT_FEATURES, SEQ_LEN)
    cols = [c for n in names for c in (n, f"{n}_mask")]
    return df.select(KEY, *cols)


def lag_scaled(spark, sf_dir):
    events = events_panel(spark, sf_dir)
    return _lag_output(lag_stage().fit(events).transform(events))


def lag_unscaled(spark, sf_dir):
    events = events_panel(spark, sf_dir)
    return _lag_output(lag_stage(no_scaling_cols=EVENT_FEATURES).fit(events).transform(events))


def model_roundtrip(spark, sf_dir):
    """Fit the lag stage in a pipeline, save it, load it back and score with the loaded copy."""
    events = events_panel(spark, sf_dir)
    fitted = Pipeline(stages=[lag_stage()]).fit(events)
    path = scratch_path(spark, "lag-pipeline")
    fitted.write().overwrite().save(path)
    return _lag_output(PipelineModel.load(path).transform(events))


def moving_mean_forecast(spark, sf_dir):
    """Events with ``prediction`` = mean of the previous N values of the same user."""
    events = events_panel(spark, sf_dir)
    return lookback(events, EVENTS.entity, EVENTS.order_cols, SEQ_LEN,
                    lambda w: [F.avg("value").over(w.rowsBetween(-SEQ_LEN, -1)).alias("prediction")])


def regression_metrics(spark, sf_dir):
    return _regression_metrics(moving_mean_forecast(spark, sf_dir), "value", "prediction")


def mae_pct_of_mean(spark, sf_dir):
    return mae_percent_of_mean(moving_mean_forecast(spark, sf_dir), "value", "prediction")


def _batches(spark, sf_dir):
    return batch_losses(moving_mean_forecast(spark, sf_dir), KEY, "value", "prediction",
                        N_SHARDS, BATCH_SIZE, SEED)


def weighted_loss(spark, sf_dir):
    return _weighted_loss(_batches(spark, sf_dir))


def mean_batch_loss(spark, sf_dir):
    return _mean_batch_loss(_batches(spark, sf_dir))


def auc_by_rank(spark, sf_dir):
    events = events_panel(spark, sf_dir)
    return _auc(events, (F.col("event_type") == "error").cast("int"), F.col("value"))


QUERIES = {
    "lag_scaled": lag_scaled,
    "lag_unscaled": lag_unscaled,
    "model_roundtrip": model_roundtrip,
    "regression_metrics": regression_metrics,
    "mae_pct_of_mean": mae_pct_of_mean,
    "weighted_loss": weighted_loss,
    "mean_batch_loss": mean_batch_loss,
    "auc_by_rank": auc_by_rank,
}
