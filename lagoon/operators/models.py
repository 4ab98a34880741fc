"""ML pipelines: boosted-tree forecasters, grouped cross-validation, logistic scores.

``boosted_forecaster`` passes missing lags and statics to histogram trees as they are;
each split learns the side of missing values (``operators/boost.py``).
``gbt_forecaster`` uses Spark ML's ``GBTRegressor`` (trained on blocks of binned rows,
``operators/gbt.py``), which rejects NaN features: missing lags enter as 0.0 plus
their 1 = missing mask flags.
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.functions.columns import rounded_zscore
from lagoon.operators.assemble import vector_assembler
from lagoon.operators.boost import HistBoost
from lagoon.operators.collapse import CollapseMask, FillMissing
from lagoon.operators.folds import fold_moments, stats_without
from lagoon.operators.gbt import BlockGBTRegressor
from lagoon.operators.lag import ScaledLag, ScaledLagModel, lag_names
from lagoon.operators.metrics import regression_metrics
from lagoon.operators.ranges import stored_parquet
from lagoon.operators.scaler import ColumnScaler, ColumnScalerModel
from lagoon.operators.stats import FeatureStats, validate_stats


def gbt_forecaster(entity: str, order_cols: Sequence[str], features: Sequence[str], label: str,
                   length: int, statics_to_scale: Sequence[str], flags: Sequence[str] = (),
                   max_iter: int = 100, max_depth: int = 5, seed: int = 42,
                   hot_entity_rows: int | None = None) -> Pipeline:
    """lags (+masks) -> static scaler -> missing statics flagged and filled -> assembler -> GBTRegressor, as one Pipeline."""
    lags = lag_names(features, length)
    statics = [*[f"{c}_scaled" for c in statics_to_scale], *flags]
    inputs = [*lags, *[f"{c}_mask" for c in lags], *statics, *[f"{c}_missing" for c in statics]]
    stages = [
        ScaledLag(partition_col=entity, order_cols=list(order_cols), sequence_feature_cols=list(features),
                  sequence_length=length, hot_entity_rows=hot_entity_rows),
        ColumnScaler(inputCols=list(statics_to_scale)),
        FillMissing(inputCols=statics),
        vector_assembler(inputs, "features", handle_invalid="keep"),
        BlockGBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                          maxIter=max_iter, maxDepth=max_depth, seed=seed),
    ]
    return Pipeline(stages=stages)


def boosted_forecaster(entity: str, order_cols: Sequence[str], features: Sequence[str], label: str, length: int,
                       statics_to_scale: Sequence[str], flags: Sequence[str] = (), max_iter: int = 100, max_depth: int = 5,
                       learning_rate: float = 0.1, hot_entity_rows: int | None = None) -> Pipeline:
    """lags -> padding back to null -> static scaler -> histogram trees that take nulls, as one Pipeline that saves whole."""
    lags = lag_names(features, length)
    return Pipeline(stages=[
        ScaledLag(partition_col=entity, order_cols=list(order_cols), sequence_feature_cols=list(features),
                  sequence_length=length, hot_entity_rows=hot_entity_rows),
        CollapseMask(inputCols=lags),
        ColumnScaler(inputCols=list(statics_to_scale)),
        HistBoost(inputCols=[*lags, *[f"{c}_scaled" for c in statics_to_scale], *flags], labelCol=label,
                  maxIter=max_iter, maxDepth=max_depth, learningRate=learning_rate),
    ])


def _scaled_inputs(stored: DataFrame, stats: FeatureStats, features: Sequence[str], length: int, statics_to_scale: Sequence[str],
                   flags: Sequence[str]) -> DataFrame:
    """Features of ``gbt_forecaster`` from stored raw lags, scaled by the given statistics."""
    lags = {f"{c}_lag_{i}": stats[c] for c in features for i in range(1, length + 1)}
    scaled = {lag: F.when(F.col(f"{lag}_mask") == 1, F.lit(0.0)).otherwise(rounded_zscore(lag, s["mean"], s["std"])) for lag, s in lags.items()}
    fixed = ColumnScalerModel(list(statics_to_scale), {c: stats[c] for c in statics_to_scale}).transform(stored.withColumns(scaled))
    statics = [*[f"{c}_scaled" for c in statics_to_scale], *flags]
    return FillMissing(inputCols=statics).transform(fixed)


def grouped_cv(panel: DataFrame, entity: str, order_cols: Sequence[str], features: Sequence[str], label: str, length: int,
               statics_to_scale: Sequence[str], flags: Sequence[str] = (), fold_col: str = "fold", num_folds: int = 3,
               parallelism: int = 2, max_iter: int = 100, max_depth: int = 5, seed: int = 42) -> tuple[PipelineModel, list[float]]:
    """k-fold CV of the boosted forecaster over entity folds, and the model fitted on all rows.

    The panel with its raw lags is computed once and stored: folds hold whole entities, so
    lags never cross them.  One aggregate gives the moments of all folds; each fold's model is
    scaled by the statistics of the other folds (``folds.stats_without``), as a refit would.
    Returns the fitted pipeline (lags, scaling, filling, assembling, trees) and the folds' rmse.
    """
    features, order_cols, statics_to_scale = list(features), list(order_cols), list(statics_to_scale)
    raw = ScaledLagModel(partition_col=entity, order_cols=order_cols, sequence_feature_cols=features, sequence_length=length,
                         no_scaling_cols=features, feature_stats={}).transform(panel)
    stored = stored_parquet(raw, "cv-lags")
    moments = fold_moments(stored, [*features, *statics_to_scale], fold_col)
    lags = lag_names(features, length)
    statics = [*[f"{c}_scaled" for c in statics_to_scale], *flags]
    assembler = vector_assembler([*lags, *[f"{c}_mask" for c in lags], *statics, *[f"{c}_missing" for c in statics]],
                                 "features", handle_invalid="keep")
    trees = BlockGBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", maxIter=max_iter, maxDepth=max_depth, seed=seed)

    def fit(fold: int | None):
        stats = validate_stats(stats_without(moments, fold))
        inputs = assembler.transform(_scaled_inputs(stored, stats, features, length, statics_to_scale, flags))
        if fold is None:
            model = trees.fit(inputs)
            return PipelineModel([
                ScaledLagModel(partition_col=entity, order_cols=order_cols, sequence_feature_cols=features, sequence_length=length,
                               feature_stats={c: stats[c] for c in features}),
                ColumnScalerModel(statics_to_scale, {c: stats[c] for c in statics_to_scale}),
                FillMissing(inputCols=statics), assembler, model])
        model = trees.fit(inputs.where(F.col(fold_col) != fold))
        return regression_metrics(model.transform(inputs.where(F.col(fold_col) == fold)), label, "prediction", None).first()["rmse"]

    with ThreadPool(parallelism) as pool:
        out = pool.map(inheritable_thread_target(panel.sparkSession)(fit), [*range(num_folds), None])
    return out[-1], out[:-1]


def grouped_cross_validator(pipeline: Pipeline, label: str, fold_col: str = "fold", num_folds: int = 3,
                            parallelism: int = 2, seed: int = 42) -> CrossValidator:
    """k-fold CV with folds given by a column (entity-hash folds keep histories whole)."""
    return CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse"),
        numFolds=num_folds, parallelism=parallelism, seed=seed, foldCol=fold_col,
    )


def logistic_scorer(feature_cols: Sequence[str], label: str) -> Pipeline:
    """assembler -> std scaling without centring -> logistic regression."""
    return Pipeline(stages=[
        vector_assembler(feature_cols, "features"),
        StandardScaler(inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=False),
        LogisticRegression(featuresCol="scaledFeatures", labelCol=label, predictionCol="prediction",
                           rawPredictionCol="rawPrediction", probabilityCol="probability"),
    ])

