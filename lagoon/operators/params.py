"""Shared ML params for the custom stages.

Every constructor argument is optional and every fitted value (statistics
included) is a param, so ``DefaultParamsReader`` can rebuild any saved stage
from its JSON line with a no-argument constructor.
"""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters

from lagoon.operators.lookback import DEFAULT_BUCKET_ROWS, DEFAULT_HOT_ROWS


def _to_str_list(value):
    if isinstance(value, str):
        return [value]
    return TypeConverters.toListString(value)


class StageParams(Params):
    """Set params from keyword arguments, skipping ``None``."""

    def _set_from(self, **kwargs) -> None:
        values = {k: v for k, v in kwargs.items() if v is not None}
        if values:
            self._set(**values)

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))


class HasInputCols(StageParams):
    inputCols = Param(Params._dummy(), "inputCols", "Input column names.", _to_str_list)


class HasFeatureStats(StageParams):
    feature_stats = Param(Params._dummy(), "feature_stats",
                          "Fitted statistics {column: {mean, std}}.")

    def column_stats(self, name: str) -> dict:
        """The fitted ``{mean, std}`` of a column; a ``ValueError`` lists what was fitted instead."""
        fitted = self.getOrDefault(self.feature_stats) or {}
        try:
            return fitted[name]
        except KeyError:
            raise ValueError(f"no statistics were fitted for {name!r}; known: {sorted(fitted)}") from None


class HasPanelParams(StageParams):
    partition_col = Param(Params._dummy(), "partition_col", "Entity column to partition by.",
                          TypeConverters.toString)
    order_cols = Param(Params._dummy(), "order_cols",
                       "Columns ordering rows inside an entity; the last one should break ties.",
                       _to_str_list)
    sequence_length = Param(Params._dummy(), "sequence_length", "Number of past rows N.",
                            TypeConverters.toInt)
    hot_entity_rows = Param(Params._dummy(), "hot_entity_rows",
                            "Entities with more rows are split into time buckets (0 disables).",
                            TypeConverters.toInt)
    bucket_rows = Param(Params._dummy(), "bucket_rows", "Target rows per bucket of a hot entity.",
                        TypeConverters.toInt)

    def _panel_defaults(self) -> None:
        self._setDefault(sequence_length=1, hot_entity_rows=DEFAULT_HOT_ROWS,
                         bucket_rows=DEFAULT_BUCKET_ROWS)
