"""Scoring: forecasts joined to truth, error metrics per model.

All models are scored in ONE ``groupBy("model")`` over the union of their
forecasts, instead of one pass per model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import metric_columns
from .forecast import Columns
from .panel import melt

METRICS = ["MSE", "MAE", "RMSE", "MAPE", "R2"]


def combine(variants: Mapping[str, DataFrame], label: str = "model") -> DataFrame:
    """Label every variant's forecast rows and stack them (bag union)."""
    out = None
    for name, df in variants.items():
        tagged = df.withColumn(label, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def join_truth(pred: DataFrame, truth: DataFrame, cols: Columns = Columns(),
               target_name: str | None = None) -> DataFrame:
    """Forecasts of one target joined to the truth on (id, timestamp)."""
    name = target_name or cols.target
    p = pred.where(F.col("target_name") == name)
    t = truth.select(cols.id, cols.time, cols.target)
    return p.join(t, [cols.id, cols.time], "inner")


def score(pred: DataFrame, truth: DataFrame, cols: Columns = Columns(), null_policy: str = "propagate",
          by: Sequence[str] = ("model",), target_name: str | None = None) -> DataFrame:
    """``model, n, MSE, MAE, RMSE, MAPE, R2`` (+ ``n_valid`` with ``skip``)."""
    joined = join_truth(pred, truth, cols, target_name)
    return joined.groupBy(*by).agg(*metric_columns(cols.target, "predictions", null_policy))


def score_long(scores: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """``model, metric, value`` (NULL metrics kept)."""
    return melt(scores, list(by), METRICS, "metric", "value")
