"""Plot-frame assembly — the data side of the forecast charts.

For every series: the last ``history_length`` context rows, the truth
trimmed to the forecast timestamps, and the forecast with its interval, as
one long frame ``id, timestamp, series, value, lower, upper``.  Drawing is
left to the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .forecast import Columns


def plot_frame(context: DataFrame, pred: DataFrame, truth: DataFrame, cols: Columns = Columns(),
               history_length: int = 256, lower: str = "q10", upper: str = "q90",
               target_name: str | None = None, by: str | None = None, ids: Sequence | None = None) -> DataFrame:
    """``by`` names a label column of ``pred`` (the model): every label gets a frame of its own, from one pass
    over the history and the truth.  ``ids`` keeps the given series only (F5), before anything is shuffled."""
    i, t, y = cols.id, cols.time, cols.target
    name = target_name or y
    if ids is not None:
        context, pred, truth = (df.where(F.col(i).isin(list(ids))) for df in (context, pred, truth))
    label = [by] if by else []
    # Last N rows per series (a per-series window; N is the plot viewport).
    w = Window.partitionBy(i).orderBy(F.col(t).desc())
    hist = (context.select(i, t, y).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= history_length).drop("_rn"))
    cutoff = hist.groupBy(i).agg(F.min(t).alias("_cut"))
    # one target; F6: at or after the history cut-off.
    fc = (pred.where(F.col("target_name") == name)
          .join(cutoff, i).where(F.col(t) >= F.col("_cut")))
    # truth trimmed to the forecast timestamps, once a label.
    tr = truth.select(i, t, y).join(fc.select(i, t, *label).distinct(), [i, t])
    if by:  # the labels of a series' forecasts: as many as there are models
        labels = pred.where(F.col("target_name") == name).groupBy(i).agg(F.collect_set(by).alias("_by"))
        hist = hist.join(labels, i).select(i, t, y, F.explode("_by").alias(by))
    null = F.lit(None).cast("double")
    return (hist.select(i, t, F.lit("history").alias("series"), F.col(y).alias("value"),
                        null.alias("lower"), null.alias("upper"), *label)
            .unionByName(tr.select(i, t, F.lit("truth").alias("series"), F.col(y).alias("value"),
                                   null.alias("lower"), null.alias("upper"), *label))
            .unionByName(fc.select(i, t, F.lit("forecast").alias("series"),
                                   F.col("predictions").alias("value"),
                                   F.col(lower).alias("lower"), F.col(upper).alias("upper"), *label)))
