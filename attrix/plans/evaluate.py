"""Evaluation of every model in one long predictions table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import metrics as M


def evaluate_all(preds: DataFrame, by=("model",)) -> DataFrame:
    """Per model: metrics, ROC AUC, Brier score and the F1-rule threshold."""
    comp = M.comparison(preds, by)
    brier = M.brier(preds, by)
    thr = M.optimize_threshold(preds, "f1", by=by).withColumnRenamed("threshold", "f1_threshold").drop("metric")
    return comp.join(brier, list(by)).join(thr, list(by))
