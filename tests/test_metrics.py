"""Metric operators on hand-made predictions."""

import pytest

from attrix.operators import metrics as M


def _preds(spark, rows):
    return spark.createDataFrame(rows, "model string, label int, probability double, prediction int")


def test_confusion_zero_filled_when_a_class_is_empty(spark):
    p = _preds(spark, [("m", 0, 0.1, 0), ("m", 0, 0.7, 1)])
    got = {(r.actual, r.predicted): r["count"] for r in M.confusion(p).collect()}
    assert got == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 0}
    m = M.metrics(p).first()
    assert (m.precision, m.recall, m.f1_score) == (0.0, 0.0, 0.0)


def test_threshold_rules(spark):
    rows = [("m", 1, 0.9, 1), ("m", 1, 0.8, 1), ("m", 0, 0.8, 1), ("m", 0, 0.3, 0), ("m", 1, 0.2, 0)]
    p = _preds(spark, rows)
    f1 = M.optimize_threshold(p, "f1", min_recall=0.75).first().threshold
    # recall >= .75 only at t <= 0.2 (recall 1): precision 3/5 -> t = 0.2
    assert f1 == 0.2
    assert M.optimize_threshold(p, "f1", min_recall=1.01).first().threshold == 0.5  # nothing valid -> default
    rec = M.optimize_threshold(p, "recall").first().threshold
    assert rec == 0.2  # precision 0.6 >= .5 with full recall


def test_calibration_right_closed(spark):
    p = _preds(spark, [("m", 0, 0.0, 0), ("m", 1, 0.1, 0), ("m", 1, 0.1000001, 0), ("m", 0, 1.0, 1)])
    got = {r.bin: r["count"] for r in M.calibration(p).collect()}
    assert got == {0: 2, 1: 1, 9: 1}


def test_best_model_first_max_wins(spark):
    comp = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.4)], "model string, f1_score double")
    assert M.best_model(comp, "f1_score", ["b", "a", "c"]).first().model == "b"


def test_brier(spark):
    p = _preds(spark, [("m", 1, 0.8, 1), ("m", 0, 0.4, 0)])
    assert M.brier(p).first().brier_score == pytest.approx((0.04 + 0.16) / 2)
