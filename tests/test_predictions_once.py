"""Metrics read a model's predictions several times; rows are scored once."""

from attrix.plans import flow
from attrix.plans import q_models as Q


def test_rows_are_scored_once_for_all_metrics(spark, monkeypatch):
    calls = []
    rows = spark.createDataFrame([("m", f"c{i}", i % 2, i / 10, int(i > 5)) for i in range(10)], "model string, customerID string, label int, probability double, prediction int")
    monkeypatch.setattr(Q, "parts", lambda *a: ("train", "val", "test"))
    monkeypatch.setattr(Q, "trained", lambda *a: {"m": None})
    monkeypatch.setattr(flow, "predictions", lambda models, data, key, label: calls.append(data) or rows)
    got = [Q.model_predictions(spark, "no such folder") for _ in range(2)]
    assert calls == ["test"] and sorted(got[1].collect()) == sorted(rows.collect())
    assert "FileScan parquet" in got[0]._jdf.queryExecution().executedPlan().toString()
    assert Q.model_predictions(spark, "no such folder", "val").count() == 10 and calls == ["test", "val"]
