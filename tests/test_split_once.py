"""The splits behind the model queries are written once."""

import io
from contextlib import redirect_stdout

from attrix.plans import q_models as Q


def test_passes_over_the_split_do_not_rank_again(spark, monkeypatch):
    rows = [(i, "Yes" if i % 3 else "No") for i in range(60)]
    monkeypatch.setattr(Q, "clean", lambda spark, sf: spark.createDataFrame(rows, "customerID long, Churn string"))
    one, two = Q._split(spark, "/tmp/none-split-once"), Q._split(spark, "/tmp/none-split-once")
    assert one is two and one.count() == 60
    assert {r["split"]: r["count"] for r in one.groupBy("split").count().collect()} == {"train": 36, "val": 12, "test": 12}
    said = io.StringIO()
    with redirect_stdout(said):
        one.explain()
    assert "Window" not in said.getvalue() and "parquet" in said.getvalue()
