"""Distributed running sums and exact quantiles: any number of buckets must
give the same rows, and pandas' numbers."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from attrix.operators.ranking import exact_quantiles, running_sum, scalar_quantiles


def test_running_sum_bucketed_equals_single(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "x": rng.normal(size=3000).round(2), "w": rng.integers(1, 5, 3000)})
    df = spark.createDataFrame(pdf).groupBy("g", "x").agg(F.sum("w").alias("w"))
    a = running_sum(df, "x", ["w"], by=["g"], buckets=1).orderBy("g", "x").toPandas()
    b = running_sum(df, "x", ["w"], by=["g"], buckets=50).orderBy("g", "x").toPandas()
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b[a.columns].reset_index(drop=True))
    exp = pdf.groupby(["g", "x"]).w.sum().groupby(level=0).cumsum().reset_index()
    assert list(a.cum_w) == list(exp.w)


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(0, 50, 500).astype(float), [np.nan] * 5])
    pdf = pd.DataFrame({"g": ["a"] * 250 + ["b"] * 255, "x": vals})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 1.0]
    got = scalar_quantiles(df, "x", probs)
    assert np.allclose(got, pdf.x.quantile(probs).values)
    got_big = scalar_quantiles(df, "x", probs, buckets=50)
    assert np.allclose(got_big, got)
    per = exact_quantiles(df, "x", [0.5], by=["g"]).toPandas().set_index("g")["value"]
    assert np.allclose(per.sort_index().values, pdf.groupby("g").x.quantile(0.5).sort_index().values)


def test_hot_value_collapses(spark):
    # a third of all rows share one value: still one row per distinct value
    xs = [5.0] * 1000 + [float(i) for i in range(2000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert scalar_quantiles(df, "x", [0.5], buckets=50)[0] == float(np.quantile(xs, 0.5))


def test_auc_and_curves_bucketed_path(spark):
    from attrix.operators import metrics as M

    rng = np.random.default_rng(11)
    rows = [("m" + str(i % 2), int(rng.random() < 0.3), float(np.round(rng.random(), 3))) for i in range(4000)]
    preds = spark.createDataFrame(rows, "model string, label int, probability double")
    a = {r.model: r.roc_auc for r in M.roc_auc(preds).collect()}
    b = {r.model: r.roc_auc for r in M.roc_auc(preds, buckets=40).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)
    pa = M.roc_points(preds).orderBy("model", "threshold").toPandas()
    pb = M.roc_points(preds, buckets=40).orderBy("model", "threshold").toPandas()
    pd.testing.assert_frame_equal(pa, pb)


def test_null_groups_and_odd_values_at_any_bucket_count(spark):
    nan = float("nan")
    rows = [(g, x, 1) for g in ("a", None, "b") for x in (None, nan, 1.0, 1.5, 2.0, 7.0, -3.0, float("inf"))]
    df = spark.createDataFrame([*rows, ("c", None, 4), ("d", nan, 5), ("e", 2.0, 6)], "g string, x double, w int")
    got = []
    for n in (1, 2, 50):
        out = running_sum(df, "x", ["w"], by=["g"], buckets=n, with_total=True).collect()
        got.append(sorted((str(r.g), str(r.x), r.cum_w, r.tot_w) for r in out))
    assert got[0] == got[1] == got[2] and len(got[0]) == 27
    per = {(r[0], r[1]): r[2] for r in got[0]}
    assert per["None", "None"] == 1 and per["None", "nan"] == 8 and per["a", "inf"] == 7 and per["c", "None"] == 4


def test_split_keeps_rows_without_label(spark):
    from attrix.operators.split import stratified_split

    df = spark.createDataFrame([(i, None if i % 3 == 0 else str(i % 3)) for i in range(1000)], "id long, y string")
    parts = [stratified_split(df, "y", "id", 20, 20, buckets=n).collect() for n in (1, 2, 50)]
    assert all(len(p) == 1000 for p in parts)
    assert sorted(map(tuple, parts[0]), key=str) == sorted(map(tuple, parts[1]), key=str) == sorted(map(tuple, parts[2]), key=str)


def test_auc_of_a_null_model(spark):
    from attrix.operators import metrics as M

    preds = spark.createDataFrame([(None, i % 2, i / 10) for i in range(10)], "model string, label int, probability double")
    for n in (1, 2, 50):
        assert len(M.roc_auc(preds, buckets=n).collect()) == 1
