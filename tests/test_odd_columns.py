"""Columns without values, NaN text, equal fold scores, p-value rounding,
duplicate rows, several groups of edges: each has a defined result."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrix.functions import columns as C
from attrix.operators import profile as PR
from attrix.operators import ranking as RK
from attrix.operators import rates as R
from attrix.operators import split as SP
from attrix.operators import stats as ST


@pytest.fixture(scope="module")
def holed(spark):
    rows = [(i, float(i % 7) if i % 5 else None, None, "Yes" if i % 3 == 0 else "No") for i in range(60)]
    return spark.createDataFrame(rows, "id long, x double, hole double, Churn string")


def test_a_column_without_values_keeps_its_rows(holed):
    out = {r.Feature: r for r in PR.outliers_iqr(holed, ["x", "hole"]).collect()}
    assert out["hole"].Outlier_Count == 0 and out["hole"].Lower_Bound is None and out["x"].Lower_Bound is not None
    for cols in (["x", "hole"], ["hole"]):
        bins = R.nonlinear_bins(holed, "Churn", cols).collect()
        assert len(bins) == 9 * len(cols) and all(r.Bin_Low is None and r.Churn_Rate is None for r in bins if r.Feature == "hole")
    types = {r.Column: r for r in PR.types_report(holed).collect()}
    assert types["hole"].Unique_Values == 0 and types["hole"].Sample_Values is None
    assert types["id"].Sample_Values == "0, 1, 2" and types["x"].Sample_Values == "0.0, 1.0, 2.0"


def test_nan_text_is_no_value(spark):
    df = spark.createDataFrame([("1",), ("2",), ("4",), ("NaN",), (" ",), ("x",), (None,)], "t string").select(C.to_number("t").alias("x"))
    assert sorted(r.x for r in df.where("x is not null").collect()) == [1.0, 2.0, 4.0]
    assert RK.scalar_quantiles(df, "x", [0.5]) == [2.0]


def test_p_value_rule(spark):
    df = spark.createDataFrame([(0.123456, 12345.678), (0.0000123456, 1.23456), (None, None), (0.0, 999.999)], "P_Value double, other double")
    got = [tuple(r) for r in C.round_table(df).collect()]
    assert got == [(0.1235, 12345.7), (1.2346e-05, 1.23), (None, None), (0.0, 1000.0)]


def test_duplicates_by_digest(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 1, "a"), (1, None, "a"), (None, None, None), (None, None, None)], "x int, y int, z string")
    assert {r.Metric: r.Value for r in PR.overview(df).collect()} == {"Total Rows": 5, "Total Columns": 3, "Duplicate Rows": 2, "Missing Values (Total)": 9 }


def test_anova_of_a_large_mean(spark):
    rng = np.random.default_rng(1)
    y = np.arange(200) % 2
    x = rng.normal(size=200) + y
    df = spark.createDataFrame([(float(1e9 + a), float(a), "Yes" if b else "No") for a, b in zip(x, y)], "far double, near double, Churn string")
    f = {r.Feature: r.F_Statistic for r in ST.anova_f(df, ["far", "near"], "Churn").collect()}
    assert f["far"] == pytest.approx(f["near"], rel=1e-5)


def knn_information(x, y, k=3):
    harmonic = np.concatenate([[0], np.cumsum(1 / np.arange(1, len(x) + 3))])
    psi = lambda n: harmonic[n - 1] - 0.5772156649015329
    used = [i for i in range(len(x)) if (y == y[i]).sum() > 1]
    total = 0.0
    for i in used:
        own = np.flatnonzero((y == y[i]) & (np.arange(len(x)) != i))
        kk = min(k, len(own))
        r = np.sort(np.abs(x[own] - x[i]))[kk - 1]
        m = sum(abs(x[j] - x[i]) < r for j in used)
        total += psi(kk) - psi(len(own) + 1) - psi(m)
    return max(0.0, psi(len(used)) + total / len(used))


@pytest.mark.parametrize("block", [7, 100_000])
def test_information_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ST, "BLOCK_RANKS", block)
    rng = np.random.default_rng(3)
    n = 500
    y = (rng.random(n) < 0.3).astype(int)
    cols = {"near": rng.normal(size=n) + 2 * y, "free": rng.random(n)}
    rows = [(i, *(float(c[i]) for c in cols.values()), "Yes" if y[i] else "No") for i in range(n)]
    df = spark.createDataFrame(rows, "id long, near double, free double, Churn string").repartition(4)
    got = {r.Feature: r.Mutual_Information for r in ST.mutual_info(df, list(cols), "Churn", key="id").collect()}
    for name, x in cols.items():
        assert got[name] == pytest.approx(knn_information(x, y), abs=1e-6)
    # a column of few values: near the information of the table itself
    ties = df.select("id", F.when(F.col("Churn") == "Yes", F.col("id") % 2).otherwise(F.col("id") % 5).cast("double").alias("t"), "Churn")
    cells = {(r.t, r.Churn): r["count"] for r in ties.groupBy("t", "Churn").count().collect()}
    px, py = {}, {}
    for (t, c), m in cells.items():
        px[t], py[c] = px.get(t, 0) + m, py.get(c, 0) + m
    plain = sum(m / n * np.log(m * n / (px[t] * py[c])) for (t, c), m in cells.items())
    assert ST.mutual_info(ties, ["t"], "Churn", key="id").first().Mutual_Information == pytest.approx(plain, abs=0.06)


def test_seeds_give_other_orders(spark):
    df = spark.range(2000).select("id", F.col("id").cast("string").alias("name"))
    a, b = ([r.id for r in df.orderBy(SP.seeded_hash("id", s)).collect()] for s in (42, 43))
    turn = {(b.index(x) - i) % 2000 for i, x in enumerate(a[:50])}
    assert len(turn) > 40  # no rotation
    assert [r.id for r in df.orderBy(SP.seeded_hash("name", 42)).collect()] == a


@pytest.mark.parametrize("most", [0, 200])
def test_running_sum_with_many_or_few_groups(spark, monkeypatch, most):
    monkeypatch.setattr(RK, "MAX_GROUPS", most)
    rng = np.random.default_rng(5)
    rows = [(None if g == 3 else f"g{g}", float(v), 1) for g in range(6) for v in set(np.round(rng.normal(size=150), 2))]
    df = spark.createDataFrame(rows, "g string, x double, n long")
    got = {(r.g, r.x): (r.cum_n, r.tot_n) for r in RK.running_sum(df, "x", ["n"], by=["g"], buckets=97, with_total=True).collect()}
    for g in {r[0] for r in rows}:
        own = sorted(r[1] for r in rows if r[0] == g)
        assert [got[g, x] for x in own] == [(i + 1, len(own)) for i in range(len(own))]
