"""p-value expressions, test statistics and their invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrix.functions import pvalues as P
from attrix.operators import stats as ST
from attrix.operators import metrics as M


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "expr,expected",
    [
        (lambda: P.chi2_sf(3.841458820694124, 1), 0.05),
        (lambda: P.chi2_sf(11.070497693516351, 5), 0.05),
        (lambda: P.t_two_sided(2.2281388519649385, 10), 0.05),
        (lambda: P.normal_two_sided(1.959963984540054), 0.05),
        (lambda: P.f_sf(4.964602743730711, 1, 10), 0.05),
        (lambda: P.kolmogorov_sf(1.3580986393225505), 0.05),
        (lambda: P.chi2_sf(0.0, 1), 1.0),
    ],
)
def test_tails(spark, expr, expected):
    assert _one(spark, expr()) == pytest.approx(expected, abs=1e-6)


def test_chi2_yates_2x2(spark):
    # table [[10, 20], [30, 40]]: Yates chi2 = 0.4464285714...
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 20), ("b", "x", 30), ("b", "y", 40)], "g string, y string, n long")
    r = ST.chi2_table(cells, [], "g", "y").first()
    assert r.chi2 == pytest.approx(0.44642857142857145)
    assert r.dof == 1 and r.p_value == pytest.approx(0.5040358664525046, abs=1e-9)


def test_chi2_rxc_with_empty_cell(spark):
    # 2x3 with an unobserved cell: it enters with O = 0; no correction at dof 2
    cells = spark.createDataFrame([("a", "x", 5), ("a", "y", 5), ("b", "x", 5), ("b", "z", 5)], "g string, y string, n long")
    r = ST.chi2_table(cells, [], "g", "y").first()
    obs = np.array([[5, 5, 0], [5, 0, 5]], float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert r.chi2 == pytest.approx(((obs - exp) ** 2 / exp).sum())
    assert r.dof == 2 and r.cramers_v == pytest.approx(math.sqrt(r.chi2 / 20))


def test_rank_tests_and_auc_invariant(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=400), 1)  # many ties
    y = (rng.random(400) < 0.3).astype(int)
    df = spark.createDataFrame([(float(a), "Yes" if b else "No") for a, b in zip(x, y)], "x double, Churn string")
    t = ST.rank_tests(df, ["x"], "Churn").first()
    # brute force U with tie-averaged ranks
    order = np.argsort(x, kind="stable")
    ranks = np.empty(400)
    sx = x[order]
    i = 0
    while i < 400:
        j = i
        while j + 1 < 400 and sx[j + 1] == sx[i]:
            j += 1
        ranks[order[i:j + 1]] = (i + j) / 2 + 1
        i = j + 1
    n1 = y.sum()
    u1 = ranks[y == 1].sum() - n1 * (n1 + 1) / 2
    assert t.MannWhitney_U == pytest.approx(u1)
    grid = np.unique(x)
    cdf1 = np.array([(x[y == 1] <= g).mean() for g in grid])
    cdf0 = np.array([(x[y == 0] <= g).mean() for g in grid])
    assert t.KS_Statistic == pytest.approx(np.abs(cdf1 - cdf0).max())
    preds = spark.createDataFrame([("m", int(b), float(a)) for a, b in zip(x, y)], "model string, label int, probability double")
    auc = M.roc_auc(preds).first().roc_auc
    assert auc == pytest.approx(u1 / (n1 * (400 - n1)))


def test_mcnemar_identical_models(spark):
    df = spark.createDataFrame([(1, 1, 1), (0, 1, 1), (1, 0, 0)], "label int, a int, b int")
    r = ST.mcnemar(df, "label", ["a", "b"]).first()
    assert (r.Statistic, r.P_Value, r.Model1_Correct_Only, r.Model2_Correct_Only) == (0.0, 1.0, 0, 0)


def test_mcnemar_counts(spark):
    rows = [(1, 1, 0)] * 15 + [(1, 0, 1)] * 5 + [(0, 0, 0)] * 10
    r = ST.mcnemar(spark.createDataFrame(rows, "label int, a int, b int"), "label", ["a", "b"]).first()
    assert r.Statistic == pytest.approx((abs(15 - 5) - 1) ** 2 / 20)


def test_pooled_t(spark):
    a, b = [1, 0, 1, 1, 0, 1], [0, 0, 1, 0]
    df = spark.createDataFrame([(v, 1) for v in a] + [(v, 0) for v in b], "y int, g int")
    r = ST.two_group_t(df, F.col("y"), F.col("g") == 1, F.col("g") == 0).first()
    n1, n2 = len(a), len(b)
    sp = ((n1 - 1) * np.var(a, ddof=1) + (n2 - 1) * np.var(b, ddof=1)) / (n1 + n2 - 2)
    assert r.t == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(sp * (1 / n1 + 1 / n2)))


def test_anova_matches_formula(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=200)
    y = rng.random(200) < 0.4
    df = spark.createDataFrame([(float(a), "Yes" if b else "No") for a, b in zip(x, y)], "x double, Churn string")
    f = ST.anova_f(df, ["x"], "Churn").first().F_Statistic
    g1, g0 = x[y], x[~y]
    ssb = len(g1) * (g1.mean() - x.mean()) ** 2 + len(g0) * (g0.mean() - x.mean()) ** 2
    ssw = ((g1 - g1.mean()) ** 2).sum() + ((g0 - g0.mean()) ** 2).sum()
    assert f == pytest.approx(ssb / (ssw / 198))
