"""Exact p-values against enumeration, big-integer counts and the SQL path."""

import itertools
import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from attrix.functions import exact as X
from attrix.operators import stats as ST


def ks_all(n1, n0):
    """D of every way to order the two samples."""
    out = []
    for ones in itertools.combinations(range(n1 + n0), n1):
        i = j = 0
        d, own = Fraction(0), set(ones)
        for k in range(n1 + n0):
            i, j = (i + 1, j) if k in own else (i, j + 1)
            d = max(d, abs(Fraction(i, n1) - Fraction(j, n0)))
        out.append(d)
    return out


@pytest.mark.parametrize("n1,n0", [(3, 4), (5, 5), (6, 4), (1, 7), (7, 6)])
def test_ks_equals_enumeration(n1, n0):
    every = ks_all(n1, n0)
    for num in range(math.lcm(n1, n0) + 1):
        d = Fraction(num, math.lcm(n1, n0))
        assert X.ks_two_sided(n1, n0, float(d)) == pytest.approx(sum(x >= d for x in every) / len(every), abs=1e-12)


def ks_paths(n1, n0, d):
    """The same with whole numbers."""
    h, a, b = d * math.lcm(n1, n0), n0 // math.gcd(n1, n0), n1 // math.gcd(n1, n0)
    row = []
    for i in range(n1 + 1):
        new = []
        for j in range(n0 + 1):
            ways = 1 if i == j == 0 else (row[j] if i else 0) + (new[j - 1] if j else 0)
            new.append(ways if abs(i * a - j * b) < h else 0)
        row = new
    return float(1 - Fraction(row[-1], math.comb(n1 + n0, n1)))


@pytest.mark.parametrize("n1,n0,num", [(40, 60, 13), (120, 120, 17), (90, 37, 700), (200, 150, 40)])
def test_ks_equals_big_integers(n1, n0, num):
    d = Fraction(num, math.lcm(n1, n0))
    assert X.ks_two_sided(n1, n0, float(d)) == pytest.approx(ks_paths(n1, n0, d), rel=1e-9, abs=1e-13)


def test_ks_of_large_samples_nears_the_limit(spark):
    from attrix.functions.pvalues import kolmogorov_sf

    d, n1, n0 = 0.035, 5000, 8000
    limit = spark.range(1).select(kolmogorov_sf(F.lit(d * math.sqrt(n1 * n0 / (n1 + n0))))).first()[0]
    assert X.ks_two_sided(n1, n0, d) == pytest.approx(limit, rel=0.03)


@pytest.mark.parametrize("n1,n0", [(3, 4), (5, 5), (2, 9), (8, 4), (1, 6), (1, 1)])
def test_u_equals_enumeration(n1, n0):
    every = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(range(1, n1 + n0 + 1), n1)]
    for u in range(n1 * n0 + 1):
        k = max(u, n1 * n0 - u)
        assert X.u_two_sided(n1, n0, u) == pytest.approx(min(1, 2 * sum(v >= k for v in every) / len(every)), abs=1e-12)


def test_rank_tests_choose_the_exact_values(spark):
    rows = [(float(i), float(i % 3), "Yes" if i in (2, 3, 11, 14, 15) else "No") for i in range(20)]
    got = {r.Feature: r for r in ST.rank_tests(spark.createDataFrame(rows, "a double, b double, y string"), ["a", "b"], "y").collect()}
    a = got["a"]
    assert a.KS_PValue == pytest.approx(X.ks_two_sided(5, 15, a.KS_Statistic)) and a.MannWhitney_PValue == pytest.approx(X.u_two_sided(5, 15, a.MannWhitney_U))
    b = got["b"]  # ties: the normal value stays for U
    assert b.KS_PValue == pytest.approx(X.ks_two_sided(5, 15, b.KS_Statistic)) and b.MannWhitney_PValue != pytest.approx(X.u_two_sided(5, 15, b.MannWhitney_U), abs=1e-6)
