"""Distribution tails as Spark SQL expressions.

Spark SQL has no CDFs, but the special functions of commons-math3 (shipped
with every Spark distribution) are static methods, so ``reflect`` calls
them on the executors, inside the query: no Python worker, no driver step.
They run on the few rows that hold test statistics, never on raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_GAMMA = "org.apache.commons.math3.special.Gamma"
_BETA = "org.apache.commons.math3.special.Beta"
_ERF = "org.apache.commons.math3.special.Erf"


def _d(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("double")


def _call(cls: str, method: str, *args) -> Column:
    return F.reflect(F.lit(cls), F.lit(method), *[_d(a) for a in args]).cast("double")


def digamma(x) -> Column:
    """The logarithmic derivative of the gamma function."""
    return _call(_GAMMA, "digamma", F.col(x) if isinstance(x, str) else x)


def chi2_sf(stat, dof) -> Column:
    """P(X > stat) for X ~ chi2(dof) = Q(dof/2, stat/2)."""
    s, k = _d(stat), _d(dof)
    return F.when(s.isNull() | k.isNull() | (k <= 0), F.lit(None).cast("double")).when(
        s <= 0, F.lit(1.0)
    ).otherwise(_call(_GAMMA, "regularizedGammaQ", k / 2, s / 2))


def t_two_sided(t, dof) -> Column:
    """2 P(T > |t|) for T ~ t(dof) = I_{dof/(dof+t^2)}(dof/2, 1/2)."""
    tt, k = _d(t), _d(dof)
    x = k / (k + tt * tt)
    return F.when(tt.isNull() | k.isNull() | (k <= 0) | F.isnan(tt), F.lit(None).cast("double")).otherwise(
        _call(_BETA, "regularizedBeta", x, k / 2, F.lit(0.5))
    )


def f_sf(f, dof1, dof2) -> Column:
    """P(X > f) for X ~ F(dof1, dof2) = I_{d2/(d2+d1 f)}(d2/2, d1/2)."""
    ff, a, b = _d(f), _d(dof1), _d(dof2)
    x = b / (b + a * ff)
    return F.when(ff.isNull() | F.isnan(ff) | (a <= 0) | (b <= 0), F.lit(None).cast("double")).when(
        ff <= 0, F.lit(1.0)
    ).otherwise(_call(_BETA, "regularizedBeta", x, b / 2, a / 2))


def normal_two_sided(z) -> Column:
    """2 P(Z > |z|) = erfc(|z| / sqrt 2)."""
    zz = _d(z)
    return F.when(zz.isNull() | F.isnan(zz), F.lit(None).cast("double")).otherwise(
        _call(_ERF, "erfc", F.abs(zz) / F.lit(2.0 ** 0.5))
    )


def kolmogorov_sf(x, terms: int = 100) -> Column:
    """Limiting Kolmogorov tail 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 x^2),
    as a higher-order SQL expression (asymptotic two-sample KS p-value at
    x = D sqrt(n1 n2 / (n1 + n2))). Below x = 0.2 the tail is 1 to 12 places,
    where the alternating series would need ever more terms."""
    xx = _d(x)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * xx * xx),
    )
    return F.when(xx.isNull(), F.lit(None).cast("double")).when(xx < 0.2, F.lit(1.0)).otherwise(
        F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    )
