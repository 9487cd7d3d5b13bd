"""Scalar column expressions. All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: str | Column, to: str = "double") -> Column:
    """Blank-tolerant numeric conversion: ' ', unparsable text and NaN
    become NULL (ANSI ``cast`` would raise, ``try_cast`` does not)."""
    c = col_(c)
    number = F.when(F.trim(c.cast("string")) == "", F.lit(None)).otherwise(c).try_cast(to)
    return F.when(~F.isnan(number.cast("double")), number)


def map_score(c: str | Column, mapping: Mapping[str, int], default: int = K.UNMAPPED_RISK) -> Column:
    """Category -> score lookup with a default for unmapped values (and
    NULL), like ``Series.map(m).fillna(default)``."""
    c = col_(c)
    expr = F.lit(default)
    for key, score in reversed(list(mapping.items())):
        expr = F.when(c == F.lit(key), F.lit(score)).otherwise(expr)
    return expr


def contract_risk_score(c: str | Column = "Contract", mapping: Mapping[str, int] = K.CONTRACT_RISK) -> Column:
    return map_score(c, mapping)


def payment_risk_score(c: str | Column = "PaymentMethod", mapping: Mapping[str, int] = K.PAYMENT_RISK) -> Column:
    return map_score(c, mapping)


def bin_fixed(c: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ... like ``pd.cut``; values
    outside every bin (and NULL) give NULL. Returns the label, or the
    0-based bin index when ``labels`` is None."""
    c = col_(c)
    if labels is not None and len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    expr = F.lit(None)
    for i in reversed(range(len(edges) - 1)):
        out = F.lit(labels[i]) if labels is not None else F.lit(i)
        expr = F.when((c > F.lit(edges[i])) & (c <= F.lit(edges[i + 1])), out).otherwise(expr)
    return expr


def tenure_group(c: str | Column = "tenure", edges=K.TENURE_EDGES, labels=K.TENURE_LABELS) -> Column:
    return bin_fixed(c, edges, labels)


def linspace(lo: float, hi: float, num: int) -> list[float]:
    """Edges as ``numpy.linspace`` computes them (last edge exactly hi)."""
    import numpy as np

    return [float(x) for x in np.linspace(lo, hi, num)]


def count_equal(cols: Sequence[str], value: str = "Yes") -> Column:
    """Number of columns equal to ``value`` (NULL counts as not equal)."""
    return sum((F.coalesce(F.col(c) == F.lit(value), F.lit(False))).cast("int") for c in cols)


def support_services_count(cols: Sequence[str] = K.SUPPORT_SERVICES) -> Column:
    return count_equal(cols, "Yes")


def ratio(num: str | Column, den: str | Column, den_offset: float = 1) -> Column:
    """num / (den + offset); charge_per_month is Total / (tenure + 1)."""
    return col_(num) / (col_(den) + F.lit(den_offset))


def flag_combo_absent(c: str | Column, value: str, flags: Sequence[str], flag_value: str = "Yes") -> Column:
    """1 when ``c == value`` and none of ``flags`` equals ``flag_value``."""
    any_flag = F.lit(False)
    for f in flags:
        any_flag = any_flag | F.coalesce(F.col(f) == F.lit(flag_value), F.lit(False))
    return (F.coalesce(col_(c) == F.lit(value), F.lit(False)) & ~any_flag).cast("int")


def flag_above(flag: str | Column, x: str | Column, threshold: float | None) -> Column:
    """1 when flag == 1 and x > threshold (threshold fitted elsewhere)."""
    if threshold is None:
        return F.lit(0)
    return (F.coalesce((col_(flag) == 1) & (col_(x) > F.lit(threshold)), F.lit(False))).cast("int")


def label_from_rate(rate_pct: str | Column, levels=K.RISK_LEVELS, lowest: str = K.LOWEST_RISK_LEVEL) -> Column:
    r = col_(rate_pct)
    expr = F.lit(lowest)
    for bound, name in reversed(levels):
        expr = F.when(r > F.lit(bound), F.lit(name)).otherwise(expr)
    return expr


def describe_profile(
    contract: str = "Contract",
    payment: str = "PaymentMethod",
    tenure_grp: str = "tenure_group",
    support: str = "support_count",
    internet: str = "InternetService",
    senior: str = "SeniorCitizen",
    no_internet_value: str = "No",
) -> Column:
    """'<contract> + <payment> + <tenure> tenure + <n> support' with
    ' + <internet>' unless it is the no-service value, and ' + Senior'."""
    base = F.concat_ws(
        " + ",
        F.col(contract),
        F.col(payment),
        F.concat(F.col(tenure_grp), F.lit(" tenure")),
        F.concat(F.col(support).cast("int").cast("string"), F.lit(" support")),
    )
    with_net = F.when(
        F.col(internet) != F.lit(no_internet_value), F.concat(base, F.lit(" + "), F.col(internet))
    ).otherwise(base)
    return F.when(F.col(senior) == 1, F.concat(with_net, F.lit(" + Senior"))).otherwise(with_net)


def risk_factors(rules: Sequence[tuple[Column, str]]) -> Column:
    """Array of the texts of the rules that hold, in rule order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(text)) for cond, text in rules]))


def reference_risk_factor_rules(
    contract="Contract", tenure="tenure", support="TechSupport", payment="PaymentMethod",
    monthly_value="Month-to-month", tenure_below=12, no_support_value="No", risky_payment="Electronic check",
) -> list[tuple[Column, str]]:
    t = K.RISK_FACTOR_TEXT
    return [
        (F.col(contract) == F.lit(monthly_value), t[0]),
        (F.col(tenure) < F.lit(tenure_below), t[1]),
        (F.col(support) == F.lit(no_support_value), t[2]),
        (F.col(payment) == F.lit(risky_payment), t[3]),
    ]


def risk_band(prob: str | Column, above: float = K.HIGH_RISK_ABOVE) -> Column:
    return F.when(col_(prob) > F.lit(above), F.lit("High Risk")).otherwise(F.lit("Low Risk"))


def gauge_band(prob: str | Column) -> Column:
    pct = col_(prob) * 100
    expr = F.lit(None).cast("string")
    for lo, hi, name in reversed(K.GAUGE_BANDS):
        upper = (pct <= F.lit(hi)) if hi == 100 else (pct < F.lit(hi))
        expr = F.when((pct >= F.lit(lo)) & upper, F.lit(name)).otherwise(expr)
    return expr


# --- output rounding (the reference's table formatter) -------------------
_RATE_WORDS = ("percentage", "rate", "pct")
_P_WORDS = ("p_value", "pvalue")
_STAT_WORDS = ("chi2", "f_statistic", "cramers", "mutual", "importance_score")


def rounding_rule(name: str) -> str:
    n = name.lower()
    if any(w in n for w in _RATE_WORDS):
        return "2dp"
    if any(w in n for w in _P_WORDS):
        return "p"
    if any(w in n for w in _STAT_WORDS):
        return "2dp"
    return "magnitude"


def round_by_rule(name: str, c: Column | None = None) -> Column:
    """Rate/pct 2 dp; p-values 4 dp, below 0.0001 five significant digits
    (the number that the scientific notation shows); chi2/F/V/MI 2 dp; other
    numbers 2 dp below 1000 in magnitude, else 1 dp."""
    c = F.col(name) if c is None else c
    rule = rounding_rule(name)
    if rule == "2dp":
        return F.round(c, 2)
    if rule == "p":
        return F.when(c < 0.0001, F.format_string("%.4e", c).cast("double")).otherwise(F.round(c, 4))
    return F.when(F.abs(c) < 1000, F.round(c, 2)).otherwise(F.round(c, 1))


def round_table(df, skip: Sequence[str] = ()):
    """Apply ``round_by_rule`` to every floating column of ``df``."""
    from pyspark.sql import types as T

    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip:
            out.append(round_by_rule(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
