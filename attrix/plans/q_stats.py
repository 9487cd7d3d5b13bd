"""Registered queries: statistical tests. Oracle SQL reproduces the
statistics; p-values (no CDFs in SQL) are covered by the unit tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import stats as ST
from ..operators.combine import one_row
from ..operators.rates import is_positive
from ..sources import snapshot as S
from .catalog import query
from .q_eda import eda_frame
from .q_prep import FEATURES_CTE, featured
from .sql_base import with_base

NUMS = S.NUMERIC_COLUMNS
D = "::DOUBLE"
SHORT_CONTRACT = "MACHINERY"  # the snapshot's top-risk segment, in the Month-to-month role


def _chi2_2x2_sql(cond: str, name: str) -> str:
    """2x2 chi2 with Yates of (cond, churn) over the coerced raw table."""
    return f"""
t AS (SELECT CAST(({cond}) AS VARCHAR) AS g, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0),
cells AS (SELECT g, y, count(*) AS n FROM t GROUP BY g, y),
grid AS (SELECT g, y, coalesce(n, 0) AS n FROM (SELECT DISTINCT g FROM cells) CROSS JOIN (SELECT DISTINCT y FROM cells)
         LEFT JOIN cells USING (g, y)),
m AS (SELECT *, sum(n) OVER (PARTITION BY g) AS r, sum(n) OVER (PARTITION BY y) AS c, sum(n) OVER () AS tot,
             (SELECT (count(DISTINCT g) - 1) * (count(DISTINCT y) - 1) FROM cells) AS dof FROM grid),
stat AS (SELECT sum(power(greatest(abs(n - r * c * 1.0{D} / tot) - CASE WHEN dof = 1 THEN 0.5 ELSE 0 END, 0), 2)
                    / (r * c * 1.0{D} / tot)) AS chi2 FROM m)"""


@query(
    "h1_chi2",
    with_base(
        f"""SELECT round(avg(CASE WHEN Contract = '{SHORT_CONTRACT}' THEN y END) * 100, 4) AS Group_A_Rate,
  round(avg(CASE WHEN Contract != '{SHORT_CONTRACT}' THEN y END) * 100, 4) AS Group_B_Rate,
  round((SELECT chi2 FROM stat), 4) AS Chi2_Statistic
FROM (SELECT *, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0)""",
        _chi2_2x2_sql(f"Contract = '{SHORT_CONTRACT}'", "h1"),
    ),
)
def q_h1(spark, sf):
    """H1: 2x2 chi2 (Yates) of the top-risk contract against churn, with both group rates."""
    df = eda_frame(spark, sf)
    y = is_positive("Churn")
    c_in = F.col("Contract") == SHORT_CONTRACT
    chi = ST.chi2_table(ST.two_by_two(df, y, c_in), [], "g", "y").select(F.round("chi2", 4).alias("Chi2_Statistic"))
    rates = df.agg(
        F.round(F.avg(F.when(c_in, y)) * 100, 4).alias("Group_A_Rate"),
        F.round(F.avg(F.when(~c_in, y)) * 100, 4).alias("Group_B_Rate"),
    )
    return one_row(rates, chi)


@query(
    "h4_chi2",
    with_base(
        f"""SELECT round(avg(CASE WHEN TechSupport = 'No' THEN y END) * 100, 4) AS Group_A_Rate,
  round(avg(CASE WHEN TechSupport = 'Yes' THEN y END) * 100, 4) AS Group_B_Rate,
  round((SELECT chi2 FROM stat), 4) AS Chi2_Statistic
FROM (SELECT *, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0)""",
        _chi2_2x2_sql("TechSupport IN ('Yes')", "h4"),
    ),
)
def q_h4(spark, sf):
    """H4: 2x2 chi2 (Yates) of tech support against churn, with both group rates."""
    df = eda_frame(spark, sf)
    y = is_positive("Churn")
    s_in = F.col("TechSupport").isin("Yes")
    chi = ST.chi2_table(ST.two_by_two(df, y, s_in), [], "g", "y").select(F.round("chi2", 4).alias("Chi2_Statistic"))
    rates = df.agg(
        F.round(F.avg(F.when(F.col("TechSupport") == "No", y)) * 100, 4).alias("Group_A_Rate"),
        F.round(F.avg(F.when(s_in, y)) * 100, 4).alias("Group_B_Rate"),
    )
    return one_row(rates, chi)


def _t_sql(col: str, high_first: bool) -> str:
    a, b = (">", "<=") if high_first else ("<=", ">")
    return f"""
SELECT n1, n2, round(m1 * 100, 4) AS Group_A_Rate, round(m2 * 100, 4) AS Group_B_Rate,
  round((m1 - m2) / sqrt((((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) * (1.0 / n1 + 1.0 / n2)), 4) AS T_Statistic,
  n1 + n2 - 2 AS dof
FROM (
  SELECT count(*) FILTER (WHERE {col} {a} med) AS n1, avg(y) FILTER (WHERE {col} {a} med) AS m1, var_samp(y) FILTER (WHERE {col} {a} med) AS v1,
         count(*) FILTER (WHERE {col} {b} med) AS n2, avg(y) FILTER (WHERE {col} {b} med) AS m2, var_samp(y) FILTER (WHERE {col} {b} med) AS v2
  FROM (SELECT *, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0),
       (SELECT quantile_cont({col}, 0.5) AS med FROM clean0))"""


def _t_query(spark, sf, col, high_first):
    from ..operators.ranking import scalar_quantiles

    df = eda_frame(spark, sf)
    (med,) = scalar_quantiles(df, col, [0.5])
    hi, lo = F.col(col) > F.lit(med), F.col(col) <= F.lit(med)
    a_in, b_in = (hi, lo) if high_first else (lo, hi)
    t = ST.two_group_t(df, is_positive("Churn"), a_in, b_in)
    return t.select(
        "n1", "n2", F.round(F.col("m1") * 100, 4).alias("Group_A_Rate"), F.round(F.col("m2") * 100, 4).alias("Group_B_Rate"),
        F.round("t", 4).alias("T_Statistic"), "dof",
    )


@query("h2_ttest", with_base(_t_sql("MonthlyCharges", True)))
def q_h2(spark, sf):
    """H2: pooled t of churn between high (> median) and low monthly charges."""
    return _t_query(spark, sf, "MonthlyCharges", True)


@query("h3_ttest", with_base(_t_sql("tenure", False)))
def q_h3(spark, sf):
    """H3: pooled t of churn between low (<= median) and high tenure."""
    return _t_query(spark, sf, "tenure", False)


def _hypotheses_sql() -> str:
    """Unrounded statistics of the four tests; tails by Simpson's rule."""
    rows = "(SELECT *, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0)"

    def chi2(name, test, rate_a, rate_b, cond):
        head = f"SELECT '{name}' AS h, 'chi2' AS t, avg(CASE WHEN {rate_a} THEN y END) AS ra, avg(CASE WHEN {rate_b} THEN y END) AS rb, (SELECT chi2 FROM stat) AS s, 0 AS dof FROM {rows}"
        return with_base(head, _chi2_2x2_sql(cond, test))

    def t(name, col, high_first):
        a, b = (">", "<=") if high_first else ("<=", ">")
        facts = ", ".join(f"{f}(y) FILTER (WHERE {col} {side} med) AS {n}{i}" for i, side in ((1, a), (2, b)) for f, n in (("count", "n"), ("avg", "m"), ("var_samp", "v")))
        return with_base(f"""SELECT '{name}', 't', m1, m2, (m1 - m2) / sqrt((((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) * (1.0 / n1 + 1.0 / n2)), n1 + n2 - 2
FROM (SELECT {facts} FROM {rows}, (SELECT quantile_cont({col}, 0.5) AS med FROM clean0))""")

    parts = [chi2(f"H1: {SHORT_CONTRACT} contracts → Higher churn", "h1", f"Contract = '{SHORT_CONTRACT}'", f"Contract != '{SHORT_CONTRACT}'", f"Contract = '{SHORT_CONTRACT}'"),
             t("H2: High MonthlyCharges → Higher churn", "MonthlyCharges", True), t("H3: Low tenure → Higher churn", "tenure", False),
             chi2("H4: Missing support services → Higher churn", "h4", "TechSupport = 'No'", "TechSupport = 'Yes'", "TechSupport IN ('Yes')")]
    tests = " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    steps = 4000
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    x = f"(z * i / {steps}.0{D})"
    density = f"CASE WHEN t = 'chi2' THEN exp(-{x} * {x} / 2) / sqrt(2 * pi()) ELSE exp(lgamma((dof + 1) / 2.0{D}) - lgamma(dof / 2.0{D})) / sqrt(dof * pi()) * power(1 + {x} * {x} / dof, -(dof + 1) / 2.0{D}) END"
    return f"""WITH tests AS ({tests}),
tails AS (SELECT h, any_value(t) AS t, any_value(ra) * 100 AS ra, any_value(rb) * 100 AS rb, any_value(s) AS s,
            1 - 2 * any_value(z) / {steps} / 3 * sum({weight} * ({density})) AS p
          FROM (SELECT *, CASE WHEN t = 'chi2' THEN sqrt(s) ELSE abs(s) END AS z FROM tests), generate_series(0, {steps}) g(i) GROUP BY h)
SELECT h AS Hypothesis, t AS Test, round(ra, 4) AS Group_A_Rate, round(rb, 4) AS Group_B_Rate, round(ra - rb, 4) AS Difference, round(s, 4) AS Statistic,
  round(p, 6) AS P_Value, CASE WHEN p < 0.05 AND ra > rb THEN 'Supported' ELSE 'Not Supported' END AS Result FROM tails"""


@query("hypotheses", _hypotheses_sql())
def q_hypotheses(spark, sf):
    """H1-H4 with group rates, statistics, p-values and verdicts."""
    out = ST.hypotheses(eda_frame(spark, sf), "Churn", short_contract=SHORT_CONTRACT, support_no=("No",))
    rounded = [F.round(c, 4).alias(c) for c in ("Group_A_Rate", "Group_B_Rate", "Difference", "Statistic")]
    return out.select("Hypothesis", "Test", *rounded, F.round("P_Value", 6).alias("P_Value"), "Result")


@query(
    "chi2_rxc",
    with_base(
        f"""
SELECT round(sum(power(abs(n - r * c * 1.0{D} / tot), 2) / (r * c * 1.0{D} / tot)), 4) AS chi2,
  CAST(any_value(dof) AS BIGINT) AS dof, any_value(tot) AS n_total
FROM (SELECT *, sum(n) OVER (PARTITION BY a) AS r, sum(n) OVER (PARTITION BY b) AS c, sum(n) OVER () AS tot,
             (SELECT (count(DISTINCT Contract) - 1) * (count(DISTINCT PaymentMethod) - 1) FROM clean0) AS dof
      FROM (SELECT a, b, coalesce(n, 0) AS n FROM (SELECT DISTINCT Contract AS a FROM clean0)
            CROSS JOIN (SELECT DISTINCT PaymentMethod AS b FROM clean0)
            LEFT JOIN (SELECT Contract AS a, PaymentMethod AS b, count(*) AS n FROM clean0 GROUP BY ALL) USING (a, b)))"""
    ),
)
def q_chi2_rxc(spark, sf):
    """Contract x PaymentMethod independence (r x c, no correction at dof>1)."""
    df = eda_frame(spark, sf)
    cells = df.groupBy(F.col("Contract").alias("a"), F.col("PaymentMethod").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return ST.chi2_table(cells, [], "a", "b").select(F.round("chi2", 4).alias("chi2"), "dof", "n_total")


def _assoc_sql(cols) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS Feature, CAST({c} AS VARCHAR) AS cat, Churn AS y, count(*) AS n FROM clean0 GROUP BY ALL" for c in cols
    )
    return f"""
cells AS ({cells}),
grid AS (SELECT Feature, cat, y, coalesce(n, 0) AS n FROM
   (SELECT DISTINCT Feature, cat FROM cells) JOIN (SELECT DISTINCT Feature, y FROM cells) USING (Feature)
   LEFT JOIN cells USING (Feature, cat, y)),
m AS (SELECT *, sum(n) OVER (PARTITION BY Feature, cat) AS r, sum(n) OVER (PARTITION BY Feature, y) AS c,
             sum(n) OVER (PARTITION BY Feature) AS tot FROM grid),
dims AS (SELECT Feature, count(DISTINCT cat) AS nr, count(DISTINCT y) AS nc FROM cells GROUP BY Feature),
assoc AS (
  SELECT Feature, sum(power(greatest(abs(n - r * c * 1.0{D} / tot) - CASE WHEN (nr - 1) * (nc - 1) = 1 THEN 0.5 ELSE 0 END, 0), 2)
           / (r * c * 1.0{D} / tot)) AS chi2, any_value((nr - 1) * (nc - 1)) AS dof, any_value(tot) AS tot,
         any_value(least(nr, nc)) AS k
  FROM m JOIN dims USING (Feature) GROUP BY Feature)"""


CAT_TEXT = ["Region", "Contract", "PaymentMethod", "InternetService", *K.SUPPORT_SERVICES]


@query(
    "cramers_v",
    with_base(
        "SELECT Feature, round(chi2, 4) AS Chi2_Statistic, CAST(dof AS BIGINT) AS dof, "
        "round(sqrt(chi2 / (tot * (k - 1))), 4) AS Cramers_V FROM assoc",
        _assoc_sql(CAT_TEXT),
    ),
)
def q_cramers_v(spark, sf):
    """chi2, dof and Cramer's V of each text column against the label."""
    a = ST.label_association(eda_frame(spark, sf), "Churn", CAT_TEXT)
    return a.select("Feature", F.round("chi2", 4).alias("Chi2_Statistic"), "dof", F.round("cramers_v", 4).alias("Cramers_V"))


def _rank_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS Feature, CAST({c} AS DOUBLE) AS x, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0" for c in NUMS
    )
    return f"""
vc AS (SELECT Feature, x, sum(y) AS c1, sum(1 - y) AS c0, count(*) AS cnt FROM ({long}) WHERE x IS NOT NULL GROUP BY Feature, x),
cum AS (SELECT *, sum(c1) OVER w AS cum1, sum(c0) OVER w AS cum0, sum(cnt) OVER w AS cumn,
               sum(c1) OVER (PARTITION BY Feature) AS n1, sum(c0) OVER (PARTITION BY Feature) AS n0
        FROM vc WINDOW w AS (PARTITION BY Feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rk AS (SELECT Feature, any_value(n1) AS n1, any_value(n0) AS n0,
              max(abs(cum1 * 1.0{D} / n1 - cum0 * 1.0{D} / n0)) AS ks,
              sum(c1 * (cumn - (cnt - 1) / 2.0{D})) AS r1,
              sum(power(cnt{D}, 3) - cnt) AS ties
       FROM cum GROUP BY Feature)"""


@query("ks_2samp", with_base("SELECT Feature, round(ks, 6) AS KS_Statistic FROM rk", _rank_sql()))
def q_ks(spark, sf):
    """Two-sample KS statistic of each numeric column between the labels."""
    t = ST.rank_tests(eda_frame(spark, sf), NUMS, "Churn")
    return t.select("Feature", F.round("KS_Statistic", 6).alias("KS_Statistic"))


@query(
    "mannwhitney",
    with_base(
        f"""SELECT Feature, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0, round(r1 - n1 * (n1 + 1) / 2.0{D}, 4) AS MannWhitney_U,
  round((abs(r1 - n1 * (n1 + 1) / 2.0{D} - n1 * n0 / 2.0{D}) - 0.5)
        / sqrt(n1 * n0 / 12.0{D} * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1)))), 4) AS z
FROM rk""",
        _rank_sql(),
    ),
)
def q_mannwhitney(spark, sf):
    """Mann-Whitney U of the positive group and its tie-corrected z per numeric column."""
    df = eda_frame(spark, sf)
    vc = ST.label_value_counts(df, NUMS, "Churn")
    t = ST.rank_tests(df, NUMS, "Churn")
    # z re-derived from the same aggregates for the oracle comparison
    ties = vc.groupBy("Feature").agg(F.sum((F.col("c1") + F.col("c0")).cast("double") ** 3 - (F.col("c1") + F.col("c0"))).alias("ties"))
    n = F.col("n1") + F.col("n0")
    z = (F.abs(F.col("MannWhitney_U") - F.col("n1") * F.col("n0") / 2.0) - 0.5) / F.sqrt(
        F.col("n1") * F.col("n0") / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1)))
    )
    return t.join(ties, "Feature").select(
        "Feature", "n1", "n0", F.round("MannWhitney_U", 4).alias("MannWhitney_U"), F.round(z, 4).alias("z")
    )


@query(
    "dist_by_label",
    with_base(
        """SELECT Feature,
  round(avg(x) FILTER (WHERE Churn = 'Yes'), 4) AS Churn_Mean, round(avg(x) FILTER (WHERE Churn = 'No'), 4) AS No_Churn_Mean,
  round(quantile_cont(x, 0.5) FILTER (WHERE Churn = 'Yes'), 4) AS Churn_Median,
  round(quantile_cont(x, 0.25) FILTER (WHERE Churn = 'Yes'), 4) AS Churn_Q1,
  round(quantile_cont(x, 0.75) FILTER (WHERE Churn = 'Yes'), 4) AS Churn_Q3,
  round(quantile_cont(x, 0.5) FILTER (WHERE Churn = 'No'), 4) AS No_Churn_Median,
  round(quantile_cont(x, 0.25) FILTER (WHERE Churn = 'No'), 4) AS No_Churn_Q1,
  round(quantile_cont(x, 0.75) FILTER (WHERE Churn = 'No'), 4) AS No_Churn_Q3,
  round(any_value(ks), 6) AS KS_Statistic, round(any_value(r1 - n1 * (n1 + 1) / 2.0::DOUBLE), 4) AS MannWhitney_U
FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS Feature, CAST({c} AS DOUBLE) AS x, Churn FROM clean0" for c in NUMS) + """)
JOIN rk USING (Feature) GROUP BY Feature""",
        _rank_sql(),
    ),
)
def q_dist_by_label(spark, sf):
    """Means, quartiles, KS and Mann-Whitney U of each numeric column by label."""
    out = ST.dist_by_label(eda_frame(spark, sf), NUMS, "Churn", with_p=False)
    return out.select(
        "Feature",
        *[F.round(c, 4).alias(c) for c in ["Churn_Mean", "No_Churn_Mean", "Churn_Median", "Churn_Q1", "Churn_Q3",
                                           "No_Churn_Median", "No_Churn_Q1", "No_Churn_Q3"]],
        F.round("KS_Statistic", 6).alias("KS_Statistic"), F.round("MannWhitney_U", 4).alias("MannWhitney_U"),
    )


def _anova_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS Feature, coalesce(CAST({c} AS DOUBLE), 0.0) AS x, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0"
        for c in NUMS
    )
    return f"""
g AS (SELECT Feature, y, count(*) AS n, sum(x) AS s, sum(x * x) AS ss FROM ({long}) GROUP BY Feature, y),
tot AS (SELECT Feature, sum(n) AS n_all, sum(s) AS s_all, sum(ss) AS ss_all, sum(s * s / n) AS b, count(*) AS k FROM g GROUP BY Feature)"""


@query(
    "anova_f",
    with_base(
        "SELECT Feature, round(((b - s_all * s_all / n_all) / (k - 1)) / ((ss_all - b) / (n_all - k)), 4) AS F_Statistic FROM tot",
        _anova_sql(),
    ),
)
def q_anova(spark, sf):
    """ANOVA F of each numeric column across the two label classes (NULL -> 0)."""
    return ST.anova_f(eda_frame(spark, sf), NUMS, "Churn").select("Feature", F.round("F_Statistic", 4).alias("F_Statistic"))


def _mi_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS Feature, CAST(customerID AS VARCHAR) AS id, coalesce(CAST({c} AS DOUBLE), 0.0) AS x, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0"
        for c in NUMS
    )
    return f"""
lx AS ({long}),
sc AS (SELECT Feature, CASE WHEN s > 0 THEN power(2.0{D}, floor(log2(s * {ST.NOISE!r}))) ELSE power(2.0{D}, -34) END AS amp
       FROM (SELECT Feature, greatest(stddev_pop(x), avg(abs(x))) AS s FROM lx GROUP BY Feature)),
px AS (SELECT Feature, y, x + amp * (CAST(('0x' || md5(Feature || ':' || id)[1:8]) AS BIGINT) / 4294967296.0{D}) AS x FROM lx JOIN sc USING (Feature)),
rx AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY Feature, y) AS n_y,
         list_filter([{", ".join(f"{{'d': x - lag(x, {j}) OVER w, 'at': lag(x, {j}) OVER w, 'side': -1}}" for j in range(1, ST.K_NEAREST + 1))},
                      {", ".join(f"{{'d': lead(x, {j}) OVER w - x, 'at': lead(x, {j}) OVER w, 'side': 1}}" for j in range(1, ST.K_NEAREST + 1))}], lambda z: z.d IS NOT NULL) AS near
       FROM px WINDOW w AS (PARTITION BY Feature, y ORDER BY x)),
kx AS (SELECT *, least({ST.K_NEAREST}, n_y - 1) AS k, list_sort(near)[least({ST.K_NEAREST}, n_y - 1)] AS kth FROM rx WHERE n_y > 1),
mx AS (SELECT a.Feature, a.y, a.r, any_value(a.k) AS k, any_value(a.n_y) AS n_y, count(*) AS m FROM kx a JOIN kx b ON a.Feature = b.Feature
         AND (CASE WHEN a.kth.d = 0 THEN b.x = a.x
              ELSE b.x > CASE WHEN a.kth.side < 0 THEN a.kth.at ELSE a.x - a.kth.d END AND b.x < CASE WHEN a.kth.side > 0 THEN a.kth.at ELSE a.x + a.kth.d END END)
       GROUP BY a.Feature, a.y, a.r),
psi AS (SELECT m, sum(CASE WHEN m = 1 THEN -0.57721566490153286{D} ELSE 1.0{D} / (m - 1) END) OVER (ORDER BY m) AS v
        FROM generate_series(1, (SELECT 2 + count(*) FROM kx)) g(m)),
mi AS (SELECT Feature, greatest(any_value(pn.v) + avg(pk.v - py.v - pm.v), 0.0) AS Mutual_Information
       FROM (SELECT *, count(*) OVER (PARTITION BY Feature) AS n FROM mx) q JOIN psi pk ON pk.m = k JOIN psi py ON py.m = n_y JOIN psi pm ON pm.m = q.m
         JOIN psi pn ON pn.m = n GROUP BY Feature)"""


@query("mutual_info", with_base("SELECT Feature, round(Mutual_Information, 6) AS Mutual_Information FROM mi", _mi_sql()))
def q_mutual_info(spark, sf):
    """Mutual information (nats) of each numeric column with the label, by
    the distances to the third nearest rows of the same class."""
    m = ST.mutual_info(eda_frame(spark, sf), NUMS, "Churn", key="customerID")
    return m.select("Feature", F.round("Mutual_Information", 6).alias("Mutual_Information"))


@query(
    "importance_rank",
    with_base(
        """SELECT CAST(row_number() OVER (ORDER BY score DESC, Feature) AS INTEGER) AS Rank, Feature, Type, round(score, 6) AS Importance_Score
FROM (SELECT Feature, 'Numerical' AS Type, Mutual_Information AS score FROM mi
      UNION ALL SELECT Feature, 'Categorical', sqrt(chi2 / (tot * (k - 1))) FROM assoc)""",
        _mi_sql() + "," + _assoc_sql(CAT_TEXT),
    ),
)
def q_importance_rank(spark, sf):
    """One ranking: MI for numerics, Cramer's V for text columns."""
    r = ST.importance_rank(eda_frame(spark, sf), NUMS, "Churn", key="customerID")
    return r.select("Rank", "Feature", "Type", F.round("Importance_Score", 6).alias("Importance_Score"))


# --- formula "models": fixed rules, so model-comparison operators can be
# checked exactly before any fitted model exists ------------------------------
FORMULA_PRED_SQL = f"""
preds AS (SELECT customerID, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label,
  CASE WHEN (contract_risk_score + payment_risk_score + (4 - support_services_count) + SeniorCitizen) / 11.0{D} > 0.5 THEN 1 ELSE 0 END AS pred_rule,
  CASE WHEN contract_risk_score = 3 THEN 1 ELSE 0 END AS pred_contract,
  CASE WHEN support_services_count < 2 THEN 1 ELSE 0 END AS pred_support FROM feat)"""
FORMULA_MODELS = ["pred_rule", "pred_contract", "pred_support"]


def formula_predictions(spark, sf):
    from .q_prep import rule_score

    df = featured(spark, sf)
    return df.select(
        "customerID",
        is_positive("Churn").alias("label"),
        (rule_score(df) > 0.5).cast("int").alias("pred_rule"),
        (F.col("contract_risk_score") == 3).cast("int").alias("pred_contract"),
        (F.col("support_services_count") < 2).cast("int").alias("pred_support"),
    )


def _mcnemar_sql() -> str:
    parts = []
    for i, a in enumerate(FORMULA_MODELS):
        for b in FORMULA_MODELS[i + 1:]:
            parts.append(
                f"""SELECT '{a}' AS Model_1, '{b}' AS Model_2, count(*) FILTER (WHERE {a} = label AND {b} != label) AS b,
  count(*) FILTER (WHERE {a} != label AND {b} = label) AS c FROM preds"""
            )
    return " UNION ALL ".join(parts)


@query(
    "mcnemar",
    with_base(
        f"""SELECT Model_1, Model_2, 'McNemar' AS Test_Type,
  round(CASE WHEN b + c > 0 THEN power(abs(b - c) - 1, 2) * 1.0{D} / (b + c) ELSE 0.0 END, 6) AS Statistic,
  b AS Model1_Correct_Only, c AS Model2_Correct_Only FROM ({_mcnemar_sql()})""",
        FEATURES_CTE + "," + FORMULA_PRED_SQL,
    ),
)
def q_mcnemar(spark, sf):
    """Pairwise McNemar statistics of the formula models' predictions."""
    m = ST.mcnemar(formula_predictions(spark, sf), "label", FORMULA_MODELS)
    return m.select("Model_1", "Model_2", "Test_Type", F.round("Statistic", 6).alias("Statistic"), "Model1_Correct_Only", "Model2_Correct_Only")


def fold_f1(preds, models, folds: int = K.CV_FOLDS):
    """F1 of each model on each of ``folds`` seeded hash folds."""
    from ..operators.split import seeded_hash

    fold = F.pmod(seeded_hash("customerID"), F.lit(folds)).alias("fold")
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("pred")) for m in models])
    long = preds.select(fold, "label", F.inline(arr))
    g = long.groupBy("model", "fold").agg(
        F.count_if((F.col("pred") == 1) & (F.col("label") == 1)).alias("tp"),
        F.count_if((F.col("pred") == 1) & (F.col("label") == 0)).alias("fp"),
        F.count_if((F.col("pred") == 0) & (F.col("label") == 1)).alias("fn"),
    )
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0,
                2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(F.lit(0.0))
    return g.select("model", "fold", f1.alias("f1"))


def _paired_sql() -> str:
    from ..operators.split import seeded_hash_sql

    arms = " UNION ALL ".join(f"SELECT '{m}' AS model, {seeded_hash_sql('customerID')} % 5 AS fold, label, {m} AS pred FROM preds" for m in FORMULA_MODELS)
    pairs = []
    for i, a in enumerate(FORMULA_MODELS):
        for b in FORMULA_MODELS[i + 1:]:
            pairs.append(
                f"SELECT '{a}' AS Model_1, '{b}' AS Model_2, x.fold, x.f1 - y.f1 AS d FROM ff x JOIN ff y ON x.fold = y.fold "
                f"WHERE x.model = '{a}' AND y.model = '{b}'"
            )
    return f"""
arms AS ({arms}),
fc AS (SELECT model, fold, count(*) FILTER (WHERE pred = 1 AND label = 1) AS tp, count(*) FILTER (WHERE pred = 1 AND label = 0) AS fp,
              count(*) FILTER (WHERE pred = 0 AND label = 1) AS fn FROM arms GROUP BY model, fold),
ff AS (SELECT model, fold, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0{D} * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM fc),
dd AS ({' UNION ALL '.join(pairs)})"""


@query(
    "paired_t",
    with_base(
        """SELECT Model_1, Model_2, 'Paired_t' AS Test_Type, round(avg(d), 6) AS Mean_Difference,
  round(avg(d) / (stddev_samp(d) / sqrt(count(d))), 4) AS Statistic, count(d) - 1 AS dof FROM dd GROUP BY Model_1, Model_2""",
        FEATURES_CTE + "," + FORMULA_PRED_SQL + "," + _paired_sql(),
    ),
)
def q_paired_t(spark, sf):
    """Paired t on 5 seeded-fold F1 scores (the reference only stubs it)."""
    scores = fold_f1(formula_predictions(spark, sf), FORMULA_MODELS)
    t = ST.paired_t(scores, "model", "fold", "f1", FORMULA_MODELS)
    return t.select("Model_1", "Model_2", "Test_Type", F.round("Mean_Difference", 6).alias("Mean_Difference"),
                    F.round("Statistic", 4).alias("Statistic"), "dof")
