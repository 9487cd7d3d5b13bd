"""Registered queries: profiling, grouped rates, interactions, profiles,
bivariate tables, binning -- the exploratory analysis family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..operators import profile as PR
from ..operators import rates as R
from ..sources import snapshot as S
from .catalog import query
from .q_prep import clean, raw
from .sql_base import unpivot_sql, with_base

CATS = S.CATEGORICAL_COLUMNS
NUMS = S.NUMERIC_COLUMNS
D = "::DOUBLE"


def eda_frame(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table with totals coerced to numbers (blanks -> NULL), as
    every exploratory function of the reference prepares it."""
    return raw(spark, sf).withColumn("TotalCharges", C.to_number("TotalCharges"))




def rates_sql(cols=CATS) -> str:
    cells = unpivot_sql("clean", cols, keep="CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y")
    return f"""rates AS (
  SELECT Feature, Category, count(*) AS Total_Count, CAST(sum(y) AS BIGINT) AS Churn_Count,
         round(sum(y) * 100.0{D} / count(*), 2) AS Churn_Rate_Percentage
  FROM ({cells}) WHERE Category IS NOT NULL GROUP BY Feature, Category)"""


RATES_CTE = rates_sql()


@query("rate_by_category", with_base("SELECT * FROM rates", RATES_CTE))
def q_rate_by_category(spark, sf):
    """Total, churners and churn rate of every category of every categorical column."""
    return R.rate_by_category(clean(spark, sf), "Churn", CATS)


@query(
    "cat_dist",
    with_base(
        f"""SELECT Feature, Category, count(*) AS Count,
  round(count(*) * 100.0{D} / (SELECT count(*) FROM clean), 2) AS Percentage
FROM ({unpivot_sql('clean', CATS)}) WHERE Category IS NOT NULL GROUP BY Feature, Category"""
    ),
)
def q_cat_dist(spark, sf):
    """Count and share of all rows per categorical column and category."""
    return R.cat_dist(clean(spark, sf), CATS)


@query(
    "rate_pivot",
    with_base(
        """SELECT Feature, Category, Churn_Rate_Percentage AS "Churn Rate (%)", Total_Count AS "Total Count",
  Churn_Count AS "Churn Count" FROM rates""",
        RATES_CTE,
    ),
)
def q_rate_pivot(spark, sf):
    """Rate table of every categorical feature, rate descending within each."""
    return R.rate_pivot(R.rate_by_category(clean(spark, sf), "Churn", CATS))


@query(
    "top_drivers",
    with_base("SELECT * FROM rates ORDER BY Churn_Rate_Percentage DESC, Feature, Category LIMIT 10", RATES_CTE),
)
def q_top_drivers(spark, sf):
    """The ten highest category churn rates."""
    return R.top_drivers(R.rate_by_category(clean(spark, sf), "Churn", CATS), 10)


@query(
    "key_feature_rates",
    with_base(
        "SELECT * FROM rates WHERE Feature IN ('Contract', 'PaymentMethod', 'InternetService', 'TechSupport')", RATES_CTE
    ),
)
def q_key_feature_rates(spark, sf):
    """Rates of the four key features, rate descending."""
    return R.key_feature_rates(R.rate_by_category(clean(spark, sf), "Churn", CATS))


@query(
    "label_from_rate",
    with_base(
        """SELECT Feature, Category, Churn_Rate_Percentage,
  CASE WHEN Churn_Rate_Percentage > 45 THEN 'Very High Risk' WHEN Churn_Rate_Percentage > 35 THEN 'High Risk'
       WHEN Churn_Rate_Percentage > 25 THEN 'Medium-High Risk' WHEN Churn_Rate_Percentage > 15 THEN 'Medium Risk'
       ELSE 'Low Risk' END AS Risk_Level FROM rates""",
        RATES_CTE,
    ),
)
def q_label_from_rate(spark, sf):
    """Risk level of every category rate."""
    rates = R.rate_by_category(clean(spark, sf), "Churn", CATS)
    return rates.select("Feature", "Category", "Churn_Rate_Percentage", C.label_from_rate("Churn_Rate_Percentage").alias("Risk_Level"))


@query(
    "target_dist",
    with_base(
        f"""SELECT Churn AS Churn_Status, count(*) AS Count,
  round(count(*) * 100.0{D} / (SELECT count(*) FROM snap), 2) AS Percentage FROM snap GROUP BY Churn"""
    ),
)
def q_target_dist(spark, sf):
    """Count and share of each label value."""
    return R.target_dist(raw(spark, sf), "Churn")


@query(
    "business_summary",
    with_base(
        f"""SELECT round(avg(MonthlyCharges), 2) AS avg_monthly, round(avg(TotalCharges), 2) AS avg_total,
  count(*) AS customers, CAST(sum(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS churners,
  round(sum(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) * 100.0{D} / count(*), 2) AS churn_rate FROM clean0"""
    ),
)
def q_business_summary(spark, sf):
    """Mean monthly and total charges, customers, churners, churn rate."""
    return R.business_summary(eda_frame(spark, sf), "Churn", "MonthlyCharges", "TotalCharges")


@query(
    "revenue_at_risk",
    with_base(
        f"""SELECT round(sum(CASE WHEN Churn = 'Yes' THEN MonthlyCharges END), 2) AS monthly_revenue_at_risk,
  round(sum(CASE WHEN Churn = 'Yes' THEN TotalCharges END), 2) AS lifetime_value_lost,
  round(sum(CASE WHEN Churn = 'Yes' THEN MonthlyCharges END) * 100.0{D} / sum(MonthlyCharges), 2) AS revenue_share_pct
FROM clean"""
    ),
)
def q_revenue_at_risk(spark, sf):
    """Monthly and lifetime revenue of churners, and their revenue share."""
    return R.revenue_at_risk(clean(spark, sf), "Churn", "MonthlyCharges", "TotalCharges")


# --- profiling ---------------------------------------------------------------
@query(
    "profile_summary",
    with_base(
        f"""SELECT * FROM (VALUES
  ('Total Rows', (SELECT count(*) FROM snap)),
  ('Total Columns', {len(S.SNAPSHOT_COLUMNS)}),
  ('Duplicate Rows', (SELECT count(*) FROM snap) - (SELECT count(*) FROM (SELECT DISTINCT * FROM snap))),
  ('Missing Values (Total)', (SELECT {" + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in S.SNAPSHOT_COLUMNS)} FROM snap))) t(Metric, Value)"""
    ),
)
def q_profile_summary(spark, sf):
    """Rows, columns, duplicate rows, missing cells of the raw table."""
    return PR.overview(raw(spark, sf))


@query(
    "profile_missing",
    with_base(
        " UNION ALL ".join(
            f"SELECT '{c}' AS Column, count(*) FILTER (WHERE {c} IS NULL) AS Missing_Count, "
            f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0{D} / count(*), 2) AS Missing_Percentage "
            f"FROM clean0 HAVING count(*) FILTER (WHERE {c} IS NULL) > 0" for c in S.SNAPSHOT_COLUMNS)
    ),
)
def q_profile_missing(spark, sf):
    """Columns with NULLs after numeric coercion, with count and share."""
    return PR.missing_report(eda_frame(spark, sf))


@query(
    "profile_blank",
    with_base(
        "SELECT * FROM (VALUES "
        + ", ".join(
            f"('{c}', (SELECT count(*) FILTER (WHERE {c} = ' ') FROM snap))"
            for c in ["Region", "Contract", "PaymentMethod", "InternetService", *K.SUPPORT_SERVICES, "TotalCharges", "Churn"]
        )
        + ') t("Column", Blank_Count)'
    ),
)
def q_profile_blank(spark, sf):
    """Single-space blanks per text column of the raw table."""
    return PR.blank_counts(raw(spark, sf))


_TYPES_COLS = [c for c in S.SNAPSHOT_COLUMNS]


def _types_sql() -> str:
    parts = []
    for c in _TYPES_COLS:
        parts.append(
            f"""SELECT '{c}' AS Column,
  (SELECT CASE typeof(any_value({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
          WHEN 'DOUBLE' THEN 'double' ELSE lower(typeof(any_value({c}))) END FROM snap) AS Data_Type,
  (SELECT count(DISTINCT CAST({c} AS VARCHAR)) FROM snap) AS Unique_Values,
  (SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) FROM
     (SELECT DISTINCT {c} AS v FROM snap WHERE {c} IS NOT NULL ORDER BY v LIMIT 3)) AS Sample_Values"""
        )
    return "\nUNION ALL\n".join(parts)


@query("profile_types", with_base(_types_sql()))
def q_profile_types(spark, sf):
    """Type, distinct count and three smallest values of every column."""
    return PR.types_report(raw(spark, sf))


def _describe_sql() -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS Feature, CAST({c} AS DOUBLE) AS x FROM clean0" for c in NUMS)

    def r(e):
        return f"CASE WHEN abs({e}) < 1000 THEN round({e}, 2) ELSE round({e}, 1) END"

    return f"""SELECT Feature, CAST(count(x) AS DOUBLE) AS count, {r('avg(x)')} AS mean, {r('stddev_samp(x)')} AS std,
  {r('min(x)')} AS min, {r('quantile_cont(x, 0.25)')} AS q25, {r('quantile_cont(x, 0.5)')} AS q50,
  {r('quantile_cont(x, 0.75)')} AS q75, {r('max(x)')} AS max
FROM ({long}) GROUP BY Feature"""


@query("describe", with_base(_describe_sql()))
def q_describe(spark, sf):
    """count, mean, std, min, quartiles (exact), max per numeric column."""
    return PR.describe(eda_frame(spark, sf), NUMS)


def _outliers_sql() -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS Feature, CAST({c} AS DOUBLE) AS x FROM clean0" for c in NUMS)

    def r(e):
        return f"CASE WHEN abs({e}) < 1000 THEN round({e}, 2) ELSE round({e}, 1) END"

    return f"""SELECT l.Feature, {r('lo')} AS Lower_Bound, {r('hi')} AS Upper_Bound,
  count(*) FILTER (WHERE x < lo OR x > hi) AS Outlier_Count,
  round(count(*) FILTER (WHERE x < lo OR x > hi) * 100.0{D} / count(*), 2) AS Outlier_Percentage,
  {r('min(x)')} AS Min_Value, {r('max(x)')} AS Max_Value
FROM ({long}) l JOIN (
  SELECT Feature, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT Feature, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM ({long}) GROUP BY Feature)
) b USING (Feature) GROUP BY l.Feature, lo, hi"""


@query("outliers_iqr", with_base(_outliers_sql()))
def q_outliers(spark, sf):
    """IQR bounds, outlier count and share, min and max per numeric column."""
    return PR.outliers_iqr(eda_frame(spark, sf), NUMS)


CORR_COLS = [*NUMS, "Churn01"]


def _corr_sql() -> str:
    parts = [
        f"SELECT '{a}' AS Feature_1, '{b}' AS Feature_2, round(corr({a}, {b}), 2) AS Correlation FROM c"
        for a in CORR_COLS
        for b in CORR_COLS
    ]
    return "\nUNION ALL\n".join(parts)


@query(
    "corr_matrix",
    with_base(_corr_sql(), "c AS (SELECT *, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS Churn01 FROM clean0)"),
)
def q_corr(spark, sf):
    """Pearson correlations of the numerics and the 0/1 label, pairwise complete."""
    df = eda_frame(spark, sf).withColumn("Churn01", (F.col("Churn") == "Yes").cast("int"))
    return PR.corr_matrix(df, CORR_COLS)


# --- interactions, profiles, bivariate, bins ----------------------------------
def _tenure_case(col="tenure", labels=K.TENURE_LABELS_EDA):
    e = K.TENURE_EDGES_EDA
    return "CASE " + " ".join(f"WHEN {col} > {e[i]} AND {col} <= {e[i+1]} THEN '{labels[i]}'" for i in range(4)) + " END"


INTER_CTE = f"""
terc AS (SELECT quantile_cont(MonthlyCharges, [0.0, 1.0/3, 2.0/3, 1.0]) AS e FROM clean0),
idf AS (
  SELECT CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y, Contract, PaymentMethod, InternetService,
    {_tenure_case()} AS tg,
    CASE WHEN MonthlyCharges >= e[1] AND MonthlyCharges <= e[2] THEN 'Low'
         WHEN MonthlyCharges > e[2] AND MonthlyCharges <= e[3] THEN 'Medium'
         WHEN MonthlyCharges > e[3] AND MonthlyCharges <= e[4] THEN 'High' END AS cg,
    CASE WHEN SeniorCitizen = 1 THEN 'Senior' WHEN SeniorCitizen = 0 THEN 'Non-Senior' END AS sen,
    CAST({'+'.join(f"(CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END)" for c in K.SUPPORT_SERVICES)} AS VARCHAR) || ' services' AS sup
  FROM clean0, terc),
icells AS (
  SELECT '{K.INTERACTION_NAMES[0]}' AS Interaction, Contract AS Category_1, tg AS Category_2, y FROM idf
  UNION ALL SELECT '{K.INTERACTION_NAMES[1]}', PaymentMethod, Contract, y FROM idf
  UNION ALL SELECT '{K.INTERACTION_NAMES[2]}', sen, cg, y FROM idf
  UNION ALL SELECT '{K.INTERACTION_NAMES[3]}', InternetService, sup, y FROM idf),
inter AS (
  SELECT Interaction, Category_1, Category_2, count(*) AS Sample_Size,
    round(sum(y) * 100.0{D} / count(*), 2) AS Churn_Rate, CAST(sum(y) AS BIGINT) AS Churn_Count
  FROM icells WHERE Category_1 IS NOT NULL AND Category_2 IS NOT NULL GROUP BY ALL)"""


def _inter(spark, sf):
    d, pairs = R.interaction_frame(eda_frame(spark, sf))
    return R.interactions(d, "Churn", pairs)


@query("interactions", with_base("SELECT * FROM inter", INTER_CTE))
def q_interactions(spark, sf):
    """Churn rate and size of every non-empty cell of the four interaction pairs."""
    return _inter(spark, sf)


@query(
    "interactions_pivot",
    with_base(
        "SELECT Category_1, "
        + ", ".join(
            f"""avg(Churn_Rate) FILTER (WHERE Category_2 = '{lab}') AS "{lab}\""""
            for lab in K.TENURE_LABELS_EDA
        )
        + f" FROM inter WHERE Interaction = '{K.INTERACTION_NAMES[0]}' GROUP BY Category_1",
        INTER_CTE,
    ),
)
def q_interactions_pivot(spark, sf):
    """Contract x tenure-group churn-rate matrix."""
    return R.interactions_pivot(_inter(spark, sf), K.INTERACTION_NAMES[0], K.TENURE_LABELS_EDA)


PROFILE_CTE = f"""
pf AS (SELECT *, {_tenure_case(labels=K.TENURE_LABELS_PROFILE)} AS tenure_group,
  {'+'.join(f"(CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END)" for c in K.SUPPORT_SERVICES)} AS support_count FROM clean0),
pg AS (
  SELECT Contract, PaymentMethod, tenure_group, support_count, InternetService, SeniorCitizen,
    count(*) AS Total_Customers, CAST(sum(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS Churn_Count,
    sum(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) * 100.0{D} / count(*) AS rate
  FROM pf WHERE tenure_group IS NOT NULL GROUP BY ALL),
pd AS (
  SELECT *, Contract || ' + ' || PaymentMethod || ' + ' || tenure_group || ' tenure + ' || CAST(support_count AS VARCHAR)
    || ' support' || CASE WHEN InternetService != 'No' THEN ' + ' || InternetService ELSE '' END
    || CASE WHEN SeniorCitizen = 1 THEN ' + Senior' ELSE '' END AS Profile,
    CASE WHEN rate > 45 THEN 'Very High Risk' WHEN rate > 35 THEN 'High Risk' WHEN rate > 25 THEN 'Medium-High Risk'
         WHEN rate > 15 THEN 'Medium Risk' ELSE 'Low Risk' END AS Risk_Level
  FROM pg)"""


@query(
    "risky_profiles",
    with_base(
        """SELECT CAST(row_number() OVER (ORDER BY rate DESC, Contract, PaymentMethod, tenure_group, support_count,
    InternetService, SeniorCitizen) AS INTEGER) AS Rank, Profile, Contract, PaymentMethod, tenure_group AS Tenure_Group,
  CAST(support_count AS INTEGER) AS Support_Count, InternetService, SeniorCitizen, Total_Customers, Churn_Count,
  round(rate, 2) AS Churn_Rate, Risk_Level
FROM pd ORDER BY rate DESC, Contract, PaymentMethod, tenure_group, support_count, InternetService, SeniorCitizen LIMIT 20""",
        PROFILE_CTE,
    ),
)
def q_risky_profiles(spark, sf):
    """The 20 profiles with the highest churn rate, ranked, with risk level."""
    return R.risky_profiles(R.profile_frame(eda_frame(spark, sf)), "Churn", top_n=20)


@query("describe_profile", with_base("SELECT Profile, Total_Customers FROM pd", PROFILE_CTE))
def q_describe_profile(spark, sf):
    """Profile description of every (contract, payment, tenure, support, internet, senior) group."""
    d = R.profile_frame(eda_frame(spark, sf))
    keys = K.PROFILE_KEYS
    g = d.where(F.col("tenure_group").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("Total_Customers"))
    return g.select(C.describe_profile().alias("Profile"), "Total_Customers")


BIV_PAIRS = K.BIVARIATE_PAIRS


def _biv_frame(spark, sf):
    return eda_frame(spark, sf).withColumn("tenure_group", C.bin_fixed("tenure", K.TENURE_EDGES_EDA, K.TENURE_LABELS_EDA))


BIV_CTE = f"""
bf AS (SELECT *, {_tenure_case()} AS tenure_group, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y FROM clean0),
bcells AS (
  {' UNION ALL '.join(f"SELECT '{a}' AS Feature_1, '{b}' AS Feature_2, CAST({a} AS VARCHAR) AS Category_1, CAST({b} AS VARCHAR) AS Category_2, y FROM bf" for a, b in BIV_PAIRS)}),
bagg AS (SELECT Feature_1, Feature_2, Category_1, Category_2, count(*) AS n, sum(y) AS pos
  FROM bcells WHERE Category_1 IS NOT NULL AND Category_2 IS NOT NULL GROUP BY ALL),
bgrid AS (
  SELECT a.Feature_1, a.Feature_2, a.Category_1, b.Category_2
  FROM (SELECT DISTINCT Feature_1, Feature_2, Category_1 FROM bagg) a
  JOIN (SELECT DISTINCT Feature_1, Feature_2, Category_2 FROM bagg) b USING (Feature_1, Feature_2)),
bfull AS (
  SELECT g.*, coalesce(n, 0) AS n, pos FROM bgrid g LEFT JOIN bagg USING (Feature_1, Feature_2, Category_1, Category_2)),
bm AS (
  SELECT *, sum(n) OVER (PARTITION BY Feature_1, Feature_2, Category_1) AS r_tot,
    sum(n) OVER (PARTITION BY Feature_1, Feature_2, Category_2) AS c_tot,
    sum(n) OVER (PARTITION BY Feature_1, Feature_2) AS tot,
    count(DISTINCT Category_1) OVER (PARTITION BY Feature_1, Feature_2) AS n_r,
    count(DISTINCT Category_2) OVER (PARTITION BY Feature_1, Feature_2) AS n_c
  FROM bfull),
bstat AS (
  SELECT Feature_1, Feature_2,
    sum(power(greatest(abs(n - r_tot * c_tot * 1.0{D} / tot) - CASE WHEN (n_r - 1) * (n_c - 1) = 1 THEN 0.5 ELSE 0 END, 0), 2)
        / (r_tot * c_tot * 1.0{D} / tot)) AS chi2,
    any_value(tot) AS tot, any_value(least(n_r, n_c)) AS k, any_value((n_r - 1) * (n_c - 1)) AS dof
  FROM bm GROUP BY Feature_1, Feature_2)"""


@query(
    "bivariate",
    with_base(
        """SELECT f.Feature_1, f.Feature_2, f.Category_1, f.Category_2,
  round(pos * 100.0::DOUBLE / nullif(n, 0), 2) AS Churn_Rate, f.n AS Sample_Size,
  round(chi2, 2) AS Chi2_Statistic, CAST(dof AS BIGINT) AS dof, round(sqrt(chi2 / (tot * (k - 1))), 2) AS Cramers_V
FROM bfull f JOIN bstat USING (Feature_1, Feature_2)""",
        BIV_CTE,
    ),
)
def q_bivariate(spark, sf):
    """Every cell of five feature pairs: churn rate, size, and the pair's chi2, dof, Cramer's V."""
    from ..operators.stats import bivariate_table

    out = bivariate_table(_biv_frame(spark, sf), "Churn", BIV_PAIRS, with_p=False)
    return out.select(
        "Feature_1", "Feature_2", "Category_1", "Category_2", F.round("Churn_Rate", 2).alias("Churn_Rate"),
        "Sample_Size", F.round("Chi2_Statistic", 2).alias("Chi2_Statistic"), "dof", F.round("Cramers_V", 2).alias("Cramers_V"),
    )


@query(
    "bivariate_pivot",
    with_base(
        """SELECT Feature_1, Feature_2, Category_1, Category_2,
  coalesce(round(pos * 100.0::DOUBLE / nullif(n, 0), 2), 0.0) AS "Churn Rate (%)", CAST(n AS BIGINT) AS "Sample Size"
FROM bfull""",
        BIV_CTE,
    ),
)
def q_bivariate_pivot(spark, sf):
    """Rates (empty cells 0) and sizes of all five feature pairs, rate descending within each."""
    cells = R.bivariate_cells(_biv_frame(spark, sf), "Churn", BIV_PAIRS)
    return cells.select(
        "Feature_1", "Feature_2", "Category_1", "Category_2",
        F.coalesce(F.round("Churn_Rate", 2), F.lit(0.0)).alias("Churn Rate (%)"),
        F.col("Sample_Size").cast("long").alias("Sample Size"),
    ).orderBy("Feature_1", "Feature_2", F.desc("Churn Rate (%)"), "Category_1", "Category_2")


def _nonlinear_sql() -> str:
    parts = []
    for c in NUMS:
        parts.append(
            f"""SELECT '{c}' AS Feature, i AS bin, i * ((hi - lo) / 9) + lo AS Bin_Low,
  CASE WHEN i = 8 THEN hi ELSE (i + 1) * ((hi - lo) / 9) + lo END AS Bin_High,
  (SELECT avg({c}) FROM clean0 WHERE {c} > i * ((hi - lo) / 9) + lo AND {c} <= CASE WHEN i = 8 THEN hi ELSE (i + 1) * ((hi - lo) / 9) + lo END) AS Bin_Center,
  (SELECT avg(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END) * 100 FROM clean0 WHERE {c} > i * ((hi - lo) / 9) + lo AND {c} <= CASE WHEN i = 8 THEN hi ELSE (i + 1) * ((hi - lo) / 9) + lo END) AS Churn_Rate
FROM range(9) r(i), (SELECT min({c}) AS lo, max({c}) AS hi FROM clean0) m"""
        )
    body = "\nUNION ALL\n".join(parts)
    return f"""SELECT Feature, CAST(bin AS INTEGER) AS bin, round(Bin_Low, 3) AS Bin_Low, round(Bin_High, 3) AS Bin_High,
  CASE WHEN abs(Bin_Center) < 1000 THEN round(Bin_Center, 2) ELSE round(Bin_Center, 1) END AS Bin_Center,
  round(Churn_Rate, 2) AS Churn_Rate FROM ({body})"""


@query("nonlinear_bins", with_base(_nonlinear_sql()))
def q_nonlinear(spark, sf):
    """Per numeric column and equal-width bin: centre and churn rate (empty bins kept)."""
    out = R.nonlinear_bins(eda_frame(spark, sf), "Churn", NUMS)
    return out.select(
        "Feature", "bin", F.round("Bin_Low", 3).alias("Bin_Low"), F.round("Bin_High", 3).alias("Bin_High"),
        C.round_by_rule("Bin_Center").alias("Bin_Center"), F.round("Churn_Rate", 2).alias("Churn_Rate"),
    )


@query(
    "eda_summary",
    with_base(
        f"""SELECT * FROM (VALUES
  ('rows', (SELECT count(*) FROM snap)::DOUBLE),
  ('columns', {len(S.SNAPSHOT_COLUMNS)}::DOUBLE),
  ('duplicate_rows', ((SELECT count(*) FROM snap) - (SELECT count(*) FROM (SELECT DISTINCT * FROM snap)))::DOUBLE),
  ('count_No', (SELECT count(*) FROM snap WHERE Churn = 'No')::DOUBLE),
  ('count_Yes', (SELECT count(*) FROM snap WHERE Churn = 'Yes')::DOUBLE),
  ('pct_No', round((SELECT count(*) FROM snap WHERE Churn = 'No') * 100.0{D} / (SELECT count(*) FROM snap), 2)),
  ('pct_Yes', round((SELECT count(*) FROM snap WHERE Churn = 'Yes') * 100.0{D} / (SELECT count(*) FROM snap), 2)),
  ('imbalance_ratio', round((SELECT min(n) * 1.0{D} / max(n) FROM (SELECT count(*) AS n FROM snap GROUP BY Churn)), 3)),
  ('blank_TotalCharges', (SELECT count(*) FROM snap WHERE TotalCharges = ' ')::DOUBLE)) t(Metric, Value)"""
    ),
)
def q_eda_summary(spark, sf):
    """Shape, duplicates, class counts and shares, imbalance, blank totals."""
    from .eda import eda_summary

    return eda_summary(raw(spark, sf), "Churn", "TotalCharges")


#: of each exploratory table: the query whose rows it has, the columns that
#: name a row, and those that hold numbers
EDA_TABLES = {
    "overview": ("profile_summary", ["Metric"], ["Value"]),
    "missing": ("profile_missing", ["Column"], ["Missing_Count", "Missing_Percentage"]),
    "types": ("profile_types", ["Column", "Data_Type", "Sample_Values"], ["Unique_Values"]),
    "churn_distribution": ("target_dist", ["Churn_Status"], ["Count", "Percentage"]),
    "numerical_stats": ("describe", ["Feature"], ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]),
    "outliers": ("outliers_iqr", ["Feature"], ["Lower_Bound", "Upper_Bound", "Outlier_Count", "Outlier_Percentage", "Min_Value", "Max_Value"]),
    "correlations": ("corr_matrix", ["Feature_1", "Feature_2"], ["Correlation"]),
    "categorical_distributions": ("cat_dist", ["Feature", "Category"], ["Count", "Percentage"]),
    "churn_rates": ("rate_by_category", ["Feature", "Category"], ["Total_Count", "Churn_Count", "Churn_Rate_Percentage"]),
    "hypothesis_1": ("h1_chi2", [], ["Group_A_Rate", "Group_B_Rate", "Chi2_Statistic"]),
    "hypothesis_4": ("h4_chi2", [], ["Group_A_Rate", "Group_B_Rate", "Chi2_Statistic"]),
    "distribution_comparison": ("dist_by_label", ["Feature"], ["Churn_Mean", "No_Churn_Mean", "Churn_Median", "No_Churn_Median", "Churn_Q1", "Churn_Q3", "No_Churn_Q1", "No_Churn_Q3", "KS_Statistic", "MannWhitney_U"]),
    "feature_interactions": ("interactions", ["Interaction", "Category_1", "Category_2"], ["Sample_Size", "Churn_Rate", "Churn_Count"]),
    "riskiest_profiles": ("risky_profiles", ["Rank", "Contract", "PaymentMethod", "Risk_Level"], ["Total_Customers", "Churn_Count", "Churn_Rate"]),
    "bivariate_analysis": ("bivariate", ["Feature_1", "Feature_2", "Category_1", "Category_2"], ["Churn_Rate", "Sample_Size", "Chi2_Statistic", "dof", "Cramers_V"]),
    "nonlinear_relationships": ("nonlinear_bins", ["Feature", "bin"], ["Bin_Low", "Bin_High", "Bin_Center", "Churn_Rate"]),
    "preliminary_importance": ("importance_rank", ["Rank", "Feature", "Type"], ["Importance_Score"]),
    "summary": ("eda_summary", ["Metric"], ["Value"]),
}


def run_eda_sql(oracle: dict[str, str]) -> str:
    parts = []
    for table, (name, keys, numbers) in EDA_TABLES.items():
        row = " || ' | ' || ".join(f"coalesce(CAST(\"{k}\" AS VARCHAR), '')" for k in keys) or "''"
        values = ", ".join(f"{{'column': '{c}', 'value': round(CAST(\"{c}\" AS DOUBLE), 4)}}" for c in numbers)
        parts.append(f"SELECT '{table}' AS \"table\", r AS row, v.column AS column, v.value AS value FROM (SELECT {row} AS r, unnest([{values}]) AS v FROM ({oracle[name]}))")
    return " UNION ALL ".join(parts)


@query("run_eda")
def q_run_eda(spark, sf):
    """The contents of all exploratory tables in one long frame."""
    from .catalog import QUERIES
    from .eda import SNAPSHOT, long_form, run_eda

    tables = run_eda(raw(spark, sf), SNAPSHOT)
    out = None
    for table, (name, keys, numbers) in EDA_TABLES.items():
        # the library's table, where its query shows it whole and as it is
        df = tables[table] if table in PLAIN_TABLES else QUERIES[name](spark, sf)
        part = long_form(table, df, numbers, keys)
        out = part if out is None else out.unionByName(part)
    return out


PLAIN_TABLES = {"overview", "missing", "types", "churn_distribution", "numerical_stats", "outliers", "correlations", "feature_interactions", "riskiest_profiles", "summary"}
