"""Registered queries: sources, cleaning, scalar features, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..operators import clean as CL
from ..operators import features as FE
from ..operators import split as SP
from ..session import shared_path
from ..sources import snapshot as S
from .catalog import query
from .sql_base import with_base

SPEC = FE.snapshot_spec()
CM, PM = SPEC.contract_map, SPEC.payment_map
TE = list(SPEC.tenure_edges)
TL = list(SPEC.tenure_labels)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return S.snapshot_cached(spark, sf, cleaned=False)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned snapshot, identifier kept as the scoring key."""
    return S.snapshot_cached(spark, sf, cleaned=True)


def featured(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned snapshot + the seven features (median fitted on it, as the
    reference's feature step does), persisted once per session."""
    return S.session_cached(spark, (sf, "featured"), lambda: FE.add_features(clean(spark, sf), SPEC))


# --- SQL fragments mirroring the operators -------------------------------
def case_map(col: str, mapping: dict, default: int = K.UNMAPPED_RISK) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {default} END)"


def case_bins(col: str, edges, labels) -> str:
    whens = " ".join(
        f"WHEN {col} > {edges[i]} AND {col} <= {edges[i + 1]} THEN '{labels[i]}'" for i in range(len(labels))
    )
    return f"(CASE {whens} ELSE NULL END)"


def support_sql(cols=K.SUPPORT_SERVICES) -> str:
    return "(" + " + ".join(f"(CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END)" for c in cols) + ")"


def fiber_sql(value: str, col: str = "InternetService") -> str:
    anyf = " OR ".join(f"coalesce({c} = 'Yes', false)" for c in K.SUPPORT_SERVICES)
    return f"(CASE WHEN coalesce({col} = '{value}', false) AND NOT ({anyf}) THEN 1 ELSE 0 END)"


FEATURES_SQL = f"""
SELECT clean.*,
  {case_map('Contract', CM)} AS contract_risk_score,
  {case_bins('tenure', TE, TL)} AS tenure_group,
  {case_map('PaymentMethod', PM)} AS payment_risk_score,
  {support_sql()} AS support_services_count,
  TotalCharges / (tenure + 1) AS charge_per_month,
  CASE WHEN SeniorCitizen = 1 AND MonthlyCharges > (SELECT quantile_cont(MonthlyCharges, 0.5) FROM clean)
       THEN 1 ELSE 0 END AS senior_high_charge,
  {fiber_sql(SPEC.fiber_value)} AS fiber_optic_no_support
FROM clean
"""
FEATURES_CTE = f"feat AS ({FEATURES_SQL})"


# --- sources --------------------------------------------------------------
@query("src_table", with_base("SELECT * FROM snap"))
def q_src_table(spark, sf):
    """The attrition table as loaded (raw: totals still text)."""
    return raw(spark, sf)


@query("src_eda", with_base("SELECT Churn, count(*) AS n_rows, count(*) FILTER (WHERE TotalCharges = ' ') AS n_blank_totals FROM snap GROUP BY Churn"))
def q_src_eda(spark, sf):
    """EDA view: the same uncleaned source; blanks still present."""
    return raw(spark, sf).groupBy("Churn").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("TotalCharges") == " ").alias("n_blank_totals")
    )


@query("drop_id", with_base("SELECT * EXCLUDE (customerID) FROM snap"))
def q_drop_id(spark, sf):
    """The raw table without its identifier."""
    return CL.drop_id(raw(spark, sf), "customerID")


@query("clean", with_base("SELECT * EXCLUDE (customerID) FROM clean"))
def q_clean(spark, sf):
    """The whole cleaner, as the reference runs it (identifier dropped)."""
    return CL.clean_table(S.customer_snapshot(spark, sf), id_col="customerID")


@query(
    "clean_cast",
    with_base(
        "SELECT customerID, TotalCharges AS TotalCharges_raw, "
        "TRY_CAST(CASE WHEN trim(TotalCharges) = '' THEN NULL ELSE TotalCharges END AS DOUBLE) AS TotalCharges_num FROM snap"
    ),
)
def q_clean_cast(spark, sf):
    """Blank-tolerant numeric conversion of the raw total (blank -> NULL)."""
    r = raw(spark, sf)
    return r.select("customerID", F.col("TotalCharges").alias("TotalCharges_raw"), C.to_number("TotalCharges").alias("TotalCharges_num"))


@query(
    "clean_impute",
    with_base(
        "SELECT s.customerID, s.tenure, s.TotalCharges = ' ' AS was_blank, c.TotalCharges "
        "FROM snap s JOIN clean c USING (customerID)"
    ),
)
def q_clean_impute(spark, sf):
    """Imputed totals next to the raw blank flag and tenure."""
    r = raw(spark, sf).select("customerID", "tenure", (F.col("TotalCharges") == " ").alias("was_blank"))
    return r.join(clean(spark, sf).select("customerID", "TotalCharges"), "customerID")


# --- scalar features ----------------------------------------------------------
@query("map_score_contract", with_base(f"SELECT customerID, Contract, {case_map('Contract', CM)} AS contract_risk_score FROM clean"))
def q_map_contract(spark, sf):
    """Contract risk score (3/2/1, unmapped -> 2)."""
    return clean(spark, sf).select("customerID", "Contract", C.contract_risk_score("Contract", CM).alias("contract_risk_score"))


@query("map_score_payment", with_base(f"SELECT customerID, PaymentMethod, {case_map('PaymentMethod', PM)} AS payment_risk_score FROM clean"))
def q_map_payment(spark, sf):
    """Payment risk score (3/2/1/1, unmapped -> 2)."""
    return clean(spark, sf).select("customerID", "PaymentMethod", C.payment_risk_score("PaymentMethod", PM).alias("payment_risk_score"))


@query("bin_fixed", with_base(f"SELECT customerID, tenure, {case_bins('tenure', TE, TL)} AS tenure_group FROM clean"))
def q_bin_fixed(spark, sf):
    """Right-closed fixed tenure bins with the snapshot's edges."""
    return clean(spark, sf).select("customerID", "tenure", C.tenure_group("tenure", TE, TL).alias("tenure_group"))


@query(
    "bin_fixed_eda",
    with_base(f"SELECT customerID, tenure, {case_bins('tenure', K.TENURE_EDGES_EDA, K.TENURE_LABELS_EDA)} AS tenure_group FROM clean"),
)
def q_bin_fixed_eda(spark, sf):
    """Right-closed tenure bins with the exploratory edges (top edge 100)."""
    return clean(spark, sf).select(
        "customerID", "tenure", C.bin_fixed("tenure", K.TENURE_EDGES_EDA, K.TENURE_LABELS_EDA).alias("tenure_group")
    )


@query(
    "bin_quantile",
    with_base(
        """
SELECT customerID, MonthlyCharges,
  CASE WHEN MonthlyCharges >= e[1] AND MonthlyCharges <= e[2] THEN 'Low'
       WHEN MonthlyCharges > e[2] AND MonthlyCharges <= e[3] THEN 'Medium'
       WHEN MonthlyCharges > e[3] AND MonthlyCharges <= e[4] THEN 'High' END AS MonthlyCharges_group
FROM clean, (SELECT quantile_cont(MonthlyCharges, [0.0, 1.0/3, 2.0/3, 1.0]) AS e FROM clean) q
"""
    ),
)
def q_bin_quantile(spark, sf):
    """Monthly-charge terciles from exact quantile edges (lowest edge included)."""
    from ..operators.rates import bin_including_lowest, charge_terciles

    df = clean(spark, sf)
    edges, labels = charge_terciles(df, "MonthlyCharges")
    return df.select("customerID", "MonthlyCharges", bin_including_lowest("MonthlyCharges", edges, labels).alias("MonthlyCharges_group"))


@query(
    "bin_width",
    with_base(
        """
SELECT customerID, MonthlyCharges,
  CASE WHEN MonthlyCharges > lo AND MonthlyCharges <= hi
       THEN CAST((SELECT count(*) FROM range(9) r(i) WHERE i * ((hi - lo) / 9) + lo < MonthlyCharges) AS INTEGER) - 1
  END AS bin
FROM clean, (SELECT min(MonthlyCharges) AS lo, max(MonthlyCharges) AS hi FROM clean) m
"""
    ),
)
def q_bin_width(spark, sf):
    """Nine equal-width bins between min and max; the minimum falls out."""
    df = clean(spark, sf)
    ext = df.agg(F.min("MonthlyCharges").alias("lo"), F.max("MonthlyCharges").alias("hi")).first()
    edges = C.linspace(ext["lo"], ext["hi"], 10)
    return df.select("customerID", "MonthlyCharges", C.bin_fixed("MonthlyCharges", edges).alias("bin"))


@query("count_flags", with_base(f"SELECT customerID, CAST({support_sql()} AS INTEGER) AS support_services_count FROM clean"))
def q_count_flags(spark, sf):
    """Number of support services with 'Yes'."""
    return clean(spark, sf).select("customerID", C.support_services_count().alias("support_services_count"))


@query("ratio", with_base("SELECT customerID, TotalCharges / (tenure + 1) AS charge_per_month FROM clean"))
def q_ratio(spark, sf):
    """Lifetime charge per month: total / (tenure + 1)."""
    return clean(spark, sf).select("customerID", C.ratio("TotalCharges", "tenure", 1).alias("charge_per_month"))


@query(
    "flag_above_median",
    with_base(
        "SELECT customerID, CASE WHEN SeniorCitizen = 1 AND MonthlyCharges > (SELECT quantile_cont(MonthlyCharges, 0.5) FROM clean) "
        "THEN 1 ELSE 0 END AS senior_high_charge FROM clean"
    ),
)
def q_flag_above_median(spark, sf):
    """Senior and above the fitted monthly-charge median."""
    df = clean(spark, sf)
    spec = FE.fit_feature_params(df, SPEC)
    return df.select("customerID", C.flag_above("SeniorCitizen", "MonthlyCharges", spec.monthly_median).alias("senior_high_charge"))


@query("flag_combo_absent", with_base(f"SELECT customerID, {fiber_sql(SPEC.fiber_value)} AS fiber_optic_no_support FROM clean"))
def q_flag_combo(spark, sf):
    """Given internet service and none of the four support services."""
    return clean(spark, sf).select(
        "customerID", C.flag_combo_absent("InternetService", SPEC.fiber_value, K.SUPPORT_SERVICES).alias("fiber_optic_no_support")
    )


@query("features_all", with_base("SELECT * FROM feat", FEATURES_CTE))
def q_features_all(spark, sf):
    """The cleaned table with all seven engineered features."""
    return featured(spark, sf)


RISK_RULES_SQL = f"""
concat_ws('; ', list_filter([
  CASE WHEN Contract = 'MACHINERY' THEN '{K.RISK_FACTOR_TEXT[0]}' END,
  CASE WHEN tenure < 61 THEN '{K.RISK_FACTOR_TEXT[1]}' END,
  CASE WHEN TechSupport = 'No' THEN '{K.RISK_FACTOR_TEXT[2]}' END,
  CASE WHEN PaymentMethod = '1-URGENT' THEN '{K.RISK_FACTOR_TEXT[3]}' END], lambda x: x IS NOT NULL))"""


def snapshot_risk_rules():
    # the snapshot's analogues of the four form rules: the top-risk segment
    # and priority, tenure below the first group edge, no tech support
    return C.reference_risk_factor_rules(monthly_value="MACHINERY", tenure_below=61, risky_payment="1-URGENT")


@query(
    "risk_factors",
    with_base(
        f"SELECT customerID, {RISK_RULES_SQL} AS risk_factors, "
        f"CAST((CASE WHEN Contract = 'MACHINERY' THEN 1 ELSE 0 END) + (CASE WHEN tenure < 61 THEN 1 ELSE 0 END) + "
        f"(CASE WHEN TechSupport = 'No' THEN 1 ELSE 0 END) + (CASE WHEN PaymentMethod = '1-URGENT' THEN 1 ELSE 0 END) AS INTEGER) AS n_factors FROM clean"
    ),
)
def q_risk_factors(spark, sf):
    """Per customer: the risk-factor rules that hold, and their number."""
    arr = C.risk_factors(snapshot_risk_rules())
    return clean(spark, sf).select("customerID", F.concat_ws("; ", arr).alias("risk_factors"), F.size(arr).alias("n_factors"))


# --- a deterministic formula score (metrics before any model) ---------------
RULE_SCORE_SQL = "(contract_risk_score + payment_risk_score + (4 - support_services_count) + SeniorCitizen) / 11.0::DOUBLE"


def rule_score(df: DataFrame) -> F.Column:
    """(contract + payment + missing support + senior) / 11 in [0, 1]:
    a fixed formula, so metric operators can be checked exactly before
    any model is trained."""
    return (
        F.col("contract_risk_score") + F.col("payment_risk_score") + (4 - F.col("support_services_count")) + F.col("SeniorCitizen")
    ) / 11.0


@query(
    "risk_band",
    with_base(
        f"""SELECT customerID, {RULE_SCORE_SQL} AS probability,
  CASE WHEN {RULE_SCORE_SQL} > 0.5 THEN 'High Risk' ELSE 'Low Risk' END AS risk_band,
  CASE WHEN {RULE_SCORE_SQL} * 100 >= 0 AND {RULE_SCORE_SQL} * 100 < 50 THEN 'green'
       WHEN {RULE_SCORE_SQL} * 100 >= 50 AND {RULE_SCORE_SQL} * 100 < 75 THEN 'yellow'
       WHEN {RULE_SCORE_SQL} * 100 >= 75 AND {RULE_SCORE_SQL} * 100 <= 100 THEN 'red' END AS gauge
FROM feat""",
        FEATURES_CTE,
    ),
)
def q_risk_band(spark, sf):
    """Formula probability, High/Low band and gauge colour."""
    df = featured(spark, sf)
    p = rule_score(df)
    return df.select("customerID", p.alias("probability"), C.risk_band(p).alias("risk_band"), C.gauge_band(p).alias("gauge"))


# --- splits and samples ---------------------------------------------------
def _split_sql(test_pct: int, val_pct: int) -> str:
    h = SP.seeded_hash_sql("customerID")
    rest = 100 - test_pct
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Churn ORDER BY {h}, customerID) - 1 AS r,
         count(*) OVER (PARTITION BY Churn) AS n_l
  FROM clean
),
sized AS (SELECT *, (n_l * {test_pct} + 99) // 100 AS n_test FROM ranked),
cut AS (SELECT *, ((n_l - n_test) * {val_pct} + {rest} - 1) // {rest} AS n_val FROM sized)"""


SPLIT_COLS = ", ".join(S.SNAPSHOT_COLUMNS)
SPLIT_SELECT = f"SELECT {SPLIT_COLS}, CASE WHEN r < n_test THEN 'test' WHEN r < n_test + n_val THEN 'val' ELSE 'train' END AS split FROM cut"


@query("split_strat", with_base(SPLIT_SELECT, _split_sql(20, 20)))
def q_split_strat(spark, sf):
    """60/20/20 stratified split of the cleaned table."""
    return SP.stratified_split(clean(spark, sf), "Churn", "customerID", test_pct=20, val_pct=20)


@query(
    "sink_splits",
    with_base(f"SELECT split, Churn, count(*) AS n FROM ({SPLIT_SELECT}) GROUP BY split, Churn", _split_sql(20, 20)),
)
def q_sink_splits(spark, sf):
    """Write train/val/test (all three) partitioned by split into the shared
    folder, read them back, count per split and label."""
    df = SP.stratified_split(clean(spark, sf), "Churn", "customerID", test_pct=20, val_pct=20)
    path = SP.save_splits(df, shared_path(spark, "splits"))
    back = spark.read.parquet(path)
    return back.groupBy("split", "Churn").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sample_n",
    with_base(
        f"""(SELECT 'explained' AS role, customerID, Churn FROM cut WHERE r < n_test
   ORDER BY {SP.seeded_hash_sql('customerID')}, customerID LIMIT 100)
UNION ALL
(SELECT 'background', customerID, Churn FROM cut WHERE r >= n_test + n_val
   ORDER BY {SP.seeded_hash_sql('customerID')}, customerID LIMIT 300)""",
        _split_sql(20, 20),
    ),
)
def q_sample_n(spark, sf):
    """The seeded explanation samples: at most 100 test rows to explain and
    300 training rows as background (each a distributed top-k by hash)."""
    df = SP.stratified_split(clean(spark, sf), "Churn", "customerID", test_pct=20, val_pct=20)
    explained = SP.seeded_sample(df.where(F.col("split") == "test"), "customerID", 100)
    background = SP.seeded_sample(df.where(F.col("split") == "train"), "customerID", 300)
    return explained.select(F.lit("explained").alias("role"), "customerID", "Churn").unionByName(
        background.select(F.lit("background").alias("role"), "customerID", "Churn")
    )


@query(
    "prep_data",
    with_base(
        """
SELECT split, count(*) AS n, CAST(sum(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
       round(avg(charge_per_month), 2) AS avg_charge_per_month, CAST(sum(support_services_count) AS BIGINT) AS support_total
FROM (SELECT s.split, f.* FROM feat f JOIN (""" + SPLIT_SELECT + """) s USING (customerID))
GROUP BY split""",
        FEATURES_CTE + "," + _split_sql(20, 20),
    ),
)
def q_prep_data(spark, sf):
    """load -> clean -> features -> split, summarised per split."""
    df = SP.stratified_split(featured(spark, sf), "Churn", "customerID", test_pct=20, val_pct=20)
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("Churn") == "Yes").cast("int")).cast("long").alias("n_pos"),
        F.round(F.avg("charge_per_month"), 2).alias("avg_charge_per_month"),
        F.sum("support_services_count").cast("long").alias("support_total"),
    )
