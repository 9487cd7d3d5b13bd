"""Scalar expressions and cleaning on hand-made edge rows."""

from pyspark.sql import functions as F

from attrix.functions import columns as C
from attrix.functions import constants as K
from attrix.operators.clean import clean_table, impute_totals
from attrix.operators.features import FeatureSpec, add_features


def test_tenure_bins_right_closed(spark):
    df = spark.createDataFrame([(t,) for t in [0, 12, 13, 24, 25, 48, 49, 1000, 1001, -1]], "tenure int")
    got = dict(df.select("tenure", C.tenure_group().alias("g")).collect())
    assert got == {0: "New", 12: "New", 13: "Short", 24: "Short", 25: "Medium", 48: "Medium",
                   49: "Long", 1000: "Long", 1001: None, -1: None}


def test_eda_bins_top_edge_100(spark):
    df = spark.createDataFrame([(t,) for t in [100, 101]], "tenure int")
    got = dict(df.select("tenure", C.bin_fixed("tenure", K.TENURE_EDGES_EDA, K.TENURE_LABELS_EDA).alias("g")).collect())
    assert got == {100: "Long (49+)", 101: None}


def test_map_score_default_and_null(spark):
    df = spark.createDataFrame([("Month-to-month",), ("One year",), ("Two year",), ("Weekly",), (None,)], "Contract string")
    got = [r[0] for r in df.select(C.contract_risk_score()).collect()]
    assert got == [3, 2, 1, 2, 2]
    pm = spark.createDataFrame([(k,) for k in K.PAYMENT_RISK] + [("Cash",)], "PaymentMethod string")
    assert [r[0] for r in pm.select(C.payment_risk_score()).collect()] == [3, 2, 1, 1, 2]


def test_to_number_blank_and_junk(spark):
    df = spark.createDataFrame([(" ",), ("", ), ("12.5",), ("abc",), (None,)], "t string")
    assert [r[0] for r in df.select(C.to_number("t")).collect()] == [None, None, 12.5, None, None]


def test_impute_three_steps(spark):
    rows = [
        (0, 20.0, " "),    # tenure 0, blank -> 0
        (0, 30.0, "55.0"),  # tenure 0, not blank -> also 0 (every tenure-0 row)
        (5, 10.0, " "),    # blank, tenure > 0 -> 50
        (7, None, " "),    # blank, no monthly -> median after steps 1-2
        (3, 10.0, "40.0"),
        (4, 10.0, "100.0"),
    ]
    df = spark.createDataFrame(rows, "tenure int, MonthlyCharges double, TotalCharges string")
    out = [r["TotalCharges"] for r in clean_table(df, id_col=None).collect()]
    # after steps 1-2: [0, 0, 50, null, 40, 100] -> median of 5 values = 40
    assert out == [0.0, 0.0, 50.0, 40.0, 40.0, 100.0]


def test_impute_noop_without_nulls(spark):
    df = spark.createDataFrame([(0, 5.0, 7.0)], "tenure int, MonthlyCharges double, TotalCharges double")
    assert impute_totals(df).first()["TotalCharges"] == 7.0


def test_features_all(spark):
    rows = [("Month-to-month", "Electronic check", 1, 0, 80.0, " ", "Fiber optic", "No", "No", "No", "No"),
            ("Two year", "Mailed check", 0, 30, 20.0, "600", "DSL", "Yes", "No", "Yes", "No"),
            ("One year", "Cash", 1, 13, 50.0, "650", "Fiber optic", "No", "No", "No", "Yes")]
    df = spark.createDataFrame(rows, "Contract string, PaymentMethod string, SeniorCitizen int, tenure int, "
                                     "MonthlyCharges double, TotalCharges string, InternetService string, "
                                     "OnlineSecurity string, OnlineBackup string, DeviceProtection string, TechSupport string")
    out = add_features(df, FeatureSpec()).collect()
    assert [r.contract_risk_score for r in out] == [3, 1, 2]
    assert [r.payment_risk_score for r in out] == [3, 2, 2]
    assert [r.tenure_group for r in out] == ["New", "Medium", "Short"]
    assert [r.support_services_count for r in out] == [0, 2, 1]
    assert [r.TotalCharges for r in out] == [0.0, 600.0, 650.0]
    assert [r.charge_per_month for r in out] == [0.0, 600.0 / 31, 650.0 / 14]
    # median of monthly = 50: only the first senior (80 > 50) is flagged
    assert [r.senior_high_charge for r in out] == [1, 0, 0]
    assert [r.fiber_optic_no_support for r in out] == [1, 0, 0]


def test_labels_profile_and_bands(spark):
    df = spark.createDataFrame([(50.0,), (45.0,), (36.0,), (25.0,), (15.01,), (15.0,)], "r double")
    assert [x[0] for x in df.select(C.label_from_rate("r")).collect()] == [
        "Very High Risk", "High Risk", "High Risk", "Medium Risk", "Medium Risk", "Low Risk"]
    p = spark.createDataFrame([(0.0,), (0.5,), (0.51,), (0.75,), (1.0,)], "p double")
    got = p.select(C.risk_band("p"), C.gauge_band("p")).collect()
    assert [tuple(r) for r in got] == [("Low Risk", "green"), ("Low Risk", "yellow"), ("High Risk", "yellow"),
                                       ("High Risk", "red"), ("High Risk", "red")]
    prof = spark.createDataFrame([("M", "E", "New", 0, "No", 0), ("M", "E", "New", 2, "DSL", 1)],
                                 "Contract string, PaymentMethod string, tenure_group string, support_count int, "
                                 "InternetService string, SeniorCitizen int")
    assert [r[0] for r in prof.select(C.describe_profile()).collect()] == [
        "M + E + New tenure + 0 support", "M + E + New tenure + 2 support + DSL + Senior"]


def test_risk_factors_in_rule_order(spark):
    df = spark.createDataFrame([("Month-to-month", 3, "No", "Electronic check"), ("Two year", 40, "Yes", "Mailed check")],
                               "Contract string, tenure int, TechSupport string, PaymentMethod string")
    got = [r[0] for r in df.select(C.risk_factors(C.reference_risk_factor_rules())).collect()]
    assert got == [K.RISK_FACTOR_TEXT, []]


def test_round_by_rule(spark):
    df = spark.createDataFrame([(12.3456, 0.123456, 1234.56, 5.4321, 3.14159)],
                               "churn_rate double, p_value double, total double, small double, chi2_stat double")
    r = C.round_table(df).first()
    assert (r.churn_rate, r.p_value, r.total, r.small, r.chi2_stat) == (12.35, 0.1235, 1234.6, 5.43, 3.14)
