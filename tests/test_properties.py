"""Property tests: exact quantiles equal pandas, and the ranking core's
bucketed path equals its single-task path, on generated data."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from attrix.operators.ranking import scalar_quantiles
from attrix.operators.stats import hypotheses


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.sampled_from([0.0, 0.1, 0.25, 0.5, 2 / 3, 0.9, 1.0]))
def test_quantile_property(spark, xs, q):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    expected = float(pd.Series(xs, dtype=float).quantile(q))
    assert np.isclose(scalar_quantiles(df, "x", [q])[0], expected)
    assert np.isclose(scalar_quantiles(df, "x", [q], buckets=20)[0], expected)


def test_hypotheses_verdicts(spark):
    rows = ([("Month-to-month", 10.0, 1, "No", "Yes")] * 60 + [("Month-to-month", 90.0, 5, "No", "No")] * 20
            + [("Two year", 50.0, 60, "Yes", "No")] * 80 + [("Two year", 95.0, 70, "Yes", "No")] * 40)
    df = spark.createDataFrame(rows, "Contract string, MonthlyCharges double, tenure int, TechSupport string, Churn string")
    out = {r.Hypothesis[:2]: r for r in hypotheses(df).collect()}
    h1 = out["H1"]
    assert h1.Group_A_Rate == 75.0 and h1.Group_B_Rate == 0.0
    assert h1.P_Value < 1e-6 and h1.Result == "Supported"
    h3 = out["H3"]  # low tenure churns more
    assert h3.Difference > 0 and h3.Result == "Supported"
    h4 = out["H4"]  # no support churns more
    assert h4.Group_A_Rate > h4.Group_B_Rate and h4.Result == "Supported"
    assert all(0.0 <= r.P_Value <= 1.0 for r in out.values())
