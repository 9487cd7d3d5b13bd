"""The exploratory analysis of any customer table as one function returning
lazy DataFrames, its tidy summary table, and its contents in long form."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..operators import profile as PR
from ..operators import rates as R
from ..operators import stats as ST
from ..sources import snapshot as S


def eda_summary(df: DataFrame, label: str, total: str) -> DataFrame:
    """Shape, duplicates, class counts and shares, imbalance ratio, blank
    totals, in one aggregate."""
    digest = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    facts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(digest).alias("different"),
        F.count_if(F.col(label) == "No").alias("no"),
        F.count_if(F.col(label) == "Yes").alias("yes"),
        F.count_if(F.col(total) == " ").alias("blank"),
    ).first()
    n, no, yes = facts["n"], facts["no"], facts["yes"]
    dup = n - facts["different"]
    rows = [
        ("rows", float(n)), ("columns", float(len(df.columns))), ("duplicate_rows", float(dup)),
        ("count_No", float(no)), ("count_Yes", float(yes)),
        ("pct_No", no * 100.0 / n if n else None), ("pct_Yes", yes * 100.0 / n if n else None),
        ("imbalance_ratio", min(no, yes) * 1.0 / max(no, yes) if max(no, yes) else None),
        ("blank_" + total, float(facts["blank"])),
    ]
    out = df.sparkSession.createDataFrame(rows, "Metric string, Value double")
    return out.select(
        "Metric",
        F.when(F.col("Metric").startswith("pct_"), F.round("Value", 2))
        .when(F.col("Metric") == "imbalance_ratio", F.round("Value", 3))
        .otherwise(F.col("Value")).alias("Value"),
    )


@dataclass
class EdaColumns:
    """What the exploration needs to know of a customer table; the defaults
    are those of the reference's file."""

    numeric: Sequence[str] = ("tenure", "MonthlyCharges", "TotalCharges")
    categorical: Sequence[str] | None = None  # every other column, if None
    label: str = "Churn"
    key: str = "customerID"
    total: str = "TotalCharges"
    monthly: str = "MonthlyCharges"
    short_contract: str = "Month-to-month"
    support_no: Sequence[str] = ("No", "No internet service")


SNAPSHOT = EdaColumns(categorical=tuple(S.CATEGORICAL_COLUMNS), short_contract="MACHINERY", support_no=("No",))


def run_eda(raw: DataFrame, columns: EdaColumns | None = None) -> dict[str, DataFrame]:
    """All exploratory tables of a raw customer table, lazily."""
    c = columns or EdaColumns()
    nums, label = list(c.numeric), c.label
    cats = list(c.categorical) if c.categorical is not None else [x for x in raw.columns if x not in (*nums, label, c.key)]
    eda = raw.withColumn(c.total, C.to_number(c.total))
    rates = R.rate_by_category(eda, label, cats)
    inter_df, pairs = R.interaction_frame(eda)
    inter = R.interactions(inter_df, label, pairs)
    biv = eda.withColumn("tenure_group", C.bin_fixed("tenure", K.TENURE_EDGES_EDA, K.TENURE_LABELS_EDA))
    return {
        "overview": PR.overview(raw),
        "missing": PR.missing_report(eda),
        "types": PR.types_report(raw),
        "churn_distribution": R.target_dist(raw, label),
        "numerical_stats": PR.describe(eda, nums),
        "outliers": PR.outliers_iqr(eda, nums),
        "correlations": PR.corr_matrix(eda.withColumn("Churn01", (F.col(label) == "Yes").cast("int")), [*nums, "Churn01"]),
        "categorical_distributions": R.cat_dist(eda, cats),
        "churn_rates": rates,
        "hypotheses": ST.hypotheses(eda, label, short_contract=c.short_contract, support_no=tuple(c.support_no)),
        "distribution_comparison": ST.dist_by_label(eda, nums, label),
        "feature_interactions": inter,
        "interaction_matrix": R.interactions_pivot(inter, K.INTERACTION_NAMES[0], K.TENURE_LABELS_EDA),
        "riskiest_profiles": R.risky_profiles(R.profile_frame(eda), label),
        "bivariate_analysis": ST.bivariate_table(biv, label, K.BIVARIATE_PAIRS),
        "nonlinear_relationships": R.nonlinear_bins(eda, label, nums),
        "preliminary_importance": ST.importance_rank(eda, nums, label, key=c.key),
        "summary": eda_summary(raw, label, c.total),
        "top_drivers": R.top_drivers(rates, 10),
        "key_feature_rates": R.key_feature_rates(rates),
        "business_summary": R.business_summary(eda, label, c.monthly, c.total),
        "revenue_at_risk": R.revenue_at_risk(eda, label, c.monthly, c.total),
    }


def long_form(name: str, df: DataFrame, numbers: Sequence[str], keys: Sequence[str], digits: int = 4) -> DataFrame:
    """(table, row, column, value) of one result table: ``keys`` name the
    row, every column of ``numbers`` is a value."""
    row = F.concat_ws(" | ", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.round(F.col(f"`{c}`").cast("double"), digits).alias("value")) for c in numbers])
    return df.select(F.lit(name).alias("table"), row.alias("row"), F.inline(values))
