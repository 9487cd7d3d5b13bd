"""Grouped attrition rates.

The reference filters the table once per (feature, category) cell. Here a
family of tables is one scan: the categorical columns are unpivoted into
(Feature, Category) pairs with ``inline`` and aggregated by one
``groupBy`` -- partial aggregation map-side, one shuffle of at most
(#features x #categories) rows per task. Rows per key never meet in one
task, so a category holding a third of all rows costs nothing extra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import (
    bin_fixed,
    count_equal,
    describe_profile,
    label_from_rate,
    linspace,
)


def is_positive(label: str, positive="Yes") -> F.Column:
    return F.coalesce(F.col(label) == F.lit(positive), F.lit(False)).cast("int")


def unpivot_categories(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., Feature, Category) rows, one per input row and column;
    categories become strings (NULL stays NULL)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("Feature"), F.col(c).cast("string").alias("Category")) for c in cols])
    return df.select(*keep, F.inline(pairs))


def cat_dist(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value counts and share of *all* rows (NULLs in the denominator),
    per column and category. The window runs over the small cell table."""
    counts = unpivot_categories(df, cols).groupBy("Feature", "Category").agg(F.count(F.lit(1)).alias("Count"))
    n = F.sum("Count").over(Window.partitionBy("Feature"))
    return counts.select(
        "Feature", "Category", "Count", F.round(F.col("Count") * 100.0 / n, 2).alias("Percentage")
    ).where(F.col("Category").isNotNull())


def rate_by_category(df: DataFrame, label: str, cols: Sequence[str], positive="Yes") -> DataFrame:
    """Per feature and category: Total_Count, Churn_Count and
    Churn_Rate_Percentage (2 dp); feature ascending, rate descending."""
    cells = unpivot_categories(df.withColumn("_y", is_positive(label, positive)), cols, keep=["_y"])
    agg = (
        cells.where(F.col("Category").isNotNull())
        .groupBy("Feature", "Category")
        .agg(F.count(F.lit(1)).alias("Total_Count"), F.sum("_y").alias("Churn_Count"))
    )
    return agg.select(
        "Feature", "Category", "Total_Count", "Churn_Count",
        F.round(F.col("Churn_Count") * 100.0 / F.col("Total_Count"), 2).alias("Churn_Rate_Percentage"),
    ).orderBy("Feature", F.desc("Churn_Rate_Percentage"), "Category")


def rate_pivot(rates: DataFrame) -> DataFrame:
    """Rate table of every feature, rate descending within each."""
    return rates.select(
        "Feature",
        "Category",
        F.col("Churn_Rate_Percentage").alias("Churn Rate (%)"),
        F.col("Total_Count").alias("Total Count"),
        F.col("Churn_Count").alias("Churn Count"),
    ).orderBy("Feature", F.desc("Churn Rate (%)"), "Category")


def top_drivers(rates: DataFrame, n: int = 10) -> DataFrame:
    """The n highest category rates (ties broken by feature, category)."""
    return rates.orderBy(F.desc("Churn_Rate_Percentage"), "Feature", "Category").limit(n)


def key_feature_rates(rates: DataFrame, features: Sequence[str] = K.KEY_FEATURES) -> DataFrame:
    return rates.where(F.col("Feature").isin(list(features))).orderBy(
        "Feature", F.desc("Churn_Rate_Percentage"), "Category"
    )


def target_dist(df: DataFrame, label: str) -> DataFrame:
    """Count and percentage per label value (most frequent first)."""
    counts = df.groupBy(F.col(label).alias("Churn_Status")).agg(F.count(F.lit(1)).alias("Count"))
    total = F.sum("Count").over(Window.partitionBy())  # one row per label value
    return counts.select(
        "Churn_Status", "Count", F.round(F.col("Count") * 100.0 / total, 2).alias("Percentage")
    ).orderBy(F.desc("Count"), "Churn_Status")


def business_summary(df: DataFrame, label: str, monthly: str, total: str, positive="Yes") -> DataFrame:
    y = is_positive(label, positive)
    return df.agg(
        F.round(F.avg(monthly), 2).alias("avg_monthly"),
        F.round(F.avg(total), 2).alias("avg_total"),
        F.count(F.lit(1)).alias("customers"),
        F.sum(y).alias("churners"),
        F.round(F.sum(y) * 100.0 / F.count(F.lit(1)), 2).alias("churn_rate"),
    )


def revenue_at_risk(df: DataFrame, label: str, monthly: str, total: str, positive="Yes") -> DataFrame:
    """Monthly and lifetime revenue of the customers who left."""
    pos = F.col(label) == F.lit(positive)
    return df.agg(
        F.round(F.sum(F.when(pos, F.col(monthly))), 2).alias("monthly_revenue_at_risk"),
        F.round(F.sum(F.when(pos, F.col(total))), 2).alias("lifetime_value_lost"),
        F.round(F.sum(F.when(pos, F.col(monthly))) * 100.0 / F.sum(monthly), 2).alias("revenue_share_pct"),
    )


# --- interactions, profiles, bivariate ------------------------------------
def charge_terciles(df: DataFrame, col: str, labels=K.CHARGE_TERCILE_LABELS) -> tuple[list[float], list[str]]:
    """``pd.qcut(q=3, duplicates='drop')`` edges from exact quantiles; the
    lowest edge is included (qcut's include_lowest)."""
    from .ranking import scalar_quantiles

    qs = scalar_quantiles(df, col, [0.0, 1 / 3, 2 / 3, 1.0])
    edges = []
    for q in qs:
        if q is not None and (not edges or q > edges[-1]):
            edges.append(q)
    if len(edges) - 1 != len(labels):
        labels = [f"bin{i}" for i in range(len(edges) - 1)]
    return edges, list(labels)


def bin_including_lowest(c: str, edges, labels) -> F.Column:
    expr = bin_fixed(c, edges, labels)
    return F.when(F.col(c) == F.lit(edges[0]), F.lit(labels[0])).otherwise(expr)


def interactions(
    df: DataFrame,
    label: str,
    pairs: Sequence[tuple[str, str, str]],
    positive="Yes",
) -> DataFrame:
    """For each named pair (name, col1, col2): Sample_Size, Churn_Rate,
    Churn_Count of every non-empty (col1, col2) cell; rate descending.
    All pairs in one scan: ``inline`` of (Interaction, c1, c2) structs."""
    pairs_arr = F.array(
        *[
            F.struct(
                F.lit(name).alias("Interaction"),
                F.col(a).cast("string").alias("Category_1"),
                F.col(b).cast("string").alias("Category_2"),
            )
            for name, a, b in pairs
        ]
    )
    cells = df.select(is_positive(label, positive).alias("_y"), F.inline(pairs_arr))
    agg = (
        cells.where(F.col("Category_1").isNotNull() & F.col("Category_2").isNotNull())
        .groupBy("Interaction", "Category_1", "Category_2")
        .agg(F.count(F.lit(1)).alias("Sample_Size"), F.sum("_y").alias("Churn_Count"))
    )
    return agg.select(
        "Interaction", "Category_1", "Category_2", "Sample_Size",
        F.round(F.col("Churn_Count") * 100.0 / F.col("Sample_Size"), 2).alias("Churn_Rate"),
        "Churn_Count",
    ).orderBy(F.desc("Churn_Rate"), "Interaction", "Category_1", "Category_2")


def interaction_frame(
    df: DataFrame,
    contract="Contract",
    tenure="tenure",
    payment="PaymentMethod",
    senior="SeniorCitizen",
    monthly="MonthlyCharges",
    internet="InternetService",
    support_cols=K.SUPPORT_SERVICES,
    tenure_edges=K.TENURE_EDGES_EDA,
    tenure_labels=K.TENURE_LABELS_EDA,
) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """The reference's four interaction pairs over derived columns:
    tenure groups, charge terciles, senior label, support count."""
    edges, labels = charge_terciles(df, monthly)
    d = df.select(
        F.col(contract).alias("_contract"),
        F.col(payment).alias("_payment"),
        F.col(internet).alias("_internet"),
        bin_fixed(tenure, tenure_edges, tenure_labels).alias("_tenure_group"),
        bin_including_lowest(monthly, edges, labels).alias("_charge_group"),
        F.when(F.col(senior) == 1, "Senior").when(F.col(senior) == 0, "Non-Senior").alias("_senior"),
        F.concat(count_equal(support_cols).cast("string"), F.lit(" services")).alias("_support"),
        "*",
    )
    names = K.INTERACTION_NAMES
    return d, [
        (names[0], "_contract", "_tenure_group"),
        (names[1], "_payment", "_contract"),
        (names[2], "_senior", "_charge_group"),
        (names[3], "_internet", "_support"),
    ]


def interactions_pivot(inter: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Category_1 x Category_2 rate matrix of one interaction."""
    one = inter.where(F.col("Interaction") == name)
    return one.groupBy("Category_1").pivot("Category_2", list(columns) if columns else None).agg(
        F.avg("Churn_Rate")
    ).orderBy("Category_1")


def risky_profiles(
    df: DataFrame,
    label: str,
    keys: Sequence[str] = K.PROFILE_KEYS,
    top_n: int = 20,
    positive="Yes",
    no_internet_value: str = "No",
) -> DataFrame:
    """Group by the profile keys; rate, level, description; the ``top_n``
    highest rates (ties by keys), ranked. ``df`` must carry tenure_group
    and support_count (see ``profile_frame``)."""
    agg = (
        df.where(F.greatest(*[F.col(k).isNull() for k in keys]) == F.lit(False))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("Total_Customers"), F.sum(is_positive(label, positive)).alias("Churn_Count"))
    )
    rate = F.col("Churn_Count") * 100.0 / F.col("Total_Customers")
    with_rate = agg.select("*", rate.alias("_rate"))
    top = with_rate.orderBy(F.desc("_rate"), *keys).limit(top_n)
    # rank over the <= top_n rows that survive (bounded, one task)
    w = Window.orderBy(F.desc("_rate"), *keys)
    c, p, tg, sc, net, sen = keys
    return top.select(
        F.row_number().over(w).alias("Rank"),
        describe_profile(c, p, tg, sc, net, sen, no_internet_value).alias("Profile"),
        F.col(c).alias("Contract"),
        F.col(p).alias("PaymentMethod"),
        F.col(tg).alias("Tenure_Group"),
        F.col(sc).cast("int").alias("Support_Count"),
        F.col(net).alias("InternetService"),
        F.col(sen).alias("SeniorCitizen"),
        "Total_Customers",
        "Churn_Count",
        F.round("_rate", 2).alias("Churn_Rate"),
        label_from_rate(F.col("_rate")).alias("Risk_Level"),
    )


def profile_frame(
    df: DataFrame,
    tenure="tenure",
    support_cols=K.SUPPORT_SERVICES,
    tenure_edges=K.TENURE_EDGES_EDA,
    tenure_labels=K.TENURE_LABELS_PROFILE,
) -> DataFrame:
    return df.select(
        "*",
        bin_fixed(tenure, tenure_edges, tenure_labels).alias("tenure_group"),
        count_equal(support_cols).alias("support_count"),
    )


def nonlinear_bins(df: DataFrame, label: str, cols: Sequence[str], n_edges: int = 10, positive="Yes") -> DataFrame:
    """Equal-width binning per numeric column: ``n_edges`` linspace edges
    between min and max, right-closed bins, the minimum itself falls out
    (no include_lowest). Every bin is reported; empty bins have NULL
    rate and centre. Min/max are fitted with one aggregate; all columns are
    then binned in one unpivoted scan and one groupBy."""
    ext = df.agg(*[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    spark = df.sparkSession
    # a column without any value keeps its bins, without edges
    edges = {
        c: linspace(float(ext[f"lo_{i}"]), float(ext[f"hi_{i}"]), n_edges) if ext[f"lo_{i}"] is not None else [None] * n_edges
        for i, c in enumerate(cols)
    }
    # one row per (column, bin): the output grid, size-bounded
    grid = spark.createDataFrame(
        [(c, b, e[b], e[b + 1]) for c, e in edges.items() for b in range(n_edges - 1)],
        "Feature string, bin int, Bin_Low double, Bin_High double",
    )
    bounds = spark.createDataFrame(
        [(c, e) for c, e in edges.items()], "Feature string, e array<double>"
    )  # one row per column
    arr = F.array(*[F.struct(F.lit(c).alias("Feature"), F.col(c).cast("double").alias("x")) for c in edges])
    long = df.select(is_positive(label, positive).alias("_y"), F.inline(arr)).where(F.col("x").isNotNull())
    e = F.col("e")
    inside = (F.col("x") > e[0]) & (F.col("x") <= e[n_edges - 1])
    bin_ix = sum((F.col("x") > e[i]).cast("int") for i in range(1, n_edges - 1))
    stats = (
        long.join(F.broadcast(bounds), "Feature")
        .where(inside)
        .groupBy("Feature", bin_ix.alias("bin"))
        .agg(F.avg("x").alias("Bin_Center"), F.avg("_y").alias("_r"))
    )
    return grid.join(stats, ["Feature", "bin"], "left").select(
        "Feature", "bin", "Bin_Low", "Bin_High", "Bin_Center", (F.col("_r") * 100).alias("Churn_Rate"),
    )


def bivariate_cells(df: DataFrame, label: str, pairs: Sequence[tuple[str, str]], positive="Yes") -> DataFrame:
    """Every (Category_1, Category_2) cell of each pair's full cross
    product of observed values -- empty cells included with size 0 and
    NULL rate -- with the churn rate (%) and size. The cross product is of
    *domains* (distinct values, a few rows each), never of rows."""
    arr = F.array(
        *[
            F.struct(
                F.lit(a).alias("Feature_1"), F.lit(b).alias("Feature_2"),
                F.col(a).cast("string").alias("Category_1"), F.col(b).cast("string").alias("Category_2"),
            )
            for a, b in pairs
        ]
    )
    cells = (
        df.select(is_positive(label, positive).alias("_y"), F.inline(arr))
        .where(F.col("Category_1").isNotNull() & F.col("Category_2").isNotNull())
        .groupBy("Feature_1", "Feature_2", "Category_1", "Category_2")
        .agg(F.count(F.lit(1)).alias("Sample_Size"), F.sum("_y").alias("_pos"))
    )
    # domains from the (small) cell table, not from the rows
    d1 = cells.select("Feature_1", "Feature_2", "Category_1").distinct()
    d2 = cells.select("Feature_1", "Feature_2", "Category_2").distinct()
    grid = d1.join(d2, ["Feature_1", "Feature_2"])
    full = grid.join(cells, ["Feature_1", "Feature_2", "Category_1", "Category_2"], "left")
    return full.select(
        "Feature_1", "Feature_2", "Category_1", "Category_2",
        (F.col("_pos") * 100.0 / F.col("Sample_Size")).alias("Churn_Rate"),
        F.coalesce(F.col("Sample_Size"), F.lit(0)).alias("Sample_Size"),
    )
