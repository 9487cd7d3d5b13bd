"""Statistical tests in two phases: the data work (counts, sums, running
counts over distinct values) is distributed Spark aggregation; the test
statistic and its p-value are expressions over the few aggregated rows
(``functions.pvalues`` evaluates tails on the executors via commons-math).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import pvalues as P
from ..functions.exact import with_exact_p
from ..session import saved
from .combine import one_row
from .rates import bivariate_cells, is_positive
from .ranking import exact_quantiles, running_sum


# --- contingency tables -----------------------------------------------------------
def chi2_table(cells: DataFrame, group: Sequence[str], a: str, b: str, n: str = "n", yates: bool = True) -> DataFrame:
    """Pearson chi-square of each group's a x b table with scipy's default
    continuity correction (Yates, only when dof == 1). Returns per group:
    chi2, dof, n_total, k = min(rows, cols), cramers_v, p_value.

    Only observed cells and the two margins are used (chi2 = n sum(O^2 /
    (r c)) - n), so the size of the domains doesn't matter; in a 2 x 2
    table every cell has the same deviation, and the sum of 1 / E follows
    from the margins."""
    g = list(group)
    cells = cells.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    o = F.col(n).cast("double")

    def margin(col: str, m: str) -> DataFrame:
        return cells.groupBy(*g, col).agg(F.sum(o).alias(m))

    rows, cols = margin(a, "_r"), margin(b, "_c")
    seen = cells.join(rows, [*g, a]).join(cols, [*g, b]).groupBy(*g).agg(
        F.sum(o * o / (F.col("_r") * F.col("_c"))).alias("_s"),
        F.max(F.struct(o.alias("o"), F.col("_r").alias("r"), F.col("_c").alias("c"))).alias("_cell"),
    )
    by_row = rows.groupBy(*g).agg(F.sum("_r").alias("_t"), F.count(F.lit(1)).alias("_nr"), F.sum(1 / F.col("_r")).alias("_ir"))
    by_col = cols.groupBy(*g).agg(F.count(F.lit(1)).alias("_nc"), F.sum(1 / F.col("_c")).alias("_ic"))
    m = seen.join(by_row, g).join(by_col, g) if g else one_row(seen, by_row, by_col)
    t = F.col("_t")
    dof = (F.col("_nr") - 1) * (F.col("_nc") - 1)
    dev = F.abs(F.col("_cell.o") - F.col("_cell.r") * F.col("_cell.c") / t) - F.lit(0.5 if yates else 0.0)
    dev = F.greatest(dev, F.lit(0.0))
    chi2 = F.when(dof == 1, dev * dev * t * F.col("_ir") * F.col("_ic")).otherwise(F.greatest(t * F.col("_s") - t, F.lit(0.0)))
    stat = m.select(*g, chi2.alias("chi2"), dof.cast("long").alias("dof"), t.cast("long").alias("n_total"), F.least("_nr", "_nc").cast("int").alias("k"))
    return stat.select(
        "*",
        # one category on a side: no association to measure, nothing to reject
        F.sqrt(F.try_divide(F.col("chi2"), F.col("n_total").cast("double") * (F.col("k") - 1))).alias("cramers_v"),
        F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(P.chi2_sf(F.col("chi2"), F.col("dof"))).alias("p_value"),
    )


def bivariate_table(df: DataFrame, label: str, pairs, positive="Yes", with_p: bool = True) -> DataFrame:
    """Per pair: every cell's churn rate and size, plus the pair's chi2
    (a x b counts), p-value and Cramer's V repeated on each row."""
    cells = saved(bivariate_cells(df, label, pairs, positive), "stats", "cells")  # read by every sum of the table
    stats = chi2_table(
        cells.select("Feature_1", "Feature_2", "Category_1", "Category_2", F.col("Sample_Size").alias("n")),
        ["Feature_1", "Feature_2"], "Category_1", "Category_2",
    )
    cols = [
        "Feature_1", "Feature_2", "Category_1", "Category_2", "Churn_Rate", "Sample_Size",
        F.col("chi2").alias("Chi2_Statistic"), "dof", F.col("cramers_v").alias("Cramers_V"),
    ]
    if with_p:
        cols += [
            F.col("p_value").alias("P_Value"),
            F.when(F.col("p_value") < K.SIGNIFICANCE, "Yes").otherwise("No").alias("Significant"),
        ]
    return cells.join(stats, ["Feature_1", "Feature_2"]).select(*cols)


def label_association(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """chi2 / p / Cramer's V of each column against the label, all columns
    in one scan (unpivot + one groupBy)."""
    arr = F.array(*[F.struct(F.lit(c).alias("Feature"), F.col(c).cast("string").alias("Category")) for c in cols])
    cells = (
        df.select(F.col(label).cast("string").alias("_y"), F.inline(arr))
        .where(F.col("Category").isNotNull() & F.col("_y").isNotNull())
        .groupBy("Feature", "Category", "_y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return chi2_table(saved(cells, "stats", "cells"), ["Feature"], "Category", "_y")


# --- two-group comparisons -------------------------------------------------------
def pooled_t(n1, m1, v1, n2, m2, v2) -> F.Column:
    sp2 = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    return (m1 - m2) / F.sqrt(sp2 * (1.0 / n1 + 1.0 / n2))


def two_group_t(df: DataFrame, y: F.Column, in_a: F.Column, in_b: F.Column) -> DataFrame:
    """Pooled-variance t of y between groups a and b (one aggregate)."""
    a = df.agg(
        F.count(F.when(in_a, 1)).alias("n1"), F.avg(F.when(in_a, y)).alias("m1"), F.var_samp(F.when(in_a, y)).alias("v1"),
        F.count(F.when(in_b, 1)).alias("n2"), F.avg(F.when(in_b, y)).alias("m2"), F.var_samp(F.when(in_b, y)).alias("v2"),
    )
    t = pooled_t(*[F.col(c) for c in ["n1", "m1", "v1", "n2", "m2", "v2"]])
    return a.select("*", t.alias("t"), (F.col("n1") + F.col("n2") - 2).alias("dof"))


def two_by_two(df: DataFrame, y: F.Column, in_a: F.Column) -> DataFrame:
    """2x2 table of (in_a, y) as cells, for ``chi2_table``."""
    return df.groupBy(in_a.cast("string").alias("g"), y.cast("string").alias("y")).agg(F.count(F.lit(1)).alias("n"))


def hypotheses(
    df: DataFrame,
    label: str = "Churn",
    positive="Yes",
    contract: str = "Contract",
    short_contract: str = "Month-to-month",
    monthly: str = "MonthlyCharges",
    tenure: str = "tenure",
    support: str = "TechSupport",
    support_yes=("Yes",),
    support_no=("No", "No internet service"),
    with_p: bool = True,
) -> DataFrame:
    """H1 contract chi2, H2 charges t, H3 tenure t, H4 support chi2, as
    one tidy table: group rates (%), difference, statistic, p, verdict."""
    from .ranking import column_quantiles

    y = is_positive(label, positive)
    meds = column_quantiles(df, [monthly, tenure], [0.5])
    med_charge, med_tenure = meds[monthly][0], meds[tenure][0]

    def rates(in_a, in_b):
        return df.agg(F.avg(F.when(in_a, y)).alias("ra"), F.avg(F.when(in_b, y)).alias("rb"))

    c_in = F.col(contract) == short_contract
    s_in = F.col(support).isin(list(support_yes))
    parts = []
    h1 = chi2_table(two_by_two(df, y, c_in), [], "g", "y").select("chi2", "p_value")
    parts.append(
        one_row(rates(c_in, ~c_in), h1).select(
            F.lit(f"H1: {short_contract} contracts → Higher churn").alias("Hypothesis"),
            F.lit("chi2").alias("Test"), "ra", "rb", F.col("chi2").alias("Statistic"), "p_value",
        )
    )
    for name, col_, med, high_first in (
        ("H2: High MonthlyCharges → Higher churn", monthly, med_charge, True),
        ("H3: Low tenure → Higher churn", tenure, med_tenure, False),
    ):
        hi, lo = F.col(col_) > F.lit(med), F.col(col_) <= F.lit(med)
        a_in, b_in = (hi, lo) if high_first else (lo, hi)
        t = two_group_t(df, y, a_in, b_in)
        parts.append(
            t.select(
                F.lit(name).alias("Hypothesis"), F.lit("t").alias("Test"),
                F.col("m1").alias("ra"), F.col("m2").alias("rb"), F.col("t").alias("Statistic"),
                P.t_two_sided(F.col("t"), F.col("dof")).alias("p_value"),
            )
        )
    h4 = chi2_table(two_by_two(df, y, s_in), [], "g", "y").select("chi2", "p_value")
    parts.append(
        one_row(rates(F.col(support).isin(list(support_no)), s_in), h4).select(
            F.lit("H4: Missing support services → Higher churn").alias("Hypothesis"),
            F.lit("chi2").alias("Test"), "ra", "rb", F.col("chi2").alias("Statistic"), "p_value",
        )
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select(
        "Hypothesis", "Test",
        (F.col("ra") * 100).alias("Group_A_Rate"),
        (F.col("rb") * 100).alias("Group_B_Rate"),
        ((F.col("ra") - F.col("rb")) * 100).alias("Difference"),
        "Statistic",
        F.col("p_value").alias("P_Value"),
    )
    out = out.withColumn(
        "Result",
        F.when((F.col("P_Value") < K.SIGNIFICANCE) & (F.col("Difference") > 0), "Supported").otherwise("Not Supported"),
    )
    return out if with_p else out.drop("P_Value", "Result")


# --- rank statistics over distinct values -------------------------------------------
def label_value_counts(df: DataFrame, cols: Sequence[str], label: str, positive="Yes") -> DataFrame:
    """(Feature, x, c1, c0): rows per distinct value and label, all numeric
    columns in one unpivot + groupBy."""
    arr = F.array(*[F.struct(F.lit(c).alias("Feature"), F.col(c).cast("double").alias("x")) for c in cols])
    long = df.select(is_positive(label, positive).alias("_y"), F.col(label).isNotNull().alias("_has"), F.inline(arr))
    return (
        long.where(F.col("x").isNotNull() & F.col("_has"))
        .groupBy("Feature", "x")
        .agg(F.sum("_y").cast("long").alias("c1"), F.sum(1 - F.col("_y")).cast("long").alias("c0"))
    )


def rank_tests(df: DataFrame, cols: Sequence[str], label: str, positive="Yes", **ranking_kw) -> DataFrame:
    """Two-sample KS and Mann-Whitney U (of the positive group) per column.
    p-values are exact where sizes allow them (``exact.with_exact_p``), else
    those of the Kolmogorov limit and of the tie-corrected normal with
    continuity."""
    vc = saved(label_value_counts(df, cols, label, positive).withColumn("cnt", F.col("c1") + F.col("c0")), "stats", "values")  # read four times
    cum = running_sum(vc, "x", ["c1", "c0", "cnt"], by=["Feature"], **ranking_kw)
    tot = vc.groupBy("Feature").agg(F.sum("c1").alias("n1"), F.sum("c0").alias("n0"))
    j = cum.join(tot, "Feature")
    rank = F.col("cum_cnt") - (F.col("cnt") - 1) / 2.0
    agg = j.groupBy("Feature", "n1", "n0").agg(
        F.max(F.abs(F.try_divide(F.col("cum_c1"), F.col("n1")) - F.try_divide(F.col("cum_c0"), F.col("n0")))).alias("ks"),
        F.sum(F.col("c1") * rank).alias("r1"),
        F.sum(F.col("cnt").cast("double") ** 3 - F.col("cnt")).alias("ties"),
    )
    # doubles before products: n1 * n0 passes 64 bits at 3e9 rows; with one
    # label value only, the statistics are NULL
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    n = n1 + n0
    u1 = F.when((n1 > 0) & (n0 > 0), F.col("r1") - n1 * (n1 + 1) / 2.0)
    mu = n1 * n0 / 2.0
    sigma = F.sqrt(n1 * n0 / 12.0 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(F.abs(u1 - mu) - 0.5, sigma)
    en = F.try_divide(n1 * n0, n)
    return with_exact_p(agg.select(
        "Feature", "n1", "n0", "ties",
        F.col("ks").alias("KS_Statistic"),
        P.kolmogorov_sf(F.col("ks") * F.sqrt(en)).alias("KS_PValue"),
        u1.alias("MannWhitney_U"),
        F.least(P.normal_two_sided(z), F.lit(1.0)).alias("MannWhitney_PValue"),
    )).drop("ties")


def dist_by_label(df: DataFrame, cols: Sequence[str], label: str, positive="Yes", negative="No", with_p=True) -> DataFrame:
    """Means and quartiles per label value, KS and U tests, per column."""
    arr = F.array(*[F.struct(F.lit(c).alias("Feature"), F.col(c).cast("double").alias("x")) for c in cols])
    long = df.select(F.col(label).alias("_l"), F.inline(arr)).where(F.col("_l").isin(positive, negative))
    means = long.groupBy("Feature").agg(
        F.avg(F.when(F.col("_l") == positive, F.col("x"))).alias("Churn_Mean"),
        F.avg(F.when(F.col("_l") == negative, F.col("x"))).alias("No_Churn_Mean"),
    )
    q = exact_quantiles(long, "x", [0.25, 0.5, 0.75], by=["Feature", "_l"])
    qn = q.select(
        "Feature",
        F.concat(F.when(F.col("_l") == positive, "Churn_").otherwise("No_Churn_"),
                 F.when(F.col("q") == 0.25, "Q1").when(F.col("q") == 0.5, "Median").otherwise("Q3")).alias("k"),
        "value",
    )
    names = [f"{a}_{b}" for a in ("Churn", "No_Churn") for b in ("Median", "Q1", "Q3")]
    qw = qn.groupBy("Feature").pivot("k", names).agg(F.first("value"))
    tests = rank_tests(df, cols, label, positive)
    # left joins: a column without any value keeps its row
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "Feature string")
    out = every.join(means, "Feature", "left").join(qw, "Feature", "left").join(tests.drop("n1", "n0"), "Feature", "left")
    if with_p:
        out = out.withColumn("Significant_Difference", F.when(F.col("KS_PValue") < K.SIGNIFICANCE, "Yes").otherwise("No"))
    else:
        out = out.drop("KS_PValue", "MannWhitney_PValue")
    return out


# --- ANOVA F, mutual information, ranking ------------------------------------------------
def anova_f(df: DataFrame, cols: Sequence[str], label: str, positive="Yes") -> DataFrame:
    """One-way ANOVA F of each column across label classes (NULL -> 0, as
    the univariate scorer fills them), from per-class n, mean and centred
    sum of squares: F = (SSB/(k-1)) / (SSW/(n-k))."""
    arr = F.array(*[F.struct(F.lit(c).alias("Feature"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("x")) for c in cols])
    g = df.select(is_positive(label, positive).alias("_y"), F.inline(arr)).groupBy("Feature", "_y").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v")
    )
    each = F.struct("n", "m", "v")  # a row per class
    tot = g.groupBy("Feature").agg(F.collect_list(each).alias("c"), F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("k"))
    total = lambda f: F.aggregate("c", F.lit(0.0), lambda a, x: a + f(x))
    mean = total(lambda x: x["n"] / F.col("n_all") * x["m"])
    tot = tot.withColumn("mean", mean)
    ssb = total(lambda x: x["n"] * (x["m"] - F.col("mean")) * (x["m"] - F.col("mean")))
    ssw = total(lambda x: x["n"] * x["v"])
    f = F.try_divide(F.try_divide(ssb, F.col("k") - 1), F.try_divide(ssw, F.col("n_all") - F.col("k")))  # NULL for one class or no spread
    return tot.select(
        "Feature", f.alias("F_Statistic"),
        P.f_sf(f, F.col("k") - 1, F.col("n_all") - F.col("k")).alias("F_PValue"),
    )


K_NEAREST = 3  # neighbours of the mutual information estimate
NOISE = 1e-10  # of a column's scale, by which equal values are told apart
BLOCK_RANKS = 100_000  # rows of a block in which neighbours are sought


def mutual_info(df: DataFrame, cols: Sequence[str], label: str, positive="Yes", key: str | None = None, k: int = K_NEAREST) -> DataFrame:
    """Mutual information (nats) between each column (NULL -> 0) and the
    label by nearest neighbours: around each row reaches an interval up to
    its k-th nearest row of the same class (k - 1 rows of a smaller class);
    with m rows of any class inside, the estimate is the mean of
    psi(n) + psi(k) - psi(class size) - psi(m), at least 0. Classes of one
    row take no part.

    Equal values are told apart by noise of at most ``NOISE`` of the
    column's scale, drawn from md5 of (column, ``key``; all columns without
    a key). Ranks within classes come from ``running_sum``; blocks of
    consecutive ranks overlap by k rows, so neighbours are found across
    their borders; rows inside the intervals are counted by running sums
    over values and interval ends in one order."""
    arr = F.array(*[F.struct(F.lit(c).alias("Feature"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("v")) for c in cols])
    row = F.col(key).cast("string") if key else F.concat_ws("|", *[F.col(c).cast("string") for c in df.columns])
    long = df.select(is_positive(label, positive).alias("_y"), row.alias("_row"), F.inline(arr))
    scale = long.groupBy("Feature").agg(F.greatest(F.stddev_pop("v"), F.avg(F.abs("v"))).alias("s"))
    # a power of two, so that sums round alike everywhere
    scale = scale.select("Feature", F.when(F.col("s") > 0, F.pow(F.lit(2.0), F.floor(F.log2(F.col("s") * NOISE)))).otherwise(F.lit(2.0) ** -34).alias("amp"))
    digits = F.conv(F.substring(F.md5(F.concat("Feature", F.lit(":"), F.col("_row"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    x = (F.col("v") + F.col("amp") * digits).alias("x")
    points = long.join(F.broadcast(scale), "Feature").select("Feature", "_y", x, F.lit(1).cast("long").alias("one"))  # a row per column
    points = saved(points.withColumn("_tie", F.monotonically_increasing_id()), "stats", "points")
    ranked = running_sum(points, "x", ["one"], by=["Feature", "_y"], tiebreak=["_tie"], with_total=True)
    ranked = ranked.where("tot_one > 1").select("Feature", "_y", "x", (F.col("cum_one") - 1).alias("r"), F.col("tot_one").alias("n_y"), F.least(F.lit(k), F.col("tot_one") - 1).cast("int").alias("k"))
    block, inside = F.floor(F.col("r") / BLOCK_RANKS), F.pmod("r", F.lit(BLOCK_RANKS))
    homes = F.array_compact(F.array(block, F.when(inside < k, block - 1), F.when(inside >= BLOCK_RANKS - k, block + 1)))
    blocks = ranked.withColumn("home", block).withColumn("block", F.explode(homes))
    w = Window.partitionBy("Feature", "_y", "block").orderBy("r")
    near = [F.struct((F.col("x") - F.lag("x", j).over(w)).alias("d"), F.lag("x", j).over(w).alias("at"), F.lit(-1).alias("side")) for j in range(1, k + 1)]
    near += [F.struct((F.lead("x", j).over(w) - F.col("x")).alias("d"), F.lead("x", j).over(w).alias("at"), F.lit(1).alias("side")) for j in range(1, k + 1)]
    found = blocks.select("Feature", "_y", "x", "r", "k", "n_y", "home", "block", F.array(*near).alias("near")).where("home = block")
    kth = F.element_at(F.array_sort(F.filter("near", lambda s: s["d"].isNotNull())), F.col("k"))
    found = found.select("Feature", "_y", "x", "r", "k", "n_y", kth.alias("kth"))
    low = F.when(F.col("kth.side") < 0, F.col("kth.at")).otherwise(F.col("x") - F.col("kth.d"))
    high = F.when(F.col("kth.side") > 0, F.col("kth.at")).otherwise(F.col("x") + F.col("kth.d"))
    # rows with low < x < high; where the k-th is an equal value, those equal to it
    same = F.col("kth.d") == 0
    events = F.array(
        F.struct(F.col("x").alias("at"), F.lit(1).alias("kind"), F.lit(1).cast("long").alias("one"), F.lit(0).alias("sign")),
        F.struct(low.alias("at"), F.when(same, 0).otherwise(2).alias("kind"), F.lit(0).cast("long").alias("one"), F.lit(-1).alias("sign")),
        F.struct(high.alias("at"), F.when(same, 2).otherwise(0).alias("kind"), F.lit(0).cast("long").alias("one"), F.lit(1).alias("sign")))
    found = saved(found, "stats", "intervals")
    events = found.select("Feature", "_y", "r", "k", "n_y", F.inline(events))
    # an order column per kind would split equal places: ends come before or after points by the tiebreak
    counted = running_sum(events, "at", ["one"], by=["Feature"], tiebreak=["kind", "_y", "r"])
    inside_ = counted.where("sign <> 0").groupBy("Feature", "_y", "r", "k", "n_y").agg(F.sum(F.col("sign") * F.col("cum_one")).alias("m"))
    cells = inside_.groupBy("Feature", "n_y", "_y", "k", "m").agg(F.count(F.lit(1)).alias("c"))
    cells = cells.withColumn("psi", P.digamma("k") - P.digamma("n_y") - P.digamma("m"))
    whole = cells.groupBy("Feature").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("psi")).alias("t"))
    return whole.select("Feature", F.greatest(P.digamma("n") + F.col("t") / F.col("n"), F.lit(0.0)).alias("Mutual_Information"))


def importance_rank(df: DataFrame, numeric: Sequence[str], label: str, positive="Yes", key: str | None = None) -> DataFrame:
    """Numeric columns scored by MI (with ANOVA F and its p), text columns by
    Cramer's V (with chi2 and its p) against the label -- integer flags are
    skipped, as the reference does -- in one ranking."""
    text_cols = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in (label, key, *numeric)
    ]
    nul = F.lit(None).cast("double")
    num = (
        mutual_info(df, numeric, label, positive, key)
        .join(anova_f(df, numeric, label, positive), "Feature")
        .select(
            "Feature", F.lit("Numerical").alias("Type"), "Mutual_Information", "F_Statistic", "F_PValue",
            nul.alias("Chi2_Statistic"), nul.alias("Chi2_PValue"), nul.alias("Cramers_V"),
            F.col("Mutual_Information").alias("Importance_Score"),
        )
    )
    cat = label_association(df, label, text_cols).select(
        "Feature", F.lit("Categorical").alias("Type"), nul.alias("Mutual_Information"), nul.alias("F_Statistic"),
        nul.alias("F_PValue"), F.col("chi2").alias("Chi2_Statistic"), F.col("p_value").alias("Chi2_PValue"),
        F.col("cramers_v").alias("Cramers_V"), F.col("cramers_v").alias("Importance_Score"),
    )
    both = num.unionByName(cat)
    w = Window.orderBy(F.desc("Importance_Score"), "Feature")  # one row per column: bounded
    return both.select(F.row_number().over(w).alias("Rank"), "*")


# --- model comparisons ----------------------------------------------------------------------------------
def mcnemar(df: DataFrame, label: str, pred_cols: Sequence[str]) -> DataFrame:
    """Pairwise McNemar on paired 0/1 predictions: b = only model 1 right,
    c = only model 2 right; (|b-c|-1)^2/(b+c), dof 1; b+c = 0 gives 0, p 1.
    All pairs' counts in one aggregate."""
    y = F.col(label)
    aggs, pairs = [], []
    for i, a in enumerate(pred_cols):
        for b in pred_cols[i + 1:]:
            ra, rb = F.col(a) == y, F.col(b) == y
            aggs += [F.count_if(ra & ~rb).alias(f"{a}|{b}|b"), F.count_if(~ra & rb).alias(f"{a}|{b}|c")]
            pairs.append((a, b))
    wide = df.agg(*aggs)
    arr = F.array(
        *[F.struct(F.lit(a).alias("Model_1"), F.lit(b).alias("Model_2"),
                   F.col(f"`{a}|{b}|b`").alias("b"), F.col(f"`{a}|{b}|c`").alias("c")) for a, b in pairs]
    )
    long = wide.select(F.inline(arr))
    s = F.col("b") + F.col("c")
    stat = F.when(s > 0, (F.abs(F.col("b") - F.col("c")) - 1).cast("double") ** 2 / s).otherwise(F.lit(0.0))
    return long.select(
        "Model_1", "Model_2", F.lit("McNemar").alias("Test_Type"), stat.alias("Statistic"),
        F.when(s > 0, P.chi2_sf(stat, F.lit(1))).otherwise(F.lit(1.0)).alias("P_Value"),
        F.col("b").alias("Model1_Correct_Only"), F.col("c").alias("Model2_Correct_Only"),
    ).withColumn("Significant", F.when(F.col("P_Value") < K.SIGNIFICANCE, "Yes").otherwise("No"))


def paired_t(fold_scores: DataFrame, model_col: str, fold_col: str, score_col: str, models: Sequence[str]) -> DataFrame:
    """Paired t on per-fold scores of each model pair (k folds, k-1 dof)."""
    wide = fold_scores.groupBy(fold_col).pivot(model_col, list(models)).agg(F.first(score_col))
    parts = []
    for i, a in enumerate(models):
        for b in models[i + 1:]:
            d = F.col(f"`{a}`") - F.col(f"`{b}`")
            parts.append(
                wide.agg(F.avg(d).alias("md"), F.stddev_samp(d).alias("sd"), F.count(d).alias("k")).select(
                    F.lit(a).alias("Model_1"), F.lit(b).alias("Model_2"), F.lit("Paired_t").alias("Test_Type"),
                    "md", "sd", "k",
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    t = F.try_divide(F.col("md"), F.col("sd") / F.sqrt(F.col("k")))  # no spread: no statistic
    return out.select(
        "Model_1", "Model_2", "Test_Type", F.col("md").alias("Mean_Difference"), t.alias("Statistic"),
        (F.col("k") - 1).alias("dof"), P.t_two_sided(t, F.col("k") - 1).alias("P_Value"),
    )
