"""Table profiling: overview, missing values, types, blanks, numeric
description, IQR outliers, correlations.

Per-column statistics are computed over an unpivoted (Feature, value)
frame grouped by Feature, so N columns cost one scan and one shuffle, not
N passes over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import round_by_rule
from .ranking import exact_quantiles


def numeric_long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("Feature"), F.col(c).cast("double").alias("x")) for c in cols])
    return df.select(*keep, F.inline(arr))


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, duplicate rows (all columns), missing cells. Rows are
    compared by 128-bit digests, so that no whole row is shuffled."""
    digest = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    facts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(digest).alias("different"),
        F.sum(sum(F.col(f"`{c}`").isNull().cast("long") for c in df.columns)).alias("nulls"),
    ).first()
    return df.sparkSession.createDataFrame(
        [("Total Rows", facts["n"]), ("Total Columns", len(df.columns)), ("Duplicate Rows", facts["n"] - facts["different"]),
         ("Missing Values (Total)", int(facts["nulls"] or 0))],
        "Metric string, Value long",
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with NULLs: count and % of rows, most missing first."""
    counts = df.select(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    stack = F.array(*[F.struct(F.lit(c).alias("Column"), F.col(c).alias("Missing_Count")) for c in df.columns])
    long = counts.select("_n", F.inline(stack))
    return long.where(F.col("Missing_Count") > 0).select(
        "Column", "Missing_Count", F.round(F.col("Missing_Count") * 100.0 / F.col("_n"), 2).alias("Missing_Percentage")
    ).orderBy(F.desc("Missing_Count"), "Column")


def blank_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count of single-space blanks per text column."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    agg = df.select(*[F.count_if(F.col(c) == " ").alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("Column"), F.col(c).alias("Blank_Count")) for c in cols])
    return agg.select(F.inline(arr))


def types_report(df: DataFrame, sample: int = 3) -> DataFrame:
    """Per column: type, distinct count and its ``sample`` smallest values,
    both from the distinct (column, value) pairs of one unpivoted pass.
    Every task keeps a column's smallest values only, so none is gathered."""
    fields = df.schema.fields
    numeric = {f.name for f in fields if isinstance(f.dataType, T.NumericType)}
    arr = F.array(*[F.struct(
        F.lit(f.name).alias("Column"), F.col(f"`{f.name}`").cast("string").alias("v"),
        (F.col(f"`{f.name}`").cast("double") if f.name in numeric else F.lit(None).cast("double")).alias("x")) for f in fields])
    pairs = df.select(F.inline(arr)).where(F.col("v").isNotNull()).distinct()
    counts = pairs.groupBy("Column").agg(F.count(F.lit(1)).alias("Unique_Values"))
    nth = F.row_number().over(Window.partitionBy("Column").orderBy(F.col("x").asc_nulls_first(), "v"))
    least = pairs.withColumn("nth", nth).where(F.col("nth") <= sample).groupBy("Column").agg(F.array_sort(F.collect_list(F.struct("nth", "v"))).alias("s"))
    least = least.select("Column", F.array_join(F.col("s.v"), ", ").alias("Sample_Values"))
    info = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in fields], "Column string, Data_Type string")
    # left: a column without any value keeps its row
    unique = F.coalesce("Unique_Values", F.lit(0)).cast("long").alias("Unique_Values")
    return info.join(counts, "Column", "left").join(least, "Column", "left").select("Column", "Data_Type", unique, "Sample_Values")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75% (exact, linear), max per
    column; long form, rounded by the table rule."""
    long = numeric_long(df, cols)
    base = long.groupBy("Feature").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )
    q = exact_quantiles(long, "x", [0.25, 0.5, 0.75], by=["Feature"])
    qw = q.groupBy("Feature").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
    qw = qw.select("Feature", *[F.col(f"`{p}`").alias(n) for p, n in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]])
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "Feature string")  # also those without any value
    out = every.join(base, "Feature", "left").join(qw, "Feature", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    stat_cols = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return out.select("Feature", F.col("count").cast("double").alias("count"), *[round_by_rule(c).alias(c) for c in stat_cols])


def outliers_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Bounds Q1 - k IQR, Q3 + k IQR; strictly outside counts; share of
    all rows (NULLs included in the denominator)."""
    long = numeric_long(df, cols)
    q = exact_quantiles(long, "x", [0.25, 0.75], by=["Feature"])
    qw = q.groupBy("Feature").pivot("q", [0.25, 0.75]).agg(F.first("value"))
    qw = qw.select("Feature", F.col("`0.25`").alias("q1"), F.col("`0.75`").alias("q3"))
    bounds = qw.select(
        "Feature",
        (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("Lower_Bound"),
        (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("Upper_Bound"),
    )
    # a row per column, also for those without any value
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "Feature string").join(bounds, "Feature", "left")
    counted = long.join(F.broadcast(every), "Feature").groupBy("Feature", "Lower_Bound", "Upper_Bound").agg(
        F.count_if((F.col("x") < F.col("Lower_Bound")) | (F.col("x") > F.col("Upper_Bound"))).alias("Outlier_Count"),
        F.count(F.lit(1)).alias("_n"),
        F.min("x").alias("Min_Value"),
        F.max("x").alias("Max_Value"),
    )
    return counted.select(
        "Feature",
        round_by_rule("Lower_Bound").alias("Lower_Bound"),
        round_by_rule("Upper_Bound").alias("Upper_Bound"),
        "Outlier_Count",
        F.round(F.col("Outlier_Count") * 100.0 / F.col("_n"), 2).alias("Outlier_Percentage"),
        round_by_rule("Min_Value").alias("Min_Value"),
        round_by_rule("Max_Value").alias("Max_Value"),
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, pairwise-complete, in
    one aggregate; long form (Feature_1, Feature_2, Correlation)."""
    aggs = []
    for a in cols:
        for b in cols:
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}"))
    wide = df.agg(*aggs)
    arr = F.array(
        *[F.struct(F.lit(a).alias("Feature_1"), F.lit(b).alias("Feature_2"), F.col(f"`{a}|{b}`").alias("c")) for a in cols for b in cols]
    )
    return wide.select(F.inline(arr)).select("Feature_1", "Feature_2", F.round("c", 2).alias("Correlation"))
