"""Running sums in value order, and exact quantiles, without a global
single-partition window.

Every rank-based statistic here (quantiles, KS, Mann-Whitney U, AUC, ROC
and PR points, stratified split) needs, for each distinct value, the
number of rows before it. A ``Window.orderBy`` without ``partitionBy``
moves all rows into one task, so, whatever the size of the table:

1. the caller pre-aggregates to one row per distinct value (a hot value
   with a third of all rows collapses map-side);
2. one grouped aggregate with a fixed-size sketch gives every group its
   own bucket edges; NULL values come before all buckets, NaN after them,
   as Spark orders them;
3. bucket sums (few rows) become offsets with a small window;
4. the running sum is a window inside each bucket plus the offset.

Groups are joined null-safely, so rows of a NULL group stay. There is no
other path for small tables and nothing is persisted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BUCKETS = 1000  # of a group; the sketch behind the edges has a fixed size
SKETCH_ACCURACY = 10_000
MAX_GROUPS = 200  # whose edges are broadcast
BLOCK = 32  # edges compared at once


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> list[Column]:
    return [left[c].eqNullSafe(right["_r_" + c]) for c in cols]


def _renamed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: "_r_" + c for c in cols})


def with_bucket(df: DataFrame, order_col: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Add ``_bucket``: non-decreasing in ``order_col`` within ``by``."""
    x = F.col(order_col).cast("double")
    finite = F.when(~F.isnan(x), x)
    probs = [i / buckets for i in range(1, buckets)]
    if not probs:
        return df.withColumn("_bucket", F.lit(0))
    sketch = F.percentile_approx(finite, probs, SKETCH_ACCURACY)
    if by:
        edges = df.groupBy(*by).agg(sketch.alias("_edges"))
        few = edges.limit(MAX_GROUPS + 1).collect()
        if len(few) <= MAX_GROUPS:  # at most MAX_GROUPS * MAX_BUCKETS numbers; else the rows go to their group's edges
            edges = F.broadcast(df.sparkSession.createDataFrame(few, edges.schema))
        edges = _renamed(edges, by)
        df_e = df.join(edges, _same(df, edges, by)).drop(*["_r_" + c for c in by])
    else:
        found = df.agg(sketch.alias("e")).first()["e"]  # at most MAX_BUCKETS numbers
        df_e = df.withColumn("_edges", F.lit(found or []).cast("array<double>"))
    # the block of edges first, then the place in it
    last = F.transform(F.sequence(F.lit(BLOCK), F.size("_edges"), F.lit(BLOCK)), lambda i: F.element_at("_edges", i.cast("int")))
    last = F.when(F.size("_edges") >= BLOCK, last).otherwise(F.array().cast("array<double>"))
    df_e = df_e.withColumn("_last", last)
    block = F.size(F.filter("_last", lambda e: e <= x)) * BLOCK
    inside = F.coalesce(block + F.size(F.filter(F.slice("_edges", block + 1, F.lit(BLOCK)), lambda e: e <= x)), F.lit(0))
    bucket = F.when(x.isNull(), F.lit(-1)).when(F.isnan(x), F.lit(buckets)).otherwise(inside)
    return df_e.withColumn("_bucket", bucket).drop("_edges", "_last")


def running_sum(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    by: Sequence[str] = (),
    prefix: str = "cum_",
    buckets: int | None = None,
    tiebreak: Sequence[str] = (),
    with_total: bool = False,
) -> DataFrame:
    """Add ``prefix+c`` = inclusive running sum of ``c`` within ``by``, in
    ascending (``order_col``, *``tiebreak``) order (and, with
    ``with_total``, ``tot_+c`` = the group's total). ``df`` should already
    hold one row per distinct order key (or the tiebreak must make the
    order total). ``buckets`` (default: the session's shuffle partitions)
    only spreads the work; the rows are the same for any number."""
    by = list(by)
    order = [F.col(order_col), *[F.col(t) for t in tiebreak]]
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = with_bucket(df, order_col, by, max(1, min(MAX_BUCKETS, buckets)))
    totals = keyed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias("_t_" + c) for c in sum_cols])
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = _renamed(totals.select(
        *by, "_bucket",
        *[F.coalesce(F.sum("_t_" + c).over(before), F.lit(0)).alias("_o_" + c) for c in sum_cols],
        *[F.sum("_t_" + c).over(whole).alias("tot_" + c) for c in sum_cols],
    ), [*by, "_bucket"])
    w = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = keyed.withColumns({prefix + c: F.sum(c).over(w) for c in sum_cols})
    joined = summed.join(offsets, _same(summed, offsets, [*by, "_bucket"]))
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(prefix + c) + F.col("_o_" + c)).alias(prefix + c) for c in sum_cols],
        *([F.col("tot_" + c) for c in sum_cols] if with_total else []),
    )


def value_counts(df: DataFrame, col: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """One row per (by, non-null value) with its row count ``_n``."""
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(w.alias("_n"))


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas ``quantile``,
    SQL ``quantile_cont``), per ``by`` group, as a DataFrame with columns
    (*by, ``q``, ``value``). Distributed: running counts over distinct
    values, then only the rows straddling each target rank are kept."""
    counts = value_counts(df, col, by)
    ranked = running_sum(counts, col, ["_n"], by=by, buckets=buckets, with_total=True)
    ranked = ranked.withColumnRenamed("tot__n", "_total")
    start = F.col("cum__n") - F.col("_n")  # 0-based rank of this value's first row
    # only the targets inside a value's rank interval are exploded
    inside = lambda r: (r >= start) & (r < F.col("cum__n"))
    targets = F.array(*[F.struct(F.lit(float(p)).alias("q"), (F.lit(float(p)) * (F.col("_total") - 1)).alias("h")) for p in probs])
    hit = F.filter(targets, lambda t: inside(F.floor(t["h"])) | inside(F.ceil(t["h"])))
    exploded = ranked.select("*", F.inline(hit))
    h = F.col("h")
    hit_lo, hit_hi = inside(F.floor(h)), inside(F.ceil(h))
    pieces = exploded.select(
        *by, "q", F.col(col).cast("double").alias("v"), hit_lo.alias("is_lo"), hit_hi.alias("is_hi"), "h"
    )
    agg = pieces.groupBy(*by, "q").agg(
        F.max(F.when(F.col("is_lo"), F.col("v"))).alias("v_lo"),
        F.max(F.when(F.col("is_hi"), F.col("v"))).alias("v_hi"),
        F.first("h").alias("h"),
    )
    frac = F.col("h") - F.floor(F.col("h"))
    return agg.select(*by, "q", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * frac).alias("value"))


def scalar_quantiles(df: DataFrame, col: str, probs: Sequence[float], **kw) -> list[float | None]:
    """Exact quantiles as Python floats (one small collect)."""
    rows = {r["q"]: r["value"] for r in exact_quantiles(df, col, probs, **kw).collect()}
    return [rows.get(float(p)) for p in probs]


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], **kw) -> dict[str, list]:
    """Exact quantiles of several columns in one distributed pass (the
    columns are unpivoted and ranked per column)."""
    arr = F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_x")) for c in cols])
    long = df.select(F.inline(arr))
    rows = exact_quantiles(long, "_x", probs, by=["_c"], **kw).collect()
    got = {(r["_c"], r["q"]): r["value"] for r in rows}
    return {c: [got.get((c, float(p))) for p in probs] for c in cols}
