"""Classifier metrics as DataFrame aggregates over a long predictions
table (model, id, label 0/1, probability, prediction 0/1), so every
model is scored in the same pass and the SQL oracle can check them.

Curve points (ROC, PR) and the exact AUC are built on distinct scores:
per (model, score) counts, then running sums from ``ranking`` -- never
a sort of all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import linspace
from .ranking import running_sum


# Every operator takes ``by`` (default: the model column) and needs at
# least one grouping column; a single model is one constant group.


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def metrics(preds: DataFrame, by: Sequence[str] = ("model",), label="label", pred="prediction") -> DataFrame:
    """accuracy, precision, recall, f1 of the positive class per group;
    undefined ratios are 0 (sklearn's zero_division default, warned)."""
    y, p = F.col(label), F.col(pred)
    g = preds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return g.select(
        *by,
        ((tp + tn) / F.col("n")).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def score_counts(preds: DataFrame, by: Sequence[str] = ("model",), label="label", prob="probability") -> DataFrame:
    """(by..., score, pos, neg): rows per distinct score; a score shared
    by a third of all rows is one row after the map-side combine."""
    return preds.groupBy(*by, F.col(prob).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def roc_auc(preds: DataFrame, by: Sequence[str] = ("model",), label="label", prob="probability", **kw) -> DataFrame:
    """Exact ROC AUC with ties = Mann-Whitney U / (n1 n0), from mid-ranks
    over distinct scores."""
    sc = score_counts(preds, by, label, prob).withColumn("cnt", F.col("pos") + F.col("neg"))
    cum = running_sum(sc, "score", ["cnt"], by=list(by), **kw)
    rank = F.col("cum_cnt") - (F.col("cnt") - 1) / 2.0
    g = cum.groupBy(*by).agg(
        F.sum(F.col("pos") * rank).alias("r1"), F.sum("pos").alias("n1"), F.sum("neg").alias("n0")
    )
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")  # their product passes 64 bits
    u = F.col("r1") - n1 * (n1 + 1) / 2.0
    return g.select(*by, F.when((n1 > 0) & (n0 > 0), u / (n1 * n0)).alias("roc_auc"))


def curve_points(preds: DataFrame, by: Sequence[str] = ("model",), label="label", prob="probability", **kw) -> DataFrame:
    """Per distinct threshold t (predict positive when score >= t):
    tp, fp, and totals -- the shared core of ROC and PR curves."""
    sc = score_counts(preds, by, label, prob).withColumn("neg_score", -F.col("score"))
    cum = running_sum(sc, "neg_score", ["pos", "neg"], by=list(by), **kw)
    tot = sc.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    j = cum.join(tot, list(by))
    return j.select(*by, F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"), "n_pos", "n_neg")


def roc_points(preds: DataFrame, by: Sequence[str] = ("model",), **kw) -> DataFrame:
    pts = curve_points(preds, by, **kw)
    return pts.select(
        *by, "threshold",
        _safe_div(F.col("fp").cast("double"), F.col("n_neg")).alias("fpr"),
        _safe_div(F.col("tp").cast("double"), F.col("n_pos")).alias("tpr"),
    )


def pr_points(preds: DataFrame, by: Sequence[str] = ("model",), **kw) -> DataFrame:
    """Precision / recall at each distinct threshold; recall is 1 when
    there are no positives (sklearn's convention)."""
    pts = curve_points(preds, by, **kw)
    return pts.select(
        *by, "threshold",
        _safe_div(F.col("tp").cast("double"), F.col("tp") + F.col("fp")).alias("precision"),
        F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).otherwise(F.lit(1.0)).alias("recall"),
    )


def optimize_threshold(
    preds: DataFrame,
    metric: str = "f1",
    min_recall: float = K.THRESHOLD_MIN_RECALL,
    by: Sequence[str] = ("model",),
    default: float = K.THRESHOLD_DEFAULT,
    pr: DataFrame | None = None,
    **kw,
) -> DataFrame:
    """The threshold the reference's rule picks: f1 -> best F1 with recall
    >= min_recall; recall -> best recall with precision >= 0.5; precision
    -> best precision with recall >= 0.5. Ties go to the lower threshold
    (argmax over ascending thresholds). The curve's end point (precision 1,
    recall 0, no threshold) can win only for 'recall'; then, as when no
    point qualifies, the default is returned."""
    pr = (pr if pr is not None else pr_points(preds, by, **kw)).withColumn("is_end", F.lit(False))
    ends = preds.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        F.lit(True).alias("is_end"),
    )
    pts = pr.unionByName(ends)
    p, r = F.col("precision"), F.col("recall")
    if metric == "f1":
        valid, obj = r >= min_recall, 2 * p * r / (p + r + 1e-10)
    elif metric == "recall":
        valid, obj = p >= 0.5, r
    elif metric == "precision":
        valid, obj = r >= 0.5, p
    else:
        raise ValueError(metric)
    cand = pts.where(valid).select(*by, "threshold", "is_end", obj.alias("objective"))
    # one winner per group: best objective, then the curve point before the
    # end point, then the lowest threshold -- a max over a struct, which is
    # partially aggregated map-side (no task holds a group's thresholds)
    key = F.struct(F.col("objective"), (~F.col("is_end")).alias("not_end"), (-F.col("threshold")).alias("neg_t"),
                   F.col("threshold").alias("t"), F.col("is_end").alias("e"))
    best = cand.groupBy(*by).agg(F.max(key).alias("b")).select(*by, F.col("b.t").alias("threshold"), F.col("b.e").alias("is_end"))
    groups = preds.select(*by).distinct()
    out = groups.join(best, list(by), "left")
    return out.select(
        *by,
        F.lit(metric).alias("metric"),
        F.when(F.col("is_end") | F.col("threshold").isNull(), F.lit(default)).otherwise(F.col("threshold")).alias("threshold"),
    )


def confusion(preds: DataFrame, by: Sequence[str] = ("model",), label="label", pred="prediction") -> DataFrame:
    """All four cells per group (labels [0, 1] x [0, 1]), zero-filled."""
    y, p = F.col(label), F.col(pred)
    g = preds.groupBy(*by).agg(
        *[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)]
    )
    arr = F.array(
        *[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("count")) for a in (0, 1) for b in (0, 1)]
    )
    return g.select(*by, F.inline(arr))


CALIBRATION_EDGES = linspace(0.0, 1.0, 11)


def calibration(preds: DataFrame, by: Sequence[str] = ("model",), label="label", prob="probability", n_bins: int = 10) -> DataFrame:
    """Equal-width bins on [0, 1], right-closed (0 joins the first bin):
    mean predicted probability and fraction of positives per non-empty bin."""
    inner = linspace(0.0, 1.0, n_bins + 1)[1:-1]
    b = sum((F.col(prob) > F.lit(e)).cast("int") for e in inner)
    return preds.groupBy(*by, b.alias("bin")).agg(
        F.avg(prob).alias("mean_predicted"), F.avg(label).alias("fraction_positive"), F.count(F.lit(1)).alias("count")
    )


def brier(preds: DataFrame, by: Sequence[str] = ("model",), label="label", prob="probability") -> DataFrame:
    return preds.groupBy(*by).agg(F.avg((F.col(prob) - F.col(label)) ** 2).alias("brier_score"))


def comparison(preds: DataFrame, by: Sequence[str] = ("model",), **kw) -> DataFrame:
    """One row per model: accuracy, precision, recall, F1, ROC AUC; F1 desc."""
    m = metrics(preds, by).join(roc_auc(preds, by, **kw), list(by), "left")
    return m.orderBy(F.desc("f1_score"), *by)


def best_model(comp: DataFrame, metric: str = "f1_score", order: Sequence[str] | None = None) -> DataFrame:
    """The model with the highest metric; ties go to the first model in
    ``order`` (the reference keeps the first maximum in dict order)."""
    if order:
        pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    else:
        pos = F.col("model")
    return comp.orderBy(F.desc(metric), pos).limit(1)
