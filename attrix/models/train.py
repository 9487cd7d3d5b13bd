"""The three searched learners: balanced weights, stratified folds that all
of them share, whole grids or seeded samples of a space, and F1 of the
positive class as the criterion.

  logistic regression  all penalties and folds by shared Newton passes
                       (``logistic``); the best penalty is fitted on all rows
                       by Spark ML (the same objective: regParam = 1 / (C *
                       sum of weights), standardization off; the solver of
                       the reference's grid has no meaning here)
  random forest        ``search``, then ``forest``, on all rows
  gradient boosting    the same with ``boosting``, second order; with
                       validation rows it stops early on their log loss

The fitted ensembles become Spark ML models (``spark_trees``); their nodes
are kept for importances and attributions.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators.ranking import running_sum
from ..operators.split import seeded_hash
from ..session import saved
from . import binned as B
from . import boosting, forest, logistic, search, spark_trees
from . import encode as E
from . import trees as T


@dataclass
class TrainResult:
    name: str
    model: PipelineModel  # preprocessor stages + fitted classifier
    params: dict
    cv_f1: float
    encoding: E.FittedEncoding
    cv_table: list = field(default_factory=list)  # (point, mean F1)
    folds: np.ndarray | None = None  # F1 by point and fold
    kind: str = "linear"  # linear, forest or boost
    nodes: DataFrame | None = None  # of an ensemble

    def best_point(self) -> int:
        return max(range(len(self.cv_table)), key=lambda i: (self.cv_table[i][1], -i))


def f1_evaluator() -> MulticlassClassificationEvaluator:
    """F1 of the positive class (label 1), unweighted, as the reference
    scores its searches."""
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0)


def scoring_defs() -> dict[str, MulticlassClassificationEvaluator]:
    return {
        "recall": MulticlassClassificationEvaluator(labelCol="label", metricName="recallByLabel", metricLabel=1.0),
        "f1": f1_evaluator(),
        "accuracy": MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"),
    }


def class_weights(df: DataFrame, label: str = "label") -> dict[int, float]:
    """'balanced' weights n / (2 n_c), from one small aggregate."""
    counts = {int(r[label]): r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    return {c: n / (len(counts) * k) for c, k in counts.items()}


def weight_col(weights: dict[int, float], label: str = "label") -> F.Column:
    expr = F.lit(1.0)
    for c, w in weights.items():
        expr = F.when(F.col(label) == c, F.lit(float(w))).otherwise(expr)
    return expr


def scale_pos_weight(data: DataFrame) -> float:
    """Negatives / positives."""
    counts = {int(r["label"]): r["n"] for r in data.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    return counts.get(0, 0) / max(counts.get(1, 1), 1)


def stratified_folds(df: DataFrame, label: str, key: str, k: int = K.CV_FOLDS, seed: int = K.SEED) -> DataFrame:
    """fold in [0, k): rank within label by seeded hash, modulo k -- equal
    class shares per fold, without a per-label single-task sort."""
    h = df.withColumn("_h", seeded_hash(key, seed + 1)).withColumn("_one", F.lit(1))
    ranked = running_sum(h, "_h", ["_one"], by=[label], tiebreak=[key])
    return ranked.select(*df.columns, F.pmod(F.col("cum__one") - 1, F.lit(k)).cast("int").alias("fold"))


def folded(train: DataFrame, roles: E.Roles, positive="Yes", folds: int = K.CV_FOLDS) -> DataFrame:
    """Training rows with 0/1 ``label`` and ``fold``, written once for every
    learner, so that all are compared on the same folds."""
    df = train.withColumn("label", (F.col(roles.label) == positive).cast("double")).where("label is not null")
    return saved(stratified_folds(df, "label", roles.key, folds), "models", "folds")


def sample_space(space: dict, n_iter: int, seed: int) -> list[dict]:
    """Seeded sample without replacement from the full grid (all lists)."""
    keys = list(space)
    combos = list(itertools.product(*[space[k] for k in keys]))
    rng = random.Random(seed)
    picked = rng.sample(combos, min(n_iter, len(combos)))
    return [dict(zip(keys, c)) for c in picked]


def _result(name: str, model, points: list[dict], scores: np.ndarray, best: int, enc: E.FittedEncoding, **more) -> TrainResult:
    means = scores.mean(axis=1)
    table = [(p, float(m)) for p, m in zip(points, means)]
    return TrainResult(name, PipelineModel([*E.preprocessor(enc).stages, model]), dict(points[best]), float(means[best]), enc, table, scores, **more)


def search_lr(rows: DataFrame, roles: E.Roles, folds: int = K.CV_FOLDS, c_grid: Sequence[float] = K.LR_C_GRID) -> TrainResult:
    """The whole grid of the logistic model on the scaled encoding of
    :func:`folded` rows."""
    enc = E.fit_encoding(rows, roles, scale=True)
    data = E.encode(rows, enc).select(roles.key, "label", "fold", "features")
    fits = [(float(c), f) for c in c_grid for f in range(folds)]
    _, marks = logistic.newton(data, len(enc.feature_names()), fits)
    scores = search.f1(*marks.T).reshape(len(c_grid), folds)
    best = int(scores.mean(axis=1).argmax())  # the first best
    weights = class_weights(data)
    weighted = data.withColumn("weight", weight_col(weights)).persist()
    total = weighted.agg(F.sum("weight")).first()[0]
    # max_iter and tol as the reference's learner
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=1000, tol=1e-4, standardization=False,
                            elasticNetParam=0.0, regParam=1.0 / (c_grid[best] * total))
    model = lr.fit(weighted)
    weighted.unpersist()
    return _result("Logistic Regression", model, [{"C": c} for c in c_grid], scores, best, enc)


def _binned(rows: DataFrame, roles: E.Roles, val: DataFrame | None = None, positive="Yes"):
    """(encoding, bins, binned rows) of training rows, and of validation rows
    marked as such; encoding and bins come from the training rows."""
    enc = E.fit_encoding(rows, roles, scale=False)
    columns = [roles.key, "label", "fold", "is_val", "features"]
    data = E.encode(rows.withColumn("is_val", F.lit(False)), enc).select(*columns)
    bins = T.fit_bins(data, len(enc.feature_names()))
    if val is not None:
        own = val.withColumn("label", (F.col(roles.label) == positive).cast("double")).where("label is not null")
        data = data.unionByName(E.encode(own.withColumn("fold", F.lit(-1)).withColumn("is_val", F.lit(True)), enc).select(*columns))
    return enc, bins, B.binned(data, bins, roles.key)


def search_rf(rows: DataFrame, roles: E.Roles, n_iter: int = K.RF_SEARCH_ITER, folds: int = K.CV_FOLDS, seed: int = K.SEED,
              space: dict = K.RF_SPACE) -> TrainResult:
    """Random search of the forest on :func:`folded` rows; the best point is
    grown on all of them."""
    enc, bins, data = _binned(rows, roles)
    points = sample_space(space, n_iter, seed)
    scores = search.cross_validate(data, bins, "forest", points, folds, seed=seed)
    best = int(scores.mean(axis=1).argmax())
    nodes = forest.grown(data, bins, points[best], seed)
    model = spark_trees.load(nodes, "forest", len(bins.cuts), points[best]["max_depth"] or 30)
    return _result("Random Forest", model, points, scores, best, enc, kind="forest", nodes=nodes)


def search_gbt(rows: DataFrame, roles: E.Roles, val: DataFrame | None = None, positive="Yes", n_iter: int = K.GBT_SEARCH_ITER,
               folds: int = K.CV_FOLDS, seed: int = K.SEED, space: dict = K.GBT_SPACE) -> TrainResult:
    """Random search of boosting on :func:`folded` rows; the best point is
    grown on all of them, with early stopping on ``val``. Positives weigh
    negatives / positives."""
    enc, bins, data = _binned(rows, roles, val, positive)
    weight = scale_pos_weight(rows)
    points = sample_space(space, n_iter, seed)
    scores = search.cross_validate(data, bins, "boost", points, folds, weight, seed)
    best = int(scores.mean(axis=1).argmax())
    ensemble = boosting.boost(data, bins, points[best], weight, seed, K.GBT_EARLY_STOP_ROUNDS)
    nodes = saved(spark_trees.boosted_nodes(data.sparkSession, ensemble, bins), "models", "nodes")
    model = spark_trees.load(nodes, "boost", len(bins.cuts), points[best]["max_depth"])
    out = _result("Gradient Boosting", model, points, scores, best, enc, kind="boost", nodes=nodes)
    out.params["trees_kept"] = len(ensemble)
    return out


def train_all(train: DataFrame, roles: E.Roles, val: DataFrame | None = None, positive="Yes", folds: int = K.CV_FOLDS,
              forest_search: dict | None = None, boosting_search: dict | None = None) -> dict[str, TrainResult]:
    """All three searches on the same folds; the last two arguments are
    options of :func:`search_rf` and :func:`search_gbt`."""
    rows = folded(train, roles, positive, folds)
    results = [search_lr(rows, roles, folds), search_rf(rows, roles, folds=folds, **(forest_search or {})),
               search_gbt(rows, roles, val, positive, folds=folds, **(boosting_search or {}))]
    return {r.name: r for r in results}


def fold_scores(spark: SparkSession, results: dict[str, TrainResult]) -> DataFrame:
    """(model, point, params, fold, f1) of everything that was fitted on folds."""
    rows = [(name, i, str(r.cv_table[i][0]), f, float(r.folds[i, f])) for name, r in results.items() for i in range(len(r.folds)) for f in range(r.folds.shape[1])]
    return spark.createDataFrame(rows, "model string, point int, params string, fold int, f1 double")
