"""The end-to-end run the reference's driver script performs, on Spark:
exploratory tables -> clean -> features -> stratified 60/20/20 split ->
three searched models -> test metrics, validation-tuned thresholds,
calibration, McNemar -> explanations -> saved model. Every table is
written under ``out`` (a shared folder); nothing passes through the
driver but fitted scalars and small result rows."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models import encode as E
from ..models import explain as X
from ..models import shap as SH
from ..models.score import artefact
from ..models.train import TrainResult, fold_scores, train_all
from ..operators import clean as CL
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import split as SP
from ..operators import stats as ST
from ..sources.results import write_results
from .eda import SNAPSHOT, EdaColumns, run_eda


def predictions(models: dict, data: DataFrame, key: str, label: str, positive="Yes") -> DataFrame:
    out = None
    for name, r in models.items():
        s = r.model.transform(data).select(
            F.lit(name).alias("model"), key, (F.col(label) == positive).cast("int").alias("label"),
            vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("prediction"),
        )
        out = s if out is None else out.unionByName(s)
    return out


def contributions(r: TrainResult, train: DataFrame, data: DataFrame, key: str) -> DataFrame:
    """(key, contrib array<double>, base, margin) of every row of ``data``
    under a fitted model."""
    pre, width = E.preprocessor(r.encoding), len(r.encoding.feature_names())
    if r.kind != "linear":
        return SH.contributions(pre.transform(data), r.nodes, r.kind, width, key)
    means = X.feature_means(pre.transform(train), width)
    out = X.linear_contributions(pre.transform(data), r.model, means, key)
    whole = F.aggregate("contrib", F.lit(0.0), lambda a, v: a + v)
    return out.select(key, "contrib", (F.col("margin") - whole).alias("base"), "margin")


def run(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    spec: FE.FeatureSpec | None = None,
    key: str = "customerID",
    label: str = "Churn",
    searches: dict | None = None,
    eda: EdaColumns | None = None,
) -> dict:
    """Run everything on ``raw`` (a customer table with text totals) and
    write the result tables to ``out``. Returns a small summary dict."""
    spec = spec or FE.FeatureSpec()
    summary: dict = {}
    write_results({f"eda_{k}": v for k, v in run_eda(raw, eda or EdaColumns(label=label, key=key)).items()}, out)

    cleaned = CL.clean_table(raw, id_col=None).cache()
    split = SP.stratified_split(cleaned, label, key, test_pct=20, val_pct=20).cache()
    train = split.where(F.col("split") == "train")
    spec = FE.fit_feature_params(train, spec)  # the median comes from training rows only
    summary["monthly_median"] = spec.monthly_median
    feats = FE.add_features(split, spec, fit=False)
    # the written split table cuts the lineage: every later stage (three
    # searches, scoring, explanations) rereads it from the shared folder
    # instead of recomputing clean -> rank -> split after a lost executor
    feats = spark.read.parquet(SP.save_splits(feats, f"{out}/splits")).cache()
    tr, va, te = (feats.where(F.col("split") == s) for s in ("train", "val", "test"))

    roles = E.feature_roles(feats.drop("split"), key, label)
    models = train_all(tr, roles, val=va, **(searches or {}))
    summary["cv_f1"] = {n: r.cv_f1 for n, r in models.items()}
    summary["params"] = {n: {k: str(v) for k, v in r.params.items()} for n, r in models.items()}

    test_p = predictions(models, te, key, label).cache()
    val_p = predictions(models, va, key, label)
    comp = M.comparison(test_p)
    best = M.best_model(comp, "f1_score", list(models)).first()["model"]
    summary["best_model"] = best
    thresholds = None
    for metric in ("f1", "recall", "precision"):
        t = M.optimize_threshold(val_p, metric)  # tuned on validation, not test
        thresholds = t if thresholds is None else thresholds.unionByName(t)
    names = {n: r.encoding.feature_names() for n, r in models.items()}
    importance = None
    for n, r in models.items():
        t = X.linear_importance(spark, r.model, names[n]) if r.kind == "linear" else X.tree_importance(spark, r.nodes, r.kind, names[n])
        t = t.select(F.lit(n).alias("model"), "*")
        importance = t if importance is None else importance.unionByName(t)
    top = None
    for n, r in models.items():
        t = X.top_contributors(contributions(r, tr, te, key), names[n], 10).select(F.lit(n).alias("model"), "*")
        top = t if top is None else top.unionByName(t)
    write_results(
        {
            "model_comparison": comp,
            "confusion": M.confusion(test_p),
            "roc_points": M.roc_points(test_p),
            "thresholds": thresholds,
            "calibration": M.calibration(test_p),
            "brier": M.brier(test_p),
            "mcnemar": ST.mcnemar(
                test_p.groupBy(key, "label").pivot("model", list(models)).agg(F.first("prediction")),
                "label", list(models),
            ),
            "feature_importance": importance,
            "top_drivers": top,
            "cv_folds": fold_scores(spark, models),
        },
        out,
    )
    # one pipeline with features, encoder and model; ``python -m attrix score`` reads it
    artefact(models[best].model, spec).write().overwrite().save(f"{out}/model")
    summary["feature_spec"] = asdict(spec)
    with open_text(spark, f"{out}/summary.json") as fh:
        fh.write(json.dumps(summary, indent=2, default=str))
    return summary


class open_text:
    """Write a small text file through the Hadoop filesystem API, so the
    summary lands next to the tables on any shared store."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.parts = spark, path, []

    def __enter__(self):
        return self

    def write(self, s: str) -> None:
        self.parts.append(s)

    def __exit__(self, *exc):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        stream = fs.create(p, True)
        stream.write(bytearray("".join(self.parts), "utf-8"))
        stream.close()
        return False


def snapshot_run(spark: SparkSession, sf_dir: str, out: str, searches: dict | None = None) -> dict:
    """``run`` on the TPC-H-derived snapshot with its parameters."""
    from ..sources.snapshot import customer_snapshot

    return run(spark, customer_snapshot(spark, sf_dir), out, FE.snapshot_spec(), searches=searches, eda=SNAPSHOT)


def csv_run(spark: SparkSession, path: str, out: str, searches: dict | None = None) -> dict:
    """``run`` on a customer file in the reference's format and defaults."""
    from ..sources.tables import load_customers

    return run(spark, load_customers(spark, path), out, FE.FeatureSpec(), searches=searches)


def score_file(spark: SparkSession, model: str, csv: str, out: str, rules=None) -> int:
    """Score a customer file with a saved pipeline; the number of rows."""
    from ..functions.columns import reference_risk_factor_rules
    from ..models.score import decided
    from ..sources.results import load_model
    from ..sources.tables import load_customers

    fitted = load_model(model)
    if fitted is None:
        raise FileNotFoundError(f"no model at {model}")
    scored = decided(fitted.transform(load_customers(spark, csv)), rules or reference_risk_factor_rules())
    scored.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out).count()
