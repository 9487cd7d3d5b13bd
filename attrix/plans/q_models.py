"""Registered queries: model metrics (exact, on fixed formula scores, so
the oracle checks them), then fitted Spark ML models, explanations,
scoring, result sinks and sources (rows-only checks)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import metrics as M
from ..operators.rates import is_positive
from .catalog import query
from .q_prep import FEATURES_CTE, featured, rule_score
from .sql_base import with_base

D = "::DOUBLE"

# --- formula models: long predictions table --------------------------------------------------
FORMULAS = {
    "rule": "(contract_risk_score + payment_risk_score + (4 - support_services_count) + SeniorCitizen) / 11.0::DOUBLE",
    "contract": "(contract_risk_score - 1) / 2.0::DOUBLE",
    "support": "(4 - support_services_count) / 4.0::DOUBLE",
}
MODEL_ORDER = list(FORMULAS)


def formula_long(spark, sf) -> DataFrame:
    """(model, customerID, label, probability, prediction) for the three
    fixed formulas; prediction = probability > 0.5."""
    from ..sources.snapshot import session_cached

    return session_cached(spark, (sf, "formula_long"), lambda: _formula_long(spark, sf))


def _formula_long(spark, sf) -> DataFrame:
    df = featured(spark, sf)
    probs = {
        "rule": rule_score(df),
        "contract": (F.col("contract_risk_score") - 1) / 2.0,
        "support": (4 - F.col("support_services_count")) / 4.0,
    }
    arr = F.array(*[F.struct(F.lit(m).alias("model"), p.alias("probability")) for m, p in probs.items()])
    long = df.select("customerID", is_positive("Churn").alias("label"), F.inline(arr))
    return long.select("model", "customerID", "label", "probability", (F.col("probability") > 0.5).cast("int").alias("prediction"))


LONG_CTE = FEATURES_CTE + ",\nlp AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, customerID, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label, {e} AS probability, "
    f"CASE WHEN {e} > 0.5 THEN 1 ELSE 0 END AS prediction FROM feat"
    for m, e in FORMULAS.items()
) + ")"

METRICS_CTE = LONG_CTE + f""",
cnt AS (SELECT model, count(*) AS n, count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
               count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp, count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn,
               count(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn FROM lp GROUP BY model),
mets AS (SELECT model, (tp + tn) * 1.0{D} / n AS accuracy,
                CASE WHEN tp + fp > 0 THEN tp * 1.0{D} / (tp + fp) ELSE 0.0 END AS precision,
                CASE WHEN tp + fn > 0 THEN tp * 1.0{D} / (tp + fn) ELSE 0.0 END AS recall,
                CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0{D} * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score FROM cnt),
sc AS (SELECT model, probability AS score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
       FROM lp GROUP BY model, probability),
auc AS (SELECT model, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
          (sum(pos * (cumn - (pos + neg - 1) / 2.0{D})) - sum(pos) * (sum(pos) + 1) / 2.0{D}) / (sum(pos) * sum(neg)) END AS roc_auc
        FROM (SELECT *, sum(pos + neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumn FROM sc)
        GROUP BY model),
pts AS (SELECT model, score AS threshold,
          sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS n_pos, sum(neg) OVER (PARTITION BY model) AS n_neg
        FROM sc WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def r6(c: str) -> F.Column:
    return F.round(c, 6).alias(c)


@query("score_model", with_base("SELECT * FROM lp", LONG_CTE))
def q_score_model(spark, sf):
    """The long predictions table every metric reads."""
    return formula_long(spark, sf)


@query(
    "metrics",
    with_base("SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, "
              "round(f1_score, 6) AS f1_score FROM mets", METRICS_CTE),
)
def q_metrics(spark, sf):
    """Accuracy, precision, recall and F1 of the positive class per model."""
    return M.metrics(formula_long(spark, sf)).select("model", *[r6(c) for c in ["accuracy", "precision", "recall", "f1_score"]])


@query("roc_auc", with_base("SELECT model, round(roc_auc, 6) AS roc_auc FROM auc", METRICS_CTE))
def q_roc_auc(spark, sf):
    """Exact ROC AUC with ties per model."""
    return M.roc_auc(formula_long(spark, sf)).select("model", r6("roc_auc"))


@query(
    "confusion",
    with_base(
        "SELECT m.model, a AS actual, p AS predicted, "
        "(SELECT count(*) FROM lp l WHERE l.model = m.model AND l.label = a AND l.prediction = p) AS count "
        "FROM (SELECT DISTINCT model FROM lp) m, (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(p)",
        LONG_CTE,
    ),
)
def q_confusion(spark, sf):
    """All four confusion cells per model, zero-filled."""
    return M.confusion(formula_long(spark, sf))


@query(
    "roc_points",
    with_base(
        "SELECT model, threshold, round(CASE WHEN n_neg > 0 THEN fp * 1.0::DOUBLE / n_neg ELSE 0.0 END, 6) AS fpr, "
        "round(CASE WHEN n_pos > 0 THEN tp * 1.0::DOUBLE / n_pos ELSE 0.0 END, 6) AS tpr FROM pts",
        METRICS_CTE,
    ),
)
def q_roc_points(spark, sf):
    """False and true positive rates at every distinct threshold per model."""
    return M.roc_points(formula_long(spark, sf)).select("model", "threshold", r6("fpr"), r6("tpr"))


@query(
    "comparison",
    with_base(
        "SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, "
        "round(f1_score, 6) AS f1_score, round(roc_auc, 6) AS roc_auc FROM mets JOIN auc USING (model)",
        METRICS_CTE,
    ),
)
def q_comparison(spark, sf):
    """Accuracy, precision, recall, F1 and ROC AUC per model."""
    c = M.comparison(formula_long(spark, sf))
    return c.select("model", *[r6(x) for x in ["accuracy", "precision", "recall", "f1_score", "roc_auc"]])


@query(
    "best_model",
    with_base(
        "SELECT model, round(f1_score, 6) AS f1_score FROM mets ORDER BY f1_score DESC, "
        "CASE model " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(MODEL_ORDER)) + " END LIMIT 1",
        METRICS_CTE,
    ),
)
def q_best_model(spark, sf):
    """The model with the best F1; ties go to the first model in order."""
    b = M.best_model(M.comparison(formula_long(spark, sf)), "f1_score", MODEL_ORDER)
    return b.select("model", r6("f1_score"))


def _threshold_sql(metric: str) -> str:
    valid = {"f1": "recall >= 0.75", "recall": "precision >= 0.5", "precision": "recall >= 0.5"}[metric]
    obj = {"f1": "2 * precision * recall / (precision + recall + 1e-10)", "recall": "recall", "precision": "precision"}[metric]
    return f"""SELECT m.model, '{metric}' AS metric, CASE WHEN b.is_end OR b.threshold IS NULL THEN 0.5 ELSE b.threshold END AS threshold
FROM (SELECT DISTINCT model FROM lp) m LEFT JOIN (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY model ORDER BY {obj} DESC, is_end ASC, threshold ASC) AS rn FROM (
      SELECT model, threshold, CASE WHEN tp + fp > 0 THEN tp * 1.0{D} / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN n_pos > 0 THEN tp * 1.0{D} / n_pos ELSE 1.0 END AS recall, false AS is_end FROM pts
      UNION ALL SELECT DISTINCT model, NULL, 1.0, 0.0, true FROM lp) WHERE {valid}) WHERE rn = 1) b USING (model)"""


@query("threshold", with_base(" UNION ALL ".join(_threshold_sql(m) for m in ("f1", "recall", "precision")), METRICS_CTE))
def q_threshold(spark, sf):
    """Decision threshold by each of the three rules, per model. (In the
    training flow this runs on the validation split, not on test.)"""
    lp = formula_long(spark, sf)
    pr = M.pr_points(lp)  # one curve, three rules
    out = None
    for m in ("f1", "recall", "precision"):
        t = M.optimize_threshold(lp, m, pr=pr)
        out = t if out is None else out.unionByName(t)
    return out


CAL_EDGES = M.CALIBRATION_EDGES[1:-1]


@query(
    "calibration",
    with_base(
        "SELECT model, CAST(" + " + ".join(f"(CASE WHEN probability > {e!r}::DOUBLE THEN 1 ELSE 0 END)" for e in CAL_EDGES)
        + " AS INTEGER) AS bin, round(avg(probability), 6) AS mean_predicted, round(avg(label), 6) AS fraction_positive, count(*) AS count "
        "FROM lp GROUP BY ALL",
        LONG_CTE,
    ),
)
def q_calibration(spark, sf):
    """Ten equal-width right-closed probability bins: mean prediction, fraction positive."""
    c = M.calibration(formula_long(spark, sf))
    return c.select("model", "bin", r6("mean_predicted"), r6("fraction_positive"), "count")


@query("brier", with_base("SELECT model, round(avg(power(probability - label, 2)), 6) AS brier_score FROM lp GROUP BY model", LONG_CTE))
def q_brier(spark, sf):
    """Brier score per model."""
    return M.brier(formula_long(spark, sf)).select("model", r6("brier_score"))


@query(
    "evaluate_all",
    with_base(
        f"""SELECT model, round(f1_score, 6) AS f1_score, round(roc_auc, 6) AS roc_auc, round(b.brier_score, 6) AS brier_score,
  t.threshold AS f1_threshold
FROM mets JOIN auc USING (model) JOIN (SELECT model, avg(power(probability - label, 2)) AS brier_score FROM lp GROUP BY model) b USING (model)
JOIN ({_threshold_sql('f1')}) t USING (model)""",
        METRICS_CTE,
    ),
)
def q_evaluate_all(spark, sf):
    """metrics + AUC + Brier + F1-rule threshold, one row per model."""
    from .evaluate import evaluate_all

    out = evaluate_all(formula_long(spark, sf))
    return out.select("model", r6("f1_score"), r6("roc_auc"), r6("brier_score"), "f1_threshold")


# =============================================================================
# Encoding, fitted models, explanations, scoring, sinks
# =============================================================================
from ..functions import columns as C  # noqa: E402
from ..models import encode as E  # noqa: E402
from ..operators import split as SP  # noqa: E402
from ..operators.features import add_features, fit_feature_params  # noqa: E402
from ..session import shared_path  # noqa: E402
from ..sources import snapshot as S  # noqa: E402
from .q_eda import BIV_CTE, RATES_CTE, eda_frame  # noqa: E402
from .q_prep import SPEC, _split_sql, clean, raw  # noqa: E402

NUMS = S.NUMERIC_COLUMNS
CAT_TEXT = ["Region", "Contract", "PaymentMethod", "InternetService", *K.SUPPORT_SERVICES]
# Domains of the TPC-H-derived snapshot columns (fixed by the generator's spec)
DOMAINS = {
    "Region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "Contract": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "PaymentMethod": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "InternetService": ["F", "O", "P"],
    **{c: ["No", "Yes"] for c in K.SUPPORT_SERVICES},
}

@query(
    "scale",
    with_base(
        "SELECT customerID, " + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in NUMS
        ) + " FROM clean"
    ),
)
def q_scale(spark, sf):
    """Standardisation with the population standard deviation."""
    df = clean(spark, sf)
    enc = E.fit_encoding(df, E.Roles(NUMS, [], "customerID"), scale=True)
    out = E.encode(df, enc)
    from pyspark.ml.functions import vector_to_array

    a = vector_to_array("features")
    return out.select("customerID", *[F.round(a[i], 6).alias(c) for i, c in enumerate(NUMS)])


def _onehot_sql() -> str:
    cols = []
    for c in CAT_TEXT:
        for v in DOMAINS[c][1:]:
            cols.append(f"CAST(coalesce({c} = '{v}', false) AS DOUBLE) AS \"{c}_{v}\"")
    return "SELECT customerID, " + ", ".join(cols) + " FROM clean"


@query("onehot_drop_first", with_base(_onehot_sql()))
def q_onehot(spark, sf):
    """Indicator per category after the first (sorted); unknown -> zeros."""
    df = clean(spark, sf)
    enc = E.fit_encoding(df, E.Roles([], CAT_TEXT, "customerID"), scale=False)
    out = E.preprocessor(enc).transform(df)
    return out.select("customerID", *[F.col(f"`f__{n}`").alias(n) for n in enc.feature_names()])


def training_spec(spark, sf):
    """The feature rules with the median of the training rows."""
    return _once(spark, (sf, "spec"), lambda: fit_feature_params(_split(spark, sf).where("split = 'train'"), SPEC))


def _split(spark, sf):
    """The splits, written once: the ranking behind them is not repeated by
    every pass over them."""
    from ..session import saved

    return _once(spark, (sf, "split"), lambda: saved(SP.stratified_split(clean(spark, sf), "Churn", "customerID", test_pct=20, val_pct=20), "models", "split"))


def _featured_split(spark, sf):
    """Features of all rows by the rules fitted on training rows, and splits."""
    return add_features(_split(spark, sf), training_spec(spark, sf), fit=False)


def model_roles(df) -> E.Roles:
    return E.feature_roles(df.drop("split"), "customerID", "Churn")


def _roles_sql() -> str:
    from .q_prep import FEATURES_SQL  # noqa: F401

    num = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "contract_risk_score", "payment_risk_score",
           "support_services_count", "charge_per_month", "senior_high_charge", "fiber_optic_no_support"]
    cat = ["Region", "Contract", "PaymentMethod", "InternetService", *K.SUPPORT_SERVICES, "tenure_group"]
    parts = [f"SELECT '{c}' AS column_name, 'numeric' AS role, (SELECT count(DISTINCT {c}) FROM feat) AS n_distinct" for c in num]
    parts += [f"SELECT '{c}', 'categorical', (SELECT count(DISTINCT {c}) FROM feat)" for c in cat]
    return " UNION ALL ".join(parts)


@query("feature_roles", with_base(_roles_sql(), FEATURES_CTE))
def q_feature_roles(spark, sf):
    """Typed roles of the model inputs (numerics stay numeric) with their
    distinct counts."""
    from .q_prep import featured

    df = featured(spark, sf)
    roles = model_roles(df)
    pairs = [(c, "numeric") for c in roles.numeric] + [(c, "categorical") for c in roles.categorical]
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("role"), F.col(c).cast("string").alias("v")) for c, r in pairs])
    long = df.select(F.inline(arr))
    return long.groupBy("column_name", "role").agg(F.count_distinct("v").alias("n_distinct"))


def _names_sql() -> str:
    num = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "contract_risk_score", "payment_risk_score",
           "support_services_count", "charge_per_month", "senior_high_charge", "fiber_optic_no_support"]
    cat = ["Region", "Contract", "PaymentMethod", "InternetService", *K.SUPPORT_SERVICES, "tenure_group"]
    nums = " UNION ALL ".join(f"SELECT {i} AS idx, '{c}' AS feature" for i, c in enumerate(num))
    cats = " UNION ALL ".join(
        f"SELECT {j} AS o, v, row_number() OVER (ORDER BY v) AS r FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM tr WHERE {c} IS NOT NULL), "
        f"(SELECT '{c}' AS cname) q" for j, c in enumerate(cat)
    ).replace(" AS o, v,", " AS o, v,")
    catsq = " UNION ALL ".join(
        f"SELECT {j} AS o, '{c}' AS cname, v, row_number() OVER (ORDER BY v) AS r FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM tr WHERE {c} IS NOT NULL)"
        for j, c in enumerate(cat)
    )
    return f"""SELECT CAST(idx AS INTEGER) AS idx, feature FROM ({nums})
UNION ALL
SELECT CAST({len(num)} - 1 + row_number() OVER (ORDER BY o, v) AS INTEGER), cname || '_' || v FROM ({catsq}) WHERE r > 1"""


@query(
    "feature_names",
    with_base(_names_sql(), FEATURES_CTE + "," + _split_sql(20, 20)
              + ",\ntr AS (SELECT f.* FROM feat f JOIN cut c USING (customerID) WHERE c.r >= c.n_test + c.n_val)"),
)
def q_feature_names(spark, sf):
    """Names of the assembled vector's slots, fitted on the training split."""
    df = _featured_split(spark, sf)
    train = df.where(F.col("split") == "train")
    enc = E.fit_encoding(train, model_roles(df), scale=False)
    rows = list(enumerate(enc.feature_names()))
    return spark.createDataFrame(rows, "idx int, feature string")


@query(
    "class_weight",
    with_base(
        "SELECT CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label, count(*) AS n, "
        "round((SELECT count(*) FROM clean) * 1.0::DOUBLE / (2 * count(*)), 6) AS weight, "
        "round((SELECT count(*) FILTER (WHERE Churn != 'Yes') FROM clean) * 1.0::DOUBLE / "
        "(SELECT count(*) FILTER (WHERE Churn = 'Yes') FROM clean), 6) AS scale_pos_weight FROM clean GROUP BY ALL"
    ),
)
def q_class_weight(spark, sf):
    """'balanced' weights n / (2 n_c) per class, and the boosting weight of
    positives (negatives / positives)."""
    from ..models.train import class_weights

    df = clean(spark, sf).withColumn("label", is_positive("Churn"))
    w = class_weights(df, "label")
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    wmap = F.create_map(*[x for k, v in w.items() for x in (F.lit(k), F.lit(v))])
    spw = w[1] and w[1] / w[0]  # (n / 2 n1) / (n / 2 n0) = n0 / n1
    return counts.select("label", "n", F.round(wmap[F.col("label")], 6).alias("weight"),
                         F.round(F.lit(spw), 6).alias("scale_pos_weight"))


_TRAINED: dict = {}


def _once(spark, key, make):
    """``make()`` once per session and input folder."""
    from ..sources.snapshot import session_key

    key = (session_key(spark), *key)
    if key not in _TRAINED or _TRAINED[key][1] is not spark:
        _TRAINED[key] = (make(), spark)
    return _TRAINED[key][0]


def split_rows(spark, sf) -> DataFrame:
    """All featured rows with their split, written once and read by every
    model query."""
    from ..session import saved

    return _once(spark, (sf, "rows"), lambda: saved(_featured_split(spark, sf), "models", "rows"))


def parts(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    df = split_rows(spark, sf)
    return tuple(df.where(F.col("split") == s) for s in ("train", "val", "test"))


def _folds(spark, sf) -> DataFrame:
    from ..models.train import folded

    return _once(spark, (sf, "folds"), lambda: folded(parts(spark, sf)[0], model_roles(split_rows(spark, sf))))


def trained_lr(spark, sf):
    """The logistic search, whole, once per session and input folder."""
    from ..models.train import search_lr

    return _once(spark, (sf, "lr"), lambda: search_lr(_folds(spark, sf), model_roles(split_rows(spark, sf))))


def trained_rf(spark, sf):
    """The forest search, whole, once per session and input folder."""
    from ..models.train import search_rf

    return _once(spark, (sf, "rf"), lambda: search_rf(_folds(spark, sf), model_roles(split_rows(spark, sf))))


def trained_gbt(spark, sf):
    """The boosting search, whole, once per session and input folder."""
    from ..models.train import search_gbt

    return _once(spark, (sf, "gbt"), lambda: search_gbt(_folds(spark, sf), model_roles(split_rows(spark, sf)), parts(spark, sf)[1]))


def trained(spark, sf) -> dict:
    """The three fitted models by name."""
    found = [f(spark, sf) for f in (trained_lr, trained_rf, trained_gbt)]
    return {r.name: r for r in found}


def _params_df(spark, res):
    rows = [(res.name, k, str(v)) for k, v in sorted(res.params.items())] + [(res.name, "cv_f1", repr(res.cv_f1))]
    return spark.createDataFrame(rows, "model string, param string, value string")


@query("train_lr")
def q_train_lr(spark, sf):
    """Best C and CV F1 of the logistic-regression grid search."""
    return _params_df(spark, trained_lr(spark, sf))


@query("train_rf")
def q_train_rf(spark, sf):
    """Best parameters and CV F1 of the random-forest random search."""
    return _params_df(spark, trained_rf(spark, sf))


@query("train_gbt")
def q_train_gbt(spark, sf):
    """Best parameters and CV F1 of the gradient-boosting search, and the
    trees kept after early stopping on the validation rows."""
    return _params_df(spark, trained_gbt(spark, sf))


@query("search")
def q_search(spark, sf):
    """Every evaluated parameter point of every search with its mean CV F1."""
    from ..models.train import fold_scores

    each = fold_scores(spark, trained(spark, sf))
    return each.groupBy("model", "point", "params").agg(F.avg("f1").alias("mean_cv_f1"), F.count("*").alias("n_folds"))


@query("paired_t_stub")
def q_paired_t_stub(spark, sf):
    """Paired t on the fold scores of the fitted models' best points, all
    searched on the same folds (the reference returns NaN here). Without
    any spread between two models there is no statistic."""
    from ..models.train import fold_scores
    from ..operators.stats import paired_t

    models = trained(spark, sf)
    best = spark.createDataFrame([(n, r.best_point()) for n, r in models.items()], "model string, point int")
    return paired_t(fold_scores(spark, models).join(best, ["model", "point"]), "model", "fold", "f1", list(models))


def model_predictions(spark, sf, split: str = "test") -> DataFrame:
    """Long predictions (model, customerID, label, probability, prediction)
    of every fitted model on a split: one union, one pass per model, written
    once, as the metrics read them several times."""
    from ..session import saved
    from .flow import predictions

    def make():
        data = dict(zip(("train", "val", "test"), parts(spark, sf)))[split]
        return saved(predictions(trained(spark, sf), data, "customerID", "Churn"), "models", "predictions")

    return _once(spark, (sf, "predictions", split), make)


def best_fitted(spark, sf):
    """The fitted model with the best test F1."""
    models = trained(spark, sf)

    def name():
        return M.best_model(M.comparison(model_predictions(spark, sf)), "f1_score", list(models)).first()["model"]

    return models[_once(spark, (sf, "best"), name)]


def by_model(models: dict, table) -> DataFrame:
    """``table(result)`` of every fitted model, with its name first."""
    out = None
    for name, r in models.items():
        t = table(r).select(F.lit(name).alias("model"), "*")
        out = t if out is None else out.unionByName(t)
    return out


@query("train_all")
def q_train_all(spark, sf):
    """CV F1 and test metrics of the three fitted models."""
    models = trained(spark, sf)
    cv = spark.createDataFrame([(n, float(r.cv_f1)) for n, r in models.items()], "model string, cv_f1 double")
    return cv.join(M.comparison(model_predictions(spark, sf)), "model")


def _importance(spark, r) -> DataFrame:
    from ..models.explain import linear_importance, tree_importance

    names = r.encoding.feature_names()
    return linear_importance(spark, r.model, names) if r.kind == "linear" else tree_importance(spark, r.nodes, r.kind, names)


@query("tree_importance")
def q_tree_importance(spark, sf):
    """Importances of both tree ensembles, ranked per model: a forest's
    impurity decreases, the booster's mean gains."""
    return by_model({n: r for n, r in trained(spark, sf).items() if r.kind != "linear"}, lambda r: _importance(spark, r))


def _contributions(spark, sf, r) -> DataFrame:
    """(customerID, contrib, base, margin) of every row, computed once."""
    from ..session import saved
    from .flow import contributions

    def make():
        return saved(contributions(r, parts(spark, sf)[0], split_rows(spark, sf), "customerID"), "models", "contributions")

    return _once(spark, (sf, "contributions", r.name), make)


def _summed(c: DataFrame) -> DataFrame:
    return c.select("customerID", "margin", "base", F.aggregate("contrib", F.lit(0.0), lambda a, v: a + v).alias("sum_contrib"))


@query("shap_linear")
def q_shap_linear(spark, sf):
    """Exact linear contributions for every row; their sum is the
    margin minus the margin at the training means."""
    return _summed(_contributions(spark, sf, trained_lr(spark, sf)))


@query("shap_tree")
def q_shap_tree(spark, sf):
    """Exact path-dependent attributions of both tree ensembles for every
    row: margin, base and the sum of the contributions, which is their
    difference."""
    return by_model({n: r for n, r in trained(spark, sf).items() if r.kind != "linear"}, lambda r: _summed(_contributions(spark, sf, r)))


@query("top_shap")
def q_top_shap(spark, sf):
    """Top ten mean absolute contributions of every fitted model."""
    from ..models.explain import top_contributors

    return by_model(trained(spark, sf), lambda r: top_contributors(_contributions(spark, sf, r), r.encoding.feature_names(), 10))


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    """AUC drop of every tree ensemble when one input column is permuted."""
    from ..models.explain import permutation_importance

    df = split_rows(spark, sf)
    roles, test = model_roles(df), parts(spark, sf)[2]
    return by_model({n: r for n, r in trained(spark, sf).items() if r.kind != "linear"},
                    lambda r: permutation_importance(r.model, test, [*roles.numeric, *roles.categorical], "customerID", "Churn"))


@query("explain_all")
def q_explain_all(spark, sf):
    """Importances and mean absolute contributions of all features of all
    models; 'best' is the best test F1."""
    from ..models.explain import top_contributors

    best = best_fitted(spark, sf).name

    def table(r):
        names = r.encoding.feature_names()
        shap = top_contributors(_contributions(spark, sf, r), names, len(names))
        return _importance(spark, r).join(shap, "feature").select("rank", "feature", "importance", "mean_abs_shap")

    return by_model(trained(spark, sf), table).withColumn("is_best", F.col("model") == best)


def saved_pipeline(spark, sf, r) -> str:
    """Path of a fitted model saved as one pipeline with its features."""
    from ..models.score import artefact

    def make():
        path = shared_path(spark, "models", r.name.replace(" ", "_"))
        artefact(r.model, training_spec(spark, sf)).write().overwrite().save(path)
        return path

    return _once(spark, (sf, "artefact", r.name), make)


@query("score")
def q_score(spark, sf):
    """Batch scoring of the whole table with the best model, loaded from its
    saved pipeline: probability, decision, band, gauge and the snapshot's
    risk-factor rules."""
    from ..models.score import decided
    from ..sources.results import load_model
    from .q_prep import snapshot_risk_rules

    model = load_model(saved_pipeline(spark, sf, best_fitted(spark, sf)))
    out = decided(model.transform(clean(spark, sf)), snapshot_risk_rules())
    return out.withColumn("risk_factors", F.concat_ws("; ", "risk_factors"))


@query(
    "defaults",
    with_base(
        "SELECT customerID, coalesce(TRY_CAST(CASE WHEN trim(TotalCharges) = '' THEN NULL ELSE TotalCharges END AS DOUBLE), "
        "MonthlyCharges * tenure) AS TotalCharges, 'Male' AS gender, 'Yes' AS PaperlessBilling FROM snap"
    ),
)
def q_defaults(spark, sf):
    """Form defaults for inputs the scoring form does not ask for; a
    missing total becomes monthly x tenure."""
    from ..models.score import FORM_DEFAULTS, with_defaults

    out = with_defaults(raw(spark, sf), FORM_DEFAULTS)
    return out.select("customerID", "TotalCharges", "gender", "PaperlessBilling")


@query(
    "home_kpis",
    with_base(
        "SELECT (SELECT count(*) FROM snap) AS total_customers, "
        "(SELECT round(accuracy, 6) FROM mets ORDER BY f1_score DESC, CASE model "
        + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(MODEL_ORDER)) + " END LIMIT 1) AS best_accuracy",
        METRICS_CTE,
    ),
)
def q_home_kpis(spark, sf):
    """Total customers (overview table) and the accuracy of the first row
    of the model comparison (F1 order)."""
    total = raw(spark, sf).agg(F.count(F.lit(1)).alias("total_customers"))
    best = M.best_model(M.comparison(formula_long(spark, sf)), "f1_score", MODEL_ORDER).select(F.round("accuracy", 6).alias("best_accuracy"))
    from ..operators.combine import one_row

    return one_row(total, best)


# --- sinks and sources ---------------------------------------------------------------
@query(
    "sink_tables",
    with_base(
        "SELECT 'churn_rates' AS table_name, count(*) AS n_rows FROM rates "
        "UNION ALL SELECT 'churn_distribution', count(DISTINCT Churn) FROM snap",
        RATES_CTE,
    ),
)
def q_sink_tables(spark, sf):
    """Write result tables (parquet) to the shared folder; read them back."""
    from ..operators import rates as R
    from ..sources.results import write_results, load_results

    base = shared_path(spark, "results")
    write_results({"churn_rates": R.rate_by_category(clean(spark, sf), "Churn", S.CATEGORICAL_COLUMNS),
                   "churn_distribution": R.target_dist(raw(spark, sf), "Churn")}, base)
    back = load_results(spark, base)
    rows = [(n, d.count()) for n, d in back.items()]
    return spark.createDataFrame(rows, "table_name string, n_rows long")


@query(
    "sink_pivots",
    with_base(
        "SELECT 'feature' AS kind, Feature AS name, count(*) AS n_rows FROM rates GROUP BY Feature "
        "UNION ALL SELECT 'pair', Feature_1 || ' x ' || Feature_2, count(*) FROM bfull GROUP BY Feature_1, Feature_2",
        RATES_CTE + "," + BIV_CTE,
    ),
)
def q_sink_pivots(spark, sf):
    """One rate table per feature and one cell table per bivariate pair:
    written partitioned by Feature and by (Feature_1, Feature_2), read back."""
    from ..operators import rates as R
    from .q_eda import BIV_PAIRS, _biv_frame

    fpath, ppath = shared_path(spark, "pivots"), shared_path(spark, "pair_pivots")
    R.rate_by_category(clean(spark, sf), "Churn", S.CATEGORICAL_COLUMNS).write.mode("overwrite").partitionBy("Feature").parquet(fpath)
    R.bivariate_cells(_biv_frame(spark, sf), "Churn", BIV_PAIRS).write.mode("overwrite").partitionBy("Feature_1", "Feature_2").parquet(ppath)
    feats = spark.read.parquet(fpath).groupBy("Feature").agg(F.count(F.lit(1)).alias("n_rows"))
    pairs = spark.read.parquet(ppath).groupBy("Feature_1", "Feature_2").agg(F.count(F.lit(1)).alias("n_rows"))
    return feats.select(F.lit("feature").alias("kind"), F.col("Feature").alias("name"), "n_rows").unionByName(
        pairs.select(F.lit("pair").alias("kind"), F.concat_ws(" x ", "Feature_1", "Feature_2").alias("name"), "n_rows")
    )


@query("load_results", with_base("SELECT * FROM rates", RATES_CTE))
def q_load_results(spark, sf):
    """Re-read a written result table (the report's input)."""
    from ..operators import rates as R
    from ..sources.results import load_results, write_results

    base = shared_path(spark, "results")
    write_results({"churn_rates": R.rate_by_category(clean(spark, sf), "Churn", S.CATEGORICAL_COLUMNS)}, base)
    return load_results(spark, base)["churn_rates"]


@query("sink_model")
def q_sink_model(spark, sf):
    """Save every fitted pipeline, load it back, and compare how it scores
    all rows with the fitted model (max |probability difference|)."""
    from pyspark.ml.functions import vector_to_array

    from ..sources.results import load_model

    def table(r):
        back = load_model(saved_pipeline(spark, sf, r))
        a = r.model.transform(split_rows(spark, sf)).select("customerID", vector_to_array("probability")[1].alias("p1"))
        b = back.transform(clean(spark, sf)).select("customerID", vector_to_array("probability")[1].alias("p2"))
        return a.join(b, "customerID").agg(F.lit(len(back.stages)).alias("n_stages"), F.count("*").alias("n_rows"), F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"))

    return by_model(trained(spark, sf), table)


@query("src_model")
def q_src_model(spark, sf):
    """Load every saved pipeline (absent path -> no model) and score the
    whole table with it."""
    from ..sources.results import load_model

    if load_model(shared_path(spark, "models", "absent")) is not None:
        raise RuntimeError("a model was loaded where none is saved")
    return by_model(trained(spark, sf), lambda r: load_model(saved_pipeline(spark, sf, r)).transform(clean(spark, sf)).select("customerID", "prediction"))


@query("src_app", with_base("SELECT * FROM snap"))
def q_src_app(spark, sf):
    """The raw customer file as the app reads it: written as CSV with a
    header, read back with the declared schema (blanks preserved)."""
    from ..sources.tables import load_customers

    path = shared_path(spark, "customers_csv")
    r = raw(spark, sf)
    (r.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return load_customers(spark, path, schema=r.schema, csv_options={"ignoreLeadingWhiteSpace": False,
                                                                     "ignoreTrailingWhiteSpace": False})


def _round_sql() -> str:
    def mag(e):
        return f"CASE WHEN abs({e}) < 1000 THEN round({e}, 2) ELSE round({e}, 1) END"

    def p(e):
        return f"CASE WHEN {e} < 0.0001 THEN CAST(printf('%.4e', {e}) AS DOUBLE) ELSE round({e}, 4) END"

    return f"""SELECT Contract, round(avg(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END) * 100, 2) AS churn_rate_pct,
  {mag('avg(TotalCharges)')} AS avg_total, {mag('avg(tenure)')} AS avg_tenure,
  {p('avg(MonthlyCharges) / 1e8')} AS small_p_value, {p('1.0 / count(*)')} AS large_p_value FROM clean GROUP BY Contract"""


@query("round_table", with_base(_round_sql()))
def q_round_table(spark, sf):
    """The table formatter: rate 2 dp; p-values 4 dp or five significant
    digits; other numbers 2 dp below 1000, else 1 dp."""
    df = clean(spark, sf).groupBy("Contract").agg(
        (F.avg(is_positive("Churn")) * 100).alias("churn_rate_pct"),
        F.avg("TotalCharges").alias("avg_total"),
        F.avg("tenure").alias("avg_tenure"),
        (F.avg("MonthlyCharges") / 1e8).alias("small_p_value"),
        (1 / F.count(F.lit(1))).alias("large_p_value"),
    )
    return C.round_table(df)


# --- ranking, top-k, evaluator definitions, the preprocessor --------------------------
@query(
    "rank_insert",
    with_base(
        "SELECT CAST(row_number() OVER (ORDER BY Churn_Rate_Percentage DESC, Feature, Category) AS INTEGER) AS Rank, "
        "Feature, Category, Churn_Rate_Percentage FROM rates",
        RATES_CTE,
    ),
)
def q_rank_insert(spark, sf):
    """Rank 1..n after the sort, on the reduced (feature, category) table;
    keys break ties so the ranking is stable."""
    from pyspark.sql import Window

    from ..operators import rates as R

    rates = R.rate_by_category(clean(spark, sf), "Churn", S.CATEGORICAL_COLUMNS)
    w = Window.orderBy(F.desc("Churn_Rate_Percentage"), "Feature", "Category")  # ~30 rows: bounded
    return rates.select(F.row_number().over(w).alias("Rank"), "Feature", "Category", "Churn_Rate_Percentage")


@query(
    "topk",
    with_base(
        "SELECT customerID, Churn, round(charge_per_month, 6) AS charge_per_month FROM feat "
        "ORDER BY charge_per_month DESC, customerID LIMIT 20",
        FEATURES_CTE,
    ),
)
def q_topk(spark, sf):
    """The 20 customers with the highest lifetime charge per month: a
    distributed top-k (each partition keeps 20, one small merge)."""
    from .q_prep import featured

    df = featured(spark, sf)
    top = df.orderBy(F.desc("charge_per_month"), "customerID").limit(20)
    return top.select("customerID", "Churn", F.round("charge_per_month", 6).alias("charge_per_month"))


@query(
    "scoring_defs",
    with_base(
        "SELECT model, round(CASE WHEN tp + fn > 0 THEN tp * 1.0::DOUBLE / (tp + fn) ELSE 0.0 END, 6) AS recall, "
        "round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1, "
        "round((tp + tn) * 1.0::DOUBLE / n, 6) AS accuracy FROM cnt",
        METRICS_CTE,
    ),
)
def q_scoring_defs(spark, sf):
    """The three search scorers (recall and F1 of the positive class,
    accuracy) as Spark ML evaluators, applied to each formula model."""
    from ..models.train import scoring_defs

    lp = formula_long(spark, sf).select(
        "model", F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")
    ).cache()
    rows = []
    for m in MODEL_ORDER:
        part = lp.where(F.col("model") == m)
        vals = {k: round(float(ev.evaluate(part)), 6) for k, ev in scoring_defs().items()}
        rows.append((m, vals["recall"], vals["f1"], vals["accuracy"]))
    return spark.createDataFrame(rows, "model string, recall double, f1 double, accuracy double")


def _preprocessor_sql() -> str:
    cat = ["Region", "Contract", "PaymentMethod", "InternetService", *K.SUPPORT_SERVICES, "tenure_group"]
    ks = " UNION ALL ".join(f"SELECT count(DISTINCT {c}) AS k FROM sp WHERE split = 'train'" for c in cat)
    return f"""SELECT split, count(*) AS n, (SELECT CAST(10 + sum(k - 1) AS INTEGER) FROM ({ks})) AS n_features,
  round(avg((SeniorCitizen - m) / s), 6) AS mean_slot0
FROM sp, (SELECT avg(SeniorCitizen) AS m, stddev_pop(SeniorCitizen) AS s FROM sp WHERE split = 'train') st
GROUP BY split"""


@query(
    "preprocessor",
    with_base(
        _preprocessor_sql(),
        FEATURES_CTE + "," + _split_sql(20, 20) + """,
sp AS (SELECT f.*, CASE WHEN c.r < c.n_test THEN 'test' WHEN c.r < c.n_test + c.n_val THEN 'val' ELSE 'train' END AS split
       FROM feat f JOIN cut c USING (customerID))""",
    ),
)
def q_preprocessor(spark, sf):
    """Fit the preprocessor on the training split only, transform every
    split: (split, rows, vector size, mean of the first scaled slot)."""
    from pyspark.ml.functions import vector_to_array

    df = _featured_split(spark, sf)
    train = df.where(F.col("split") == "train")
    enc = E.fit_encoding(train, model_roles(df), scale=True)
    out = E.encode(df, enc)
    a = vector_to_array("features")
    return out.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size(a)).alias("n_features"), F.round(F.avg(a[0]), 6).alias("mean_slot0")
    )


@query("score_stream")
def q_score_stream(spark, sf):
    """The same scoring as a Structured Streaming query: the table is
    written as files into the shared folder, a file-source stream scores
    them with the best model (trigger availableNow, checkpointed), and the
    scored rows are read from the files that the stream wrote."""
    import uuid

    from ..sources.results import load_model
    from ..streaming.score_stream import score_stream, stream_path
    from .q_prep import snapshot_risk_rules

    model = load_model(saved_pipeline(spark, sf, best_fitted(spark, sf)))
    src = shared_path(spark, "stream-in")
    clean(spark, sf).write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    name = f"attrix_scores_{uuid.uuid4().hex[:12]}"
    q = score_stream(spark, model, src, schema, query_name=name, rules=snapshot_risk_rules())
    q.awaitTermination()
    return spark.read.parquet(f"{stream_path(spark, name)}/out").withColumn("risk_factors", F.concat_ws("; ", "risk_factors"))
