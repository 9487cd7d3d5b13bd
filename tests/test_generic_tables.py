"""The operators are generic: run them on the second binary-label table
(labels joined to documents) and check them against pandas brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from attrix.operators.rates import rate_by_category
from attrix.operators.stats import label_association, rank_tests
from attrix.sources.tables import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    labels = read_table(spark, SF, "labels", ["doc_id", "toxic"])
    documents = read_table(spark, SF, "documents", ["doc_id", "lang", "source", "n_chars"])
    df = labels.join(documents, "doc_id").withColumn("toxic_label", F.when(F.col("toxic") == 1, "Yes").otherwise("No"))
    return df, df.toPandas()


def test_rates_on_documents(docs):
    df, pdf = docs
    got = rate_by_category(df, "toxic_label", ["lang", "source"]).toPandas()
    for feat in ["lang", "source"]:
        exp = pdf.groupby(feat).toxic.agg(["count", "sum"])
        part = got[got.Feature == feat].set_index("Category")
        assert dict(part.Total_Count) == dict(exp["count"])
        assert dict(part.Churn_Count) == dict(exp["sum"])


def test_rank_tests_on_documents(docs):
    df, pdf = docs
    t = rank_tests(df, ["n_chars"], "toxic_label").first()
    x, y = pdf.n_chars.to_numpy(float), pdf.toxic.to_numpy()
    ranks = pd.Series(x).rank(method="average").to_numpy()
    n1 = y.sum()
    assert t.MannWhitney_U == pytest.approx(ranks[y == 1].sum() - n1 * (n1 + 1) / 2)
    grid = np.unique(x)
    d = max(abs((x[y == 1] <= g).mean() - (x[y == 0] <= g).mean()) for g in grid)
    assert t.KS_Statistic == pytest.approx(d)


def test_association_on_documents(docs):
    df, pdf = docs
    a = label_association(df, "toxic_label", ["lang"]).first()
    obs = pd.crosstab(pdf.lang, pdf.toxic).to_numpy(float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    dof = (obs.shape[0] - 1) * (obs.shape[1] - 1)
    corr = 0.5 if dof == 1 else 0.0
    chi2 = ((np.maximum(np.abs(obs - exp) - corr, 0)) ** 2 / exp).sum()
    assert a.chi2 == pytest.approx(chi2) and a.dof == dof
