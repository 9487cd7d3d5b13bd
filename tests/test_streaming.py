"""The fitted pipeline scores a stream exactly as it scores a table."""

import os
import tempfile

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from attrix.models import encode as E
from attrix.operators.features import fit_feature_params, snapshot_spec
from attrix.sources.snapshot import snapshot_cached
from attrix.streaming.score_stream import score_stream, stream_path

SF = "/root/testdata/sf0.001"


def test_stream_scoring_matches_batch(spark):
    from pyspark.ml import PipelineModel

    from attrix.models.score import artefact, score
    from attrix.operators.features import add_features

    base = snapshot_cached(spark, SF)
    spec = fit_feature_params(base, snapshot_spec())
    feats = add_features(base, spec, fit=False).withColumn("label", (F.col("Churn") == "Yes").cast("double"))
    roles = E.feature_roles(feats.drop("label"), "customerID", "Churn")
    enc = E.fit_encoding(feats, roles, scale=True)
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=50).fit(E.encode(feats, enc))
    model = PipelineModel([*E.preprocessor(enc).stages, lr])

    src = tempfile.mkdtemp(prefix="attrix-stream-src-")
    base.drop("customerID").withColumn("customerID", F.monotonically_increasing_id()).write.mode("overwrite").parquet(src + "/in")
    raw = spark.read.parquet(src + "/in")
    name = "scored_" + os.path.basename(src)

    def scored():
        score_stream(spark, artefact(model, spec), src + "/in", raw.schema, query_name=name).awaitTermination()
        return spark.read.parquet(stream_path(spark, name) + "/out")

    streamed = scored()
    batch = score(model, raw, spec)
    assert streamed.count() == batch.count() == base.count()
    d = streamed.join(batch, "customerID").select(F.max(F.abs(streamed.churn_probability - batch.churn_probability))).first()[0]
    assert d < 1e-12
    # restarted after more files have come: every row once
    raw.withColumn("customerID", F.col("customerID") + 10**15).write.mode("append").parquet(src + "/in")
    again = scored()
    assert again.count() == again.select("customerID").distinct().count() == 2 * base.count()
