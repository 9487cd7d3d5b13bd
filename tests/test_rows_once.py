"""Statistics that need their rows several times write them once: the
results do not go back to the input."""

from pyspark.sql import functions as F

from attrix.operators import stats as ST


def test_statistics_read_their_input_once(spark):
    n = F.col("id")
    df = spark.range(200).select(n.cast("string").alias("key"), F.when(n % 3 == 0, "Yes").otherwise("No").alias("y"), (n % 17).cast("double").alias("x"), (n % 4).cast("string").alias("a"), (n % 5).cast("string").alias("b"))
    found = {
        "mutual_info": ST.mutual_info(df, ["x"], "y", key="key"),
        "label_association": ST.label_association(df, "y", ["a", "b"]),
        "bivariate_table": ST.bivariate_table(df, "y", [("a", "b")]),
        "rank_tests": ST.rank_tests(df, ["x"], "y"),
    }
    for name, out in found.items():
        assert "Range (0, 200" not in out._jdf.queryExecution().executedPlan().toString(), name
        assert out.count() > 0
