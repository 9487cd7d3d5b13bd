"""Stratified split: disjoint, covering, exact per-class shares, and the
bucketed ranking path gives the same assignment."""

from pyspark.sql import functions as F

from attrix.operators.split import seeded_sample, stratified_split


def test_split_shares_and_paths(spark):
    rows = [(i, "Yes" if i % 4 == 0 else "No") for i in range(1000)]
    df = spark.createDataFrame(rows, "customerID long, Churn string")
    a = stratified_split(df, "Churn", "customerID", test_pct=20, val_pct=20)
    b = stratified_split(df, "Churn", "customerID", test_pct=20, val_pct=20, buckets=40)
    ca = {r.customerID: r.split for r in a.collect()}
    cb = {r.customerID: r.split for r in b.collect()}
    assert ca == cb and len(ca) == 1000
    counts = a.groupBy("Churn", "split").count().collect()
    got = {(r.Churn, r.split): r["count"] for r in counts}
    # 250 positives: 50 test, 50 val (ceil(200 * .25)), 150 train; 750 negatives: 150/150/450
    assert got == {("Yes", "test"): 50, ("Yes", "val"): 50, ("Yes", "train"): 150,
                   ("No", "test"): 150, ("No", "val"): 150, ("No", "train"): 450}


def test_sample_is_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    s1 = [r.k for r in seeded_sample(df, "k", 100).collect()]
    s2 = [r.k for r in seeded_sample(df.repartition(7), "k", 100).collect()]
    assert s1 == s2 and len(set(s1)) == 100
