"""Shared helpers of the llm operators."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path, ship  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages
    neither recompute it nor depend on the executors that made it."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark deletes them once
    the driver has collected their plans, which in a driver with room to
    spare may be long after. A single collection leaves the last plan."""
    for _ in range(2):
        gc.collect()  # Python's handles of the plans
        spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base += "_"
    return base


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> tuple[DataFrame, bool]:
    """``docs`` as (key long, id, text), and whether the keys are unique:
    one key per distinct (id, text), ordered by id (null first) and text.
    With ``carry`` the whole row without its text comes along as ``row``.

    With unique non-null integer ids the key is the id. Otherwise the
    distinct (id, md5 of text) are numbered by a range sort with partition
    offsets; repeated rows share a key and so count as one document."""
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")] if carry else []
    cols = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *rest)
    names = ["key", *cols.columns]
    ids = cols.groupBy("id").agg(F.count("*").alias("n"))
    odd = ids.where("n > 1 or id is null").limit(1).count()
    if not odd:
        return cols.withColumn("key", F.col("id")).select(*names), True
    mark = F.md5(F.coalesce("text", F.lit("")))
    distinct = saved(cols.select("id", mark.alias("mark")).distinct(), "keys")
    ranged = distinct.repartitionByRange(F.col("id").asc_nulls_first(), F.col("mark")).withColumn("part", F.spark_partition_id())
    ranged = saved(ranged, "ranged")  # fixes the partition of every row
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    w = Window.partitionBy("part").orderBy(F.col("id").asc_nulls_first(), "mark")
    numbered = ranged.join(F.broadcast(before), "part").select("id", "mark", (F.col("base") + F.row_number().over(w) - 1).alias("key"))
    right = numbered.select(F.col("id").alias("id_"), F.col("mark").alias("mark_"), "key")
    return cols.withColumn("mark", mark).join(right, F.col("id").eqNullSafe(F.col("id_")) & (F.col("mark") == F.col("mark_"))).select(*names), False
