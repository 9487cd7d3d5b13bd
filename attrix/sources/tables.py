"""Readers for the driver's parquet tables and for customer files.

Column lists are passed to ``select`` right after the scan, so the parquet
reader only decodes those columns (``ReadSchema`` in the plan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


# Raw customer-file schema (the flat attrition CSV). Numbers that may hold
# blanks are read as strings and converted by the cleaner.
CUSTOMER_FILE_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.StringType()),
        T.StructField("Churn", T.StringType()),
    ]
)


def _exists(spark: SparkSession, path: str) -> bool:
    if "://" not in path or path.startswith("file:"):
        return os.path.exists(path.replace("file:", "", 1))
    jvm = spark.sparkContext._jvm  # remote stores: ask Hadoop
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_customers(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   csv_options: dict | None = None) -> DataFrame:
    """Read a customer file (CSV with header, or parquet) with a declared
    schema; fail early when it is missing. Used for the raw (EDA) view and
    the training view alike: cleaning is a separate operator."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"Data file not found at {path}")
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.schema(schema or CUSTOMER_FILE_SCHEMA).option("header", True)
    for k, v in (csv_options or {}).items():
        reader = reader.option(k, v)
    return reader.csv(path)
