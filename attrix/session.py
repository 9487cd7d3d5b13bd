"""Session helpers: building a local session for tests, and locating the
shared folder that cluster jobs write intermediate tables to."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "attrix") -> SparkSession:
    """A local session for tests and the bench. On a cluster, use the
    session the platform provides; nothing here depends on local mode."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only when none is configured (local tests)
    is a fresh folder under the temp dir set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # executors cannot see a folder on the driver's disk
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
        configured = tempfile.mkdtemp(prefix="attrix-ckpt-")  # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path inside the shared checkpoint folder, for tables that
    cut lineage or results that must outlive an executor."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "attrix", *parts, uuid.uuid4().hex])


def default_parallelism(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # Spark Connect has no SparkContext
        return int(os.environ.get("ATTRIX_PARALLELISM", "8"))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` would, once
    per application: functions inside tasks import it."""
    sc = spark.sparkContext
    if getattr(sc, "_attrix_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="attrix-py-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "attrix"), "zip", os.path.dirname(root), os.path.basename(root)))
    sc._attrix_shipped = True


def saved(df: DataFrame, *name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows
    neither recomputes it nor depends on the executors that made it."""
    path = shared_path(df.sparkSession, *name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
