"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


EDGES_A_FILE = 500_000  # edges are written in as many files as this asks for


def in_files(e: DataFrame, edges: int) -> DataFrame:
    """Write and reread a round's edges, which are no more than ``edges``."""
    parts = int(e.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return saved(e.coalesce(max(1, min(parts, -(-edges // EDGES_A_FILE)))), "edges")


def stars(e: DataFrame, n: int) -> DataFrame:
    """One large-star and one small-star step on ``n`` edges (u > v)."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = in_files(e.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), n)
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    # each smaller neighbour v links to the smallest m, and so does u itself
    pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
    return large.join(low, "u").select(F.inline(pairs)).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long);
    component is the smallest node reachable.

    Large-star and small-star steps (Kiveris et al. 2014): every node links
    its larger, then its smaller neighbours to the smallest one it knows,
    until nothing changes. Minima are aggregates with map-side combine, so
    a node with many links needs no group in one task; each round is
    written to the shared folder."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = saved(e, "edges")
    n, before = e.count(), None
    while True:
        e = in_files(stars(e, n), 2 * n)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, n = state, state[0]
    roots = e.select(F.col("v").alias("u")).distinct().join(e.select("u"), "u", "left_anti")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select(F.col("u").alias("node"), F.col("u").alias("component")))
