"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on at most ``SAMPLE`` vectors; every vector is then
indexed under the leaf that its nearest children lead to. A query walks
the tree best bin first: a priority queue holds open nodes by the distance
of their centre, and leaves are visited in the order they are taken. The
number of leaves is widened until calibration queries, answered
exactly by a pass over all vectors, find the wanted share of their
neighbours; the leaves of a query also have to hold enough rows.

Large leaves are cut into bins of rows by a hash of the id, and the queries of a leaf
likewise, so a leaf with a third of all vectors is many small groups.

Vectors that are null, zero, of another length than the most frequent one,
or with null or non-finite components take no part, nor do rows without an
id. Rows with the query's own id are not its candidates. Ties go to the
smaller id. With fewer candidates than wanted all are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SAMPLE = 20_000  # vectors the tree is fitted on
BRANCH = 8  # children of a node
LEAF_SAMPLE = 100  # sampled vectors of a leaf, at most
HUGE = 1e100  # components beyond it are scaled before squaring
BIN_ROWS = 4096  # indexed rows, and queries, of one search group
CALIBRATION = 128  # queries answered exactly to set the visits
RECALL = 0.98  # of their neighbours, to be found by the visits chosen


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    return rows.where(F.size("v") == (top["d"] if top else 0))


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres)
        for c in range(k):
            own = x[near == c]
            if len(own):
                centres[c] = own.mean(axis=0)
    return centres, nearest(x, centres)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    x = np.clip(x, -HUGE, HUGE)
    return ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


class Tree:
    """Centres of nodes and their children; leaves are numbered."""

    def __init__(self, sample: np.ndarray, seed: int = 42):
        rng = np.random.default_rng(seed)
        sample = np.clip(sample, -HUGE, HUGE)  # places only; distances are those of the vectors
        self.children: list[list[int]] = [[]]
        self.centre: list[np.ndarray] = [sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])]
        todo = [(0, sample)]
        while todo:
            node, x = todo.pop()
            distinct = len(np.unique(x, axis=0)) if len(x) > LEAF_SAMPLE else 0
            if distinct <= BRANCH:
                continue
            centres, near = kmeans(x, BRANCH, rng)
            for c in range(BRANCH):
                if (near == c).any():
                    self.children[node].append(len(self.children))
                    todo.append((len(self.children), x[near == c]))
                    self.children.append([])
                    self.centre.append(centres[c])
        self.leaf = np.cumsum([not c for c in self.children]) - 1
        self.leaves = int(self.leaf[-1]) + 1
        self.below = [np.array([self.centre[c] for c in own]) for own in self.children]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        node = np.zeros(len(x), np.int64)
        level = {0}
        while level:
            following = set()
            for n in level:
                if self.children[n]:
                    rows = np.flatnonzero(node == n)
                    node[rows] = np.array(self.children[n])[nearest(x[rows], self.below[n])]
                    following |= set(self.children[n])
            level = following
        return self.leaf[node]

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        q = np.clip(q, -HUGE, HUGE)
        queue = [(0.0, 0)]
        while queue:
            _, n = heapq.heappop(queue)
            if not self.children[n]:
                yield int(self.leaf[n])
                continue
            for c, d in zip(self.children[n], ((self.below[n] - q) ** 2).sum(axis=1)):
                heapq.heappush(queue, (float(d), c))


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def closest(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """(query, id, distance) of each query's k nearest rows, ties to the
    smaller id. Huge components are scaled by a power of two first, so that
    no square overflows; a distance beyond the doubles is infinite."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    most = max(np.abs(x).max(initial=0.0), np.abs(q).max(initial=0.0))
    scale = 2.0 ** np.floor(np.log2(most)) if most > HUGE else 1.0
    x, q = x / scale, q / scale
    out = []
    for qi, v in zip(q_ids, q):
        d = np.sqrt(((x - v) ** 2).sum(axis=1))
        others = np.flatnonzero(ids != qi)
        if len(others) > k:
            edge = np.partition(d[others], k - 1)[k - 1]
            others = others[d[others] <= edge]
        near = others[np.argsort(d[others], kind="stable")][:k]
        with np.errstate(over="ignore"):
            out.append((np.full(len(near), qi), ids[near], d[near] * scale))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def exact(queries: list[tuple[int, list[float]]], rows: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score) of a bounded list of queries over all rows."""
    q_ids, q = np.array([r[0] for r in queries], np.int64), np.array([r[1] for r in queries], float)

    def run(batches):
        for batch in batches:
            if len(batch):
                a, b, d = closest(q_ids, q, batch.column(0).to_numpy(), matrix(batch.column(1)), k)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d)], names=["query_id", "id", "score"])

    return top(rows.select("id", "v").mapInArrow(run, "query_id long, id long, score double"), k)


def top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows of each row whose id
    is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    by_hash = rows.orderBy(F.xxhash64("id"), "id")
    sample = by_hash.limit(SAMPLE).toPandas()
    if not len(sample):
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_col), F.lit(0.0).alias("score")).limit(0)
    tree = spark.sparkContext.broadcast(Tree(np.stack(sample["v"].to_numpy()).astype(float)))

    def place(batches):
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tree.value.assign(matrix(batch.column(1))).astype(np.int32))], names=["id", "v", "leaf"])

    index = saved(rows.mapInArrow(place, "id long, v array<double>, leaf int"), "index")
    held = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # one row per leaf
    is_query = F.col("id") % every == 0

    # visits: widened until the calibration queries find enough
    trial = [(r["id"], r["v"]) for r in index.where(is_query).orderBy(F.xxhash64("id"), "id").limit(CALIBRATION).collect()]
    true = exact(trial, index, k).join(index.select("id", "leaf").distinct(), "id").select("query_id", "leaf").collect() if trial else []
    order = {i: {leaf: n for n, leaf in enumerate(tree.value.visits(np.array(v)))} for i, v in trial}
    needed = sorted(order[r["query_id"]][r["leaf"]] + 1 for r in true)
    visits = needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else tree.value.leaves

    def walk(batches):
        for batch in batches:
            ids, leaves, at = batch.column(0), [], []
            for i, q in enumerate(matrix(batch.column(1))):
                seen = 0
                for n, leaf in enumerate(tree.value.visits(q)):
                    if n >= visits and seen > k:
                        break
                    seen += held.get(leaf, 0)
                    leaves.append(leaf)
                    at.append(i)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64())), pa.array(leaves, pa.int32())], names=["id", "v", "leaf"])

    asked = index.where(is_query).select("id", "v").mapInArrow(walk, "id long, v array<double>, leaf int")
    asking = {r["leaf"]: r["count"] for r in asked.groupBy("leaf").count().collect()}  # one row per leaf
    bins = [(leaf, -(-n // BIN_ROWS), -(-asking.get(leaf, 0) // BIN_ROWS)) for leaf, n in held.items()]
    sizes = F.broadcast(spark.createDataFrame(bins, "leaf int, row_bins int, query_bins int"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = asked.join(sizes, "leaf").withColumn("q_bin", own("query_bins")).withColumn("r_bin", spread("row_bins")).select("leaf", "q_bin", "r_bin", "id", "v")
    right = index.join(sizes, "leaf").where("query_bins > 0").withColumn("r_bin", own("row_bins")).withColumn("q_bin", spread("query_bins")).select("leaf", "q_bin", "r_bin", "id", "v")
    group = ["leaf", "q_bin", "r_bin"]

    def search(queries: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(near):
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        a, b, d = closest(queries["id"].to_numpy(), np.stack(queries["v"].to_numpy()), near["id"].to_numpy(), np.stack(near["v"].to_numpy()), k)
        return pd.DataFrame({"query_id": a, "id": b, "score": d})

    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(search, "query_id long, id long, score double")
    best = top(found.distinct(), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
