"""Centroid clustering over zone maps in the order of a space-filling curve.

Vectors are turned into integers and sorted by Spark along a Hilbert curve
through the components that spread most. Consecutive vectors form blocks
with a box (least and greatest value of every component). In a round, the
distances from a centroid to the nearest and the farthest point of a box
bound its distance to every vector of the block: centroids whose nearest
point is farther than another centroid's farthest point can't be nearest to
any of them. A block with one candidate adds its stored sums; the vectors
of other blocks are compared with the candidates exactly, all at once.

Everything is integer arithmetic: a component x is floor(scale * x), held
to +-2^27 so that squared distances fit 64 bits (distances of a cluster or
of all are added as decimals and held to the largest long). Ties go to the
smaller centroid; a centroid without vectors stays.

Vectors that are null, of another length, or with null or non-finite
components take no part. Repeated rows are vectors each, and rows without
an id are clustered but don't start centroids. With fewer vectors than
centroids every vector with an id starts one; without any, vectors are
not clustered and no row comes back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
BLOCK_ROWS = 256
CURVE_DIMENSIONS = 8  # components the curve runs through
CURVE_BITS = 7  # of each, so that a place on the curve fits a long
LARGEST = 1 << 27
_EXACT = 1 << 23  # below it, sums of 64 squares are exact in doubles


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (rows, dimensions),
    every cell number below 2 ** bits. The curve's orientation in each
    dimension is undone bit by bit from the top; a Gray code of what is
    left, interleaved, is the place."""
    x = x.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            up = (x[:, d] >> level & 1).astype(bool)
            swap = np.where(up, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(up, low, swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn[:, None]
    place = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            place = place << 1 | (x[:, d] >> level & 1)
    return place


def kept(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id long, q array<int>) of the vectors that take part."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.size("v") == dimensions).where(F.coalesce(fine, F.lit(False)))
    held = lambda x: F.least(F.greatest(F.floor(x * float(scale)), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int")
    return rows.select("id", F.transform("v", held).alias("q"))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dimensions)


def blocks(vectors: DataFrame, dimensions: int = DIMENSIONS, rows_per_block: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of :func:`kept` rows in curve order: ids array<long>, q binary
    (int32 by row), low, high and total array<long> by component."""
    spread = vectors.agg(*[F.stddev_pop(F.col("q")[i].cast("double")).alias(f"s{i}") for i in range(dimensions)],
                         *[F.min(F.col("q")[i]).alias(f"a{i}") for i in range(dimensions)],
                         *[F.max(F.col("q")[i]).alias(f"b{i}") for i in range(dimensions)]).first()
    most = sorted(range(dimensions), key=lambda i: (-(spread[f"s{i}"] or 0.0), i))[:CURVE_DIMENSIONS]
    least = np.array([spread[f"a{i}"] or 0 for i in most], np.int64)
    width = np.maximum(np.array([spread[f"b{i}"] or 0 for i in most], np.int64) - least + 1, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot = TaskContext.get().partitionId() << 40
        for batch in batches:
            x = matrix(batch.column(1), dimensions)[:, most].astype(np.int64)
            on_curve = hilbert(((x - least) << CURVE_BITS) // width, CURVE_BITS)
            spots = np.arange(spot, spot + len(batch))
            spot += len(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(on_curve), pa.array(spots)], names=["id", "q", "place", "spot"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        rows: list[np.ndarray] = []
        held = 0

        def close(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, rows, held
            if not held:
                return
            own, x = pa.chunked_array(ids).combine_chunks(), np.concatenate(rows)
            whole = held if last else held // rows_per_block * rows_per_block
            starts = np.arange(0, whole, rows_per_block)
            ends = np.append(starts[1:], whole)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, whole).astype(np.int32)), own.slice(0, whole))
            stats = [f(x[:whole].astype(np.int64), starts, axis=0) for f in (np.minimum.reduceat, np.maximum.reduceat, np.add.reduceat)]
            flat = lambda m: pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), dimensions).cast(pa.list_(pa.int64()))
            q = pa.array([x[a:b].astype("<i4").tobytes() for a, b in zip(starts, ends)], pa.binary())
            yield pa.RecordBatch.from_arrays([lists, q, *map(flat, stats)], names=["ids", "q", "low", "high", "total"])
            ids, rows, held = ([own.slice(whole)], [x[whole:]], held - whole) if whole < held else ([], [], 0)

        for batch in batches:
            if len(batch):
                ids.append(batch.column(0))
                rows.append(matrix(batch.column(1), dimensions).astype(np.int32))
                held += len(batch)
                if held >= 8 * rows_per_block:
                    yield from close(False)
        yield from close(True)

    placed = vectors.mapInArrow(place, "id long, q array<int>, place long, spot long")
    order = ["place", F.xxhash64("id"), "spot"]  # equal vectors and repeated rows spread over ranges
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "q")
    return saved(ranged.mapInArrow(cut, "ids array<long>, q binary, low array<long>, high array<long>, total array<long>"), "blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(blocks, centroids): whether a centroid can be nearest to a vector in
    a block's box. ``low`` and ``high`` are (blocks, components)."""
    out = np.empty((len(low), len(centroids)), bool)
    step = max(1, (1 << 20) // max(1, centroids.size))
    for i in range(0, len(low), step):
        a, b = low[i : i + step, None, :], high[i : i + step, None, :]
        outside = np.maximum(np.maximum(a - centroids, centroids - b), 0)
        across = np.maximum(centroids - a, b - centroids)
        near, far = (outside * outside).sum(axis=2), (across * across).sum(axis=2)
        out[i : i + step] = near <= far.min(axis=1, keepdims=True)
    return out


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(rows, centroids) squared distances, exact."""
    if len(x) and max(np.abs(x).max(), np.abs(centroids).max()) < _EXACT // x.shape[1]:
        a, c = x.astype(float), centroids.astype(float)
        return ((a * a).sum(axis=1)[:, None] - 2 * a @ c.T + (c * c).sum(axis=1)).astype(np.int64)
    out = np.empty((len(x), len(centroids)), np.int64)
    for k, c in enumerate(centroids):
        gap = x.astype(np.int64) - c
        out[:, k] = (gap * gap).sum(axis=1)
    return out


def assign(x: np.ndarray, possible: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row; ``possible``: candidates, ascending."""
    d = distances(x, centroids[possible])
    best = d.argmin(axis=1)  # the first of equal ones
    return possible[best], d[np.arange(len(x)), best]


def moved(parts: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over the blocks."""
    k, dimensions = centroids.shape
    shared = parts.sparkSession.sparkContext.broadcast(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        n, total = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            able = candidates(matrix(batch.column(2), dimensions), matrix(batch.column(3), dimensions), c)
            rows = np.diff(batch.column(0).offsets.to_numpy())
            alone = able.sum(axis=1) == 1
            only = able.argmax(axis=1)[alone]
            np.add.at(n, only, rows[alone])
            np.add.at(total, only, matrix(batch.column(4), dimensions)[alone])
            for b in np.flatnonzero(~alone):
                x = np.frombuffer(batch.column(1)[b].as_buffer(), "<i4").reshape(-1, dimensions)
                own, _ = assign(x, np.flatnonzero(able[b]), c)
                for j in np.unique(own):
                    n[j] += (own == j).sum()
                    total[j] += x[own == j].sum(axis=0, dtype=np.int64)
        used = np.flatnonzero(n)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(total[used].ravel()), dimensions).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), lists], names=["cluster", "n", "total"])

    found = parts.select("ids", "q", "low", "high", "total").mapInArrow(sums, "cluster int, n long, total array<long>")
    wide = found.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(dimensions)])
    out = centroids.copy()
    for row in wide.collect():  # a row per centroid
        out[row["cluster"]] = [int(row[f"t{i}"]) // row["n"] for i in range(dimensions)]
    return out


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
              dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster int, distance long) of every vector that takes part,
    the centroids after ``rounds`` rounds). The first centroids are the
    vectors whose ids hash least under ``seed``."""
    spark = vectors.sparkSession
    rows = saved(kept(vectors, id_col, vector_col, dimensions, scale), "vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.where("id is not null").orderBy(name, "q").select("q").limit(clusters).collect()
    if not first:
        return rows.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), np.zeros((0, dimensions), np.int64)
    centroids = np.array([r["q"] for r in first], np.int64)
    parts = blocks(rows, dimensions)
    for _ in range(rounds):
        centroids = moved(parts, centroids)
    shared = spark.sparkContext.broadcast(centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            able = candidates(matrix(batch.column(2), dimensions), matrix(batch.column(3), dimensions), shared.value)
            own = [assign(np.frombuffer(batch.column(1)[b].as_buffer(), "<i4").reshape(-1, dimensions), np.flatnonzero(able[b]), shared.value) for b in range(len(batch))]
            if own:
                cluster, distance = map(np.concatenate, zip(*own))
                yield pa.RecordBatch.from_arrays([batch.column(0).flatten(), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    found = parts.select("ids", "q", "low", "high").mapInArrow(last, "id long, cluster int, distance long")
    return found.withColumnRenamed("id", id_col), centroids


def listing(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Rows of :func:`clustered` with ``cluster_inertia``, ``inertia`` and
    the digest of the final centroid."""
    from hashlib import sha256

    spark = found.sparkSession
    found = saved(found, "clustered")
    longest = (1 << 63) - 1
    held = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    total = min(sum(held.values()), longest)
    facts = [(k, min(held.get(k, 0), longest), total, sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for k, c in enumerate(centroids)]
    per = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # a row per centroid
    return found.join(F.broadcast(per), "cluster").select(*found.columns, "cluster_inertia", "inertia", "centroid_sha256")


# the same in SQL, distances and all
ORACLE = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), q) - 1 AS cluster, q AS c
  FROM vectors WHERE vec_id IS NOT NULL QUALIFY cluster < 16),
""" + "".join(f"""
near{r} AS (
  SELECT vec_id, q, cluster, d FROM (
    SELECT v.vec_id, v.q, v.spot, c.cluster, list_sum(list_transform(list_zip(v.q, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM (SELECT *, row_number() OVER () AS spot FROM vectors) v, c{r} c)
  QUALIFY row_number() OVER (PARTITION BY spot ORDER BY d, cluster) = 1),
""" + (f"""
s{r} AS (
  SELECT cluster, i, sum(q[i]) AS s, count(*) AS n FROM near{r}, generate_series(1, 64) g(i) GROUP BY cluster, i),
m{r} AS (
  SELECT cluster, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY cluster),
c{r + 1} AS (
  SELECT cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster)),
""" if r < ROUNDS else "") for r in range(ROUNDS + 1)) + f"""
result AS (
  SELECT vec_id, CAST(n.cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
    CAST(sum(d) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.c, ',')) AS centroid_sha256
  FROM near{ROUNDS} n JOIN c{ROUNDS} c USING (cluster))
SELECT * FROM result"""
