"""Random forest of a binary label over all rows.

Every tree draws each row a Poisson number of times and every node the
features it tries, both as functions of the seed, so any task can repeat
them. Large nodes are split level by level for all trees at once: tasks
count classes by (tree, node, feature, bin), Spark adds the counts and
finds each node's split where its counts meet. As soon as a node holds at
most ``local_rows`` rows, these go to one task, which grows the rest of the
tree below it. The nodes of the forest stay a table.

Parameters: n_estimators, max_depth (None: unlimited), min_samples_split,
min_samples_leaf, max_features (sqrt, log2 or a number). Rows of a class
weigh n / (2 n_c).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved, ship
from . import trees as T
from .binned import byte_column, byte_rows

LOCAL_ROWS = 50_000
MOST_TOP_NODES = 100_000  # split on counts; beyond, tasks get larger nodes
AT_ONCE = 16  # trees whose rows a task holds before it sends them

NODES = "tree int, id int, feature int, threshold double, left int, right int, n long, w0 double, w1 double, gain double"


def read_tree(table: pa.Table, bins: T.Bins, points: list[dict]) -> tuple[tuple[np.ndarray, ...], int, list[np.ndarray]]:
    """(arrays, depth, per point the share of class 1 by node) of the nodes
    (by id) of one tree that ``points`` share."""
    feature, threshold, left, right, n, w0, w1 = (table.column(c).to_numpy() for c in ("feature", "threshold", "left", "right", "n", "w0", "w1"))
    cut = np.full(len(feature), -1)
    for f in np.unique(feature[feature >= 0]):
        own = feature == f
        cut[own] = np.searchsorted(bins.cuts[f], threshold[own], "left")
    # a class is there if it has weight
    tree = T.Tree(*(c.tolist() for c in (feature, cut, left, right)), list(zip(n.tolist(), (w0 > 0).astype(int).tolist(), (w1 > 0).astype(int).tolist())))
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.where(w0 + w1 > 0, w1 / (w0 + w1), 0.0)
    return tree.arrays(), tree.depth(), [value[end] for end in T.ends(tree, points)]


def grown(rows: DataFrame, bins: T.Bins, p: dict, seed: int = 42, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """The nodes (``NODES``) of a forest on ``binned`` rows that don't
    validate: rows, class weights and impurity decrease (by weight) of every
    node; leaves have feature -1. Children come after their parents."""
    spark = rows.sparkSession
    ship(spark)
    sc = spark.sparkContext
    rows = rows.where("not val").select("rid", "y", "b")
    width, n_trees = len(bins.cuts), p["n_estimators"]
    held = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n = sum(held.values())
    classes = np.array([n / (2 * max(held.get(c, 0), 1)) for c in (0, 1)])
    local_rows = max(local_rows, -(-n * n_trees // MOST_TOP_NODES))

    def drawn(batch: pa.RecordBatch, tree: int) -> tuple[np.ndarray, np.ndarray]:
        times = T.poisson_one(T.uniform(seed, 4, tree, batch.column("rid").to_numpy()))
        own = np.flatnonzero(times)
        return own, times[own]

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((n_trees, 3), np.int64)
        for batch in batches:
            y = batch.column("y").to_numpy()
            for t in range(n_trees):
                own, times = drawn(batch, t)
                out[t] += (len(own), times[y[own] == 0].sum(), times[y[own] == 1].sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_trees)), *(pa.array(out[:, c]) for c in range(3))], names=["tree", "n", "k0", "k1"])

    sums = [F.sum(c).alias(c) for c in ("n", "k0", "k1")]
    tops = [T.Tree() for _ in range(n_trees)]
    found = {r["tree"]: (r["n"], r["k0"], r["k1"]) for r in rows.mapInArrow(roots, "tree long, n long, k0 long, k1 long").groupBy("tree").agg(*sums).collect()}
    for t, top in enumerate(tops):
        top.add(found.get(t, (0, 0, 0)))
    paths = [[np.uint64(0)] for _ in tops]
    depths = [[0] for _ in tops]
    level = [(t, 0) for t in range(n_trees)]
    while True:
        level = [(t, k) for t, k in level if tops[t].stats[k][0] > local_rows and T.may_split(tops[t].stats[k], depths[t][k], p)]
        if not level:
            break
        by_tree: dict[int, list[tuple[int, int]]] = {}
        for s, (t, k) in enumerate(level):
            by_tree.setdefault(t, []).append((k, s))
        orders = {t: T.drawn_order(seed, t, np.array([paths[t][k] for k, _ in own]), width) for t, own in by_tree.items()}
        given = sc.broadcast({t: (tops[t].arrays(), tops[t].depth(), own, orders[t]) for t, own in by_tree.items()})

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                b, y = byte_rows(batch, "b", width), batch.column("y").to_numpy()
                for t, (arrays, depth, own_nodes, order) in given.value.items():
                    own, times = drawn(batch, t)
                    at = T.descend(arrays, b[own], depth)
                    local = np.full(len(arrays[0]), -1)
                    local[[k for k, _ in own_nodes]] = np.arange(len(own_nodes))
                    here = local[at]
                    own, times, here = own[here >= 0], times[here >= 0], here[here >= 0]
                    slots = np.array([s for _, s in own_nodes])
                    key = ((slots[here] * width)[:, None] + np.arange(width)) * T.MAX_BINS + b[own[:, None], order[here]]
                    key, inverse = np.unique(key, return_inverse=True)
                    each = [np.bincount(inverse.ravel(), weights=np.repeat(v.astype(float), width), minlength=len(key)).astype(np.int64)
                            for v in (np.ones(len(own)), times * (y[own] == 0), times * (y[own] == 1))]
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), *map(pa.array, each)], names=["key", "n", "k0", "k1"])

        tried = T.features_tried(p["max_features"], width)
        all_orders = sc.broadcast({s: orders[t][i] for t, own in by_tree.items() for i, (_, s) in enumerate(own)})

        def best(table: pa.Table) -> pa.Table:
            key = table.column("key").to_numpy()
            by = np.argsort(key)
            counts = np.stack([table.column(c).to_numpy()[by] for c in ("n", "k0", "k1")], axis=1)
            slot = int(key[0] // (width * T.MAX_BINS))
            (got,) = T.gini_best(key[by] - slot * width * T.MAX_BINS, counts, all_orders.value[slot][None], tried, p, classes)
            got = [] if got is None else [(slot, got[0], got[1], got[2], *got[3], *got[4])]
            return pa.table({c: pa.array([g[i] for g in got], pa.float64() if c == "gain" else pa.int64()) for i, c in enumerate(SPLIT)})

        keyed = rows.mapInArrow(counted, "key long, n long, k0 long, k1 long").groupBy("key").agg(*sums)
        keyed = keyed.withColumn("slot", F.floor(F.col("key") / F.lit(width * T.MAX_BINS)))
        splits = keyed.groupBy("slot").applyInArrow(best, ", ".join(f"{c} {'double' if c == 'gain' else 'long'}" for c in SPLIT)).collect()
        following = []
        for r in sorted(splits, key=lambda r: r["slot"]):
            t, k = level[r["slot"]]
            for side, child in enumerate(tops[t].split(k, r["feature"], r["cut"], r["gain"], tuple(r[c] for c in SPLIT[4:7]), tuple(r[c] for c in SPLIT[7:]))):
                paths[t].append(T.child_path(paths[t][k], side)[0])
                depths[t].append(depths[t][k] + 1)
                following.append((t, child))
        level = following

    # the rows below each open node go to one task
    open_nodes = [(t, k) for t, top in enumerate(tops) for k in range(len(top.feature)) if top.feature[k] < 0 and T.may_split(top.stats[k], depths[t][k], p)]
    opened: dict[int, list[tuple[int, int]]] = {}
    for s, (t, k) in enumerate(open_nodes):
        opened.setdefault(t, []).append((k, s))
    shared = sc.broadcast({t: (tops[t].arrays(), tops[t].depth(), own) for t, own in opened.items()})
    begun = sc.broadcast([(t, paths[t][k], depths[t][k]) for t, k in open_nodes])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, y = byte_rows(batch, "b", width), batch.column("y").to_numpy()
            parts: list[tuple] = []
            for i, (t, (arrays, depth, own_nodes)) in enumerate(shared.value.items()):
                own, times = drawn(batch, t)
                slot = np.full(len(arrays[0]), -1)
                slot[[k for k, _ in own_nodes]] = [s for _, s in own_nodes]
                s = slot[T.descend(arrays, b[own], depth)]
                parts.append((s[s >= 0], y[own][s >= 0], times[s >= 0], own[s >= 0]))
                if len(parts) == AT_ONCE or i + 1 == len(shared.value):
                    s, ys, ts, at = (np.concatenate(c) for c in zip(*parts))
                    yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(ys.astype(np.int32)), pa.array(ts.astype(np.int32)), byte_column(b[at])], names=["slot", "y", "times", "b"])
                    parts = []

    def finish(table: pa.Table) -> pa.Table:
        slot = table.column("slot")[0].as_py()
        tree, path, depth = begun.value[slot]
        chunks = [(byte_rows(c, "b", width), c.column("y").to_numpy(), c.column("times").to_numpy().astype(np.int64)) for c in table.to_batches() if len(c)]
        b, y, times = (np.concatenate(c) for c in zip(*chunks))
        own = T.grow_forest_tree(b, y, times, p, seed, tree, classes, path, depth)
        return pa.table({"slot": [slot], "tree": pa.array([tree], pa.int32()), **{k: pa.array([v], pa.list_(t)) for k, v, t in columns_of(own)}})

    def columns_of(tree: T.Tree) -> list[tuple]:
        k = np.array(tree.stats, np.int64)
        whole = k[:, 1] * classes[0] + k[:, 2] * classes[1]
        threshold = [float(bins.cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
        gain = np.asarray(tree.gain) / np.maximum(whole, 1e-300)
        return [("feature", tree.feature, pa.int32()), ("threshold", threshold, pa.float64()), ("left", tree.left, pa.int32()), ("right", tree.right, pa.int32()),
                ("n", k[:, 0].tolist(), pa.int64()), ("w0", (k[:, 1] * classes[0]).tolist(), pa.float64()), ("w1", (k[:, 2] * classes[1]).tolist(), pa.float64()), ("gain", gain.tolist(), pa.float64())]

    below = rows.mapInArrow(sent, "slot long, y int, times int, b binary").groupBy("slot").applyInArrow(
        finish, "slot long, tree int, feature array<int>, threshold array<double>, left array<int>, right array<int>, n array<long>, w0 array<double>, w1 array<double>, gain array<double>")
    below = saved(below, "models", "subtrees")

    # numbers: a subtree's root is the open node, its others follow the top and the subtrees before
    tree_sizes = [len(top.feature) for top in tops]
    place = spark.createDataFrame([(s, k, tree_sizes[t]) for s, (t, k) in enumerate(open_nodes)], "slot long, root int, base int")
    earlier = Window.partitionBy("tree").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    begins = below.select("slot", "tree", F.size("feature").alias("size")).join(place, "slot")
    begins = begins.select("slot", "root", (F.col("base") + F.coalesce(F.sum(F.col("size") - 1).over(earlier), F.lit(0)) - 1).cast("int").alias("base"))
    lists = ["feature", "threshold", "left", "right", "n", "w0", "w1", "gain"]
    each = below.join(begins, "slot").select("tree", "root", "base", F.posexplode(F.arrays_zip(*lists)).alias("at", "node"))
    number = lambda c: F.when(c == 0, F.col("root")).when(c < 0, c).otherwise(c + F.col("base")).cast("int")
    lower = each.select("tree", number(F.col("at")).alias("id"), "node.feature", "node.threshold", number(F.col("node.left")).alias("left"),
                        number(F.col("node.right")).alias("right"), "node.n", "node.w0", "node.w1", "node.gain")
    gone = set(open_nodes)
    upper = [(t, k, *(v[k] for _, v, _ in columns)) for t, top in enumerate(tops) for columns in [columns_of(top)] for k in range(len(top.feature)) if (t, k) not in gone]
    return saved(lower.unionByName(spark.createDataFrame(upper, NODES)), "models", "nodes")


SPLIT = ["slot", "gain", "feature", "cut", "ln", "l0", "l1", "rn", "r0", "r1"]
