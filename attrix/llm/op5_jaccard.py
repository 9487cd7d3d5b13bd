"""Size-aware heavy-light self-join on word shingles (Jaccard).

Documents with the same shingle set form a class; one of each class joins.
Two classes link when 100 * |intersection| >= percent * |union|.

* Light sets (at most ``boundary`` shingles) enumerate all subsets of a
  fixed size: a set of s elements shares with every equal or larger
  partner at least c(s) elements, so the smaller set's subsets of c(s)
  elements meet one of the larger set's.
* Heavy sets scan inverted lists. Elements have one global order, frequent
  ones last; a pair that links shares an element among the first
  n - ceil(t n) + 1 of the larger and n - ceil(2t/(1+t) n) + 1 of the
  smaller set, so only those enter the lists.
* The boundary minimises the counted cost: subsets made against list
  entries scanned, from the sizes and frequencies of all documents.

Within a list nobody is paired with everybody: each member is compared to
the list's first member and to the one before it, links are closed into
components, members of long lists that are still apart are compared to
their neighbours in a few shuffled orders, and only members of one list
that are in different components after that are compared each, of which
those that a parity bitmap of ``MARK_BITS`` bits rules out are no rows of
the join. Candidates lose first on the bound that parity bitmaps give (their
Hamming distance never exceeds the symmetric difference), then the rest are
counted exactly. Components need no other links, so none that matters is lost.

Null, empty and blank texts have no shingles and link with nothing; a text
of fewer words than the shingle size has its whole sequence as the one
shingle. Repeated rows count as one document; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import keyed
from .common import saved as written
from .graph import components

HOT_ELEMENTS = 1 << 18  # most elements of the broadcast order (12 bytes each)
DOCS_A_FILE = 5000  # documents for each of which tables get a file
COUNTED = 1 << 20  # elements that a task counts at once
LIGHT_MOST = 16  # sizes considered for the boundary
BROADCAST_KEYS = 1 << 20  # most document keys (8 bytes each) sent to the scan in place of a shuffle of the texts
BRIDGES = 8  # shuffled orders of a list, in which neighbours are compared
ROUNDS = 2  # of bridging, at most
LONG_LIST = 16  # members from which a list is bridged
MARK_BITS = 256  # of the bitmap that members of a list which are apart carry


def saved(df: DataFrame, name: str, docs: int | None = None) -> DataFrame:
    """Write and reread a table about so many documents, in no more files
    than they ask for (fewer than the shuffle's partitions where these are
    many and hold little)."""
    if docs is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-docs // DOCS_A_FILE)))
    return written(df, name)


def overlap_needed(a, b, percent: int):
    """Smallest intersection of linked sets of a and b elements."""
    return -(-percent * (a + b) // (100 + percent))


def subset_size(s: int, percent: int) -> int:
    return int(overlap_needed(s, s, percent))


def light_sizes(n: int, percent: int) -> range:
    """Sizes of the smaller partners of a set of n elements, itself included."""
    return range(max(1, -(-percent * n // 100)), n + 1)


def light_keys(n: int, percent: int) -> int:
    return sum(comb(n, subset_size(s, percent)) for s in light_sizes(n, percent) if subset_size(s, percent) <= n)


def prefixes(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries to look up, and of those the entries to index, for sets of n."""
    return n - -(-percent * n // 100) + 1, n - overlap_needed(n, n, percent) + 1


def set_block(raw, offsets, size):
    words = K.Words(raw, offsets)
    row, value = K.shingles(words, size)
    n = np.bincount(row, minlength=len(offsets) - 1)
    return row, value, n, np.concatenate([[0], np.cumsum(n)])


def frequent(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Counts of the elements that repeat among some ``COUNTED`` elements of
    a task, and the cost figures of small sets, both added up over all
    documents."""

    def counted(values: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
        value, n = np.concatenate(values), np.concatenate(sizes)
        every, at, count = np.unique(value, return_inverse=True, return_counts=True)
        often = count > 1
        small = np.flatnonzero((n > 0) & (n <= LIGHT_MOST))
        ends = np.cumsum(n)
        scan = {}
        for i in small:
            own = np.sort(count[at[ends[i] - n[i] : ends[i]]])
            look = int(prefixes(n[i], percent)[0])
            scan.setdefault(int(n[i]), []).append(int(own[:look].sum()))
        out_id = np.concatenate([every[often].view(np.int64), np.array(list(scan), np.int64)])
        out_n = np.concatenate([count[often], np.array([sum(x) for x in scan.values()], np.int64)])
        sets = np.concatenate([np.zeros(often.sum(), np.int64), np.array([len(x) for x in scan.values()], np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(out_id), pa.array(out_n.astype(np.int64)), pa.array(sets)], names=["id", "n", "sets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, sizes, held = [], [], 0
        for batch in batches:
            for _, _, raw, offsets in K.text_blocks(batch.column(0)):
                _, value, n, _ = set_block(raw, offsets, size)
                values.append(value)
                sizes.append(n)
                held += len(value)
                if held >= COUNTED:
                    yield counted(values, sizes)
                    values, sizes, held = [], [], 0
        if values:
            yield counted(values, sizes)

    found = docs.select("text").mapInArrow(run, "id long, n long, sets long")
    summed = saved(found.groupBy("id", (F.col("sets") > 0).alias("cost")).agg(F.sum("n").alias("n"), F.sum("sets").alias("sets")), "frequent")
    return summed.where("not cost").select("id", "n"), summed.where("cost").select(F.col("id").alias("size"), "n", "sets")


def order_of(counts: DataFrame, most: int = HOT_ELEMENTS) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent elements, at most ``most``, and their counts,
    sorted by element. Any order is right; this one keeps lists short."""
    levels = counts.groupBy(F.floor(F.log2("n") * 4).alias("level")).agg(F.count("*").alias("c")).collect()  # at most 4 * 64 rows
    least, held = 10**9, 0
    for level, c in sorted(((r["level"], r["c"]) for r in levels), reverse=True):
        held += c
        if held > most:
            break
        least = level
    rows = counts.where(F.floor(F.log2("n") * 4) >= least).toPandas()
    ids, n = rows["id"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int32)
    by = np.argsort(ids)
    return ids[by], n[by]


def boundary_of(costs: DataFrame, percent: int) -> int:
    """The boundary of least cost (0: no light sets)."""
    rows = {r["size"]: (r["n"], r["sets"]) for r in costs.collect()}  # at most LIGHT_MOST rows
    best, spent, boundary = 0, 0, 0
    for n in range(1, LIGHT_MOST + 1):
        scan, sets = rows.get(n, (0, 0))
        spent += sets * light_keys(n, percent) - scan
        if spent < best:
            best, boundary = spent, n
    return boundary


def signatures(docs: DataFrame, order, boundary: int, size: int, percent: int) -> DataFrame:
    """Per document: key, n, set name (two longs), parity bitmap, the same
    in ``MARK_BITS`` bits as longs, and the entries of its lists: list key and
    position * 2 + (1 if indexed)."""
    spark = docs.sparkSession
    hot = spark.sparkContext.broadcast(order)
    light_from = -(-percent * (boundary + 1) // 100)  # lights that a heavy set can link with enter the lists too

    def entries(value: np.ndarray, name: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(value)
        keys, places = [], []
        if n <= boundary:
            for s in light_sizes(n, percent):
                c = subset_size(s, percent)
                if c <= n:
                    picks = np.array(list(combinations(range(n), c)))
                    made = K.mix(name[picks].sum(axis=1, dtype=np.uint64) + np.uint64(s << 8 | 1))
                    keys.append(made)
                    places.append(np.full(len(made), int(s == n), np.int64))
        if n > boundary or n >= light_from:
            look, index = (int(x) for x in prefixes(np.int64(n), percent))
            by = np.lexsort((value, rank))[:look]
            if n <= boundary:
                by = by[:index]
            keys.append(value[by])
            at = np.arange(len(by))
            places.append(at * 2 + (at < index))
        return np.concatenate(keys), np.concatenate(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, freq = hot.value
        for batch in batches:
            for i, j, raw, offsets in K.text_blocks(batch.column(1)):
                row, value, n, at = set_block(raw, offsets, size)
                rank = np.zeros(len(value), np.int32)
                if len(ids):
                    spot = np.minimum(np.searchsorted(ids, value), len(ids) - 1)
                    is_hot = ids[spot] == value
                    rank[is_hot] = freq[spot[is_hot]]
                name = K.mix(value + K._C1)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (name, K.mix(name + K._C2))]
                one, two = (K.mix(s[at[1:]] - s[at[:-1]] + n.astype(np.uint64)) for s in sums)
                maps, keys, places = [], [], []
                odd = np.bincount(row * MARK_BITS + (name % np.uint64(MARK_BITS)).astype(np.int64), minlength=(j - i) * MARK_BITS).astype(np.uint8) & 1
                marks = np.packbits(odd, bitorder="little").view(np.int64)
                for r in range(j - i):
                    own = slice(at[r], at[r + 1])
                    if n[r]:
                        bits = np.zeros(max(64, 1 << int(n[r] - 1).bit_length()), np.uint8)
                        np.bitwise_xor.at(bits, (name[own] & np.uint64(len(bits) - 1)).astype(np.int64), 1)
                        maps.append(np.packbits(bits, bitorder="little").tobytes())
                        k, p = entries(value[own], name[own], rank[own])
                    else:
                        maps.append(b"")
                        k, p = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                    keys.append(k)
                    places.append(p)
                ends = np.zeros(j - i + 1, np.int32)
                np.cumsum([len(k) for k in keys], out=ends[1:])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(n.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(maps, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * (MARK_BITS // 64)), pa.array(marks)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys).view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(places).astype(np.int32))),
                ], names=["key", "n", "one", "two", "bits", "marks", "lists", "places"])

    return docs.select("key", "text").mapInArrow(run, "key long, n int, one long, two long, bits binary, marks array<long>, lists array<long>, places array<int>")


def bitmap_passes(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b, bits_a, bits_b) that the bitmaps don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, ma, mb = (batch.column(i) for i in range(6))
            na_, nb_ = na.to_numpy(), nb.to_numpy()
            most = na_ + nb_ - 2 * overlap_needed(na_.astype(np.int64), nb_.astype(np.int64), percent)
            keep = np.zeros(len(batch), bool)
            for k in range(len(batch)):
                x, y = np.frombuffer(ma[k].as_py(), np.uint8), np.frombuffer(mb[k].as_py(), np.uint8)
                if len(x) < len(y):
                    x, y = y, x
                while len(x) > len(y):
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                keep[k] = int(np.bitwise_count(x ^ y).sum()) <= most[k]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in (a, b, na, nb)], names=["a", "b", "na", "nb"])

    return pairs.select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(run, "a long, b long, na int, nb int")


def linked(pairs: DataFrame, docs: DataFrame, size: int, percent: int, n: int) -> DataFrame:
    """Pairs (a, b) that link, counted on the full sets. The texts of the
    documents in question are joined once; few enough keys go to the scan."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offsets in K.text_blocks(batch.column(1)):
                _, value, _, at = set_block(raw, offsets, size)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([value[at[r] : at[r + 1]].tobytes() for r in range(j - i)], pa.binary())], names=["key", "elements"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for k in range(len(batch)):
                x, y = (np.frombuffer(batch.column(c)[k].as_py(), np.uint64) for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[k] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in (0, 1)], names=["a", "b"])

    nodes = saved(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct(), "nodes", n)
    if nodes.count() <= BROADCAST_KEYS:
        nodes = F.broadcast(nodes)
    texts = docs.select("key", "text").join(nodes, "key", "left_semi").dropDuplicates(["key"])
    table = saved(texts.mapInArrow(sets, "key long, elements binary"), "sets", n)
    left, right = (table.select(F.col("key").alias(c), F.col("elements").alias(f"set_{c}")) for c in "ab")
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(count, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    rows, _ = keyed(docs, id_col, text_col)
    sized = rows.select("key", "id").join(key_components(rows, size, percent), "key")
    names = rows.select(F.col("key").alias("component"), F.col("id").alias("component_id")).distinct()
    return sized.join(names, "component").select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component: the smallest id's (null
    first), of equal ids that of the smaller text, and of rows that equal it
    in both the first by the other columns in order."""
    rows, unique = keyed(docs, id_col, text_col, carry=True)
    kept = key_components(rows, size, percent).where("key = component").select("key")
    rows = rows.join(kept, "key", "left_semi")
    if not unique:
        first = Window.partitionBy("key").orderBy("row")
        rows = rows.withColumn("nth", F.row_number().over(first)).where("nth = 1")
    return rows.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def key_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, n, component), all distinct, of ``keyed`` rows: set size and the
    smallest key reachable."""
    counts, costs = frequent(docs, size, percent)
    boundary = boundary_of(costs, percent)
    rows = saved(signatures(docs, order_of(counts), boundary, size, percent), "signatures")

    n_docs = rows.count()
    classes = saved(rows.where("n > 0").groupBy("n", "one", "two").agg(F.min("key").alias("rep")), "classes", n_docs)
    first = rows.where("n > 0").join(classes.select(F.col("rep").alias("key")), "key", "left_semi").dropDuplicates(["key"])
    entry = first.select("key", "n", F.explode(F.arrays_zip("lists", "places")).alias("e")).select(
        F.col("e.lists").alias("list"), (F.col("n").cast("long") * 2**32 + F.col("e.places")).alias("at"), "key")
    by_size = Window.partitionBy("list").orderBy("at", "key")
    here = F.struct("at", "key")
    indexed = F.when(F.col("at") % 2 == 1, here)
    ahead = by_size.rowsBetween(Window.unboundedPreceding, -1)
    lists = entry.withColumns({"p": F.lag("key").over(by_size), "q": F.lead("key").over(by_size)}).where("p is not null or q is not null")
    lists = lists.select("list", "at", "key", F.first(indexed, True).over(ahead).alias("c"), F.last(indexed, True).over(ahead).alias("l"))
    lists = saved(lists, "lists", n_docs)

    def candidates(pairs: DataFrame) -> DataFrame:
        """Distinct pairs of (at, key) structs x (smaller) and y that size and position allow."""
        n = lambda c: F.shiftright(F.col(f"{c}.at"), 32)
        left = lambda c: n(c) - F.shiftright(F.col(f"{c}.at").bitwiseAND(2**32 - 1), 1)
        need = F.ceil(percent * (n("x") + n("y")) / (100.0 + percent) - 1e-9)
        light = (n("x") <= boundary) & (n("y") <= boundary)
        fits = (n("x") * 100 >= n("y") * percent) & (light | (F.least(left("x"), left("y")) >= need))
        return pairs.where(fits).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).where("a <> b").distinct()

    bits = first.select("key", "n", "bits")
    sides = [bits.select(F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab"]

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        close = saved(bitmap_passes(pairs.join(sides[0], "a").join(sides[1], "b"), percent), f"{name}-close", n_docs)
        return saved(linked(close, docs, size, percent, n_docs), f"{name}-links", n_docs)

    y = F.struct("at", "key").alias("y")
    star = lists.select(F.col("c").alias("x"), y).unionByName(lists.select(F.col("l").alias("x"), y)).where("x is not null")
    tried = saved(candidates(star), "tried", n_docs)
    links = verified(tried, "star")
    found = components(links)

    # members of one list that are still apart
    def open_lists() -> DataFrame:
        label = found.select(F.col("node").alias("key"), "component")
        marked = saved(lists.select("list", "at", "key").join(label, "key", "left").withColumn("component", F.coalesce("component", "key")), "marked", n_docs)
        apart = marked.groupBy("list").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("list", "n")
        return saved(marked.join(apart, "list"), "open", n_docs)

    # long lists: neighbours in shuffled orders first, so that large groups close
    # without comparing all their members
    for turn in range(ROUNDS):
        open_ = open_lists()
        long = open_.where(F.col("n") >= LONG_LIST)
        if not long.limit(1).count():
            break
        salts = F.explode(F.array(*[F.lit(turn * BRIDGES + i) for i in range(BRIDGES)]))
        order = Window.partitionBy("list", "salt").orderBy(F.xxhash64("key", "salt"))
        own = F.struct("at", "key", "component")
        step = long.withColumn("salt", salts).select(own.alias("x"), F.lag(own).over(order).alias("y")).where("y is not null and x.component <> y.component")
        step = step.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x.at % 2 = 1")
        more = saved(candidates(step).join(tried, ["a", "b"], "left_anti"), "bridges", n_docs)
        tried = saved(tried.unionByName(more), "tried", n_docs)
        new = verified(more, "bridge")
        if not new.limit(1).count():
            break
        # what is known to be connected enters as its stars
        found = components(new.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    open_ = open_lists()
    longs = range(MARK_BITS // 64)
    open_ = open_.join(first.select("key", *[F.get("marks", F.lit(i)).alias(f"m{i}") for i in longs]), "key")
    x = open_.where("at % 2 = 1").select("list", F.struct("at", "key").alias("x"), F.col("component").alias("cx"), *[F.col(f"m{i}").alias(f"mx{i}") for i in longs])
    z = open_.select("list", F.struct("at", "key").alias("y"), F.col("component").alias("cy"), *[F.col(f"m{i}").alias(f"my{i}") for i in longs])
    cross = x.join(z, "list").where("cx <> cy and shiftright(x.at, 32) <= shiftright(y.at, 32)")
    both = F.shiftright("x.at", 32) + F.shiftright("y.at", 32)
    differ = sum((F.bit_count(F.col(f"mx{i}").bitwiseXOR(F.col(f"my{i}"))) for i in longs[1:]), F.bit_count(F.col("mx0").bitwiseXOR(F.col("my0"))))
    cross = cross.where(differ <= both - 2 * F.ceil(percent * both / (100.0 + percent) - 1e-9))
    more = candidates(cross).join(tried, ["a", "b"], "left_anti")
    more_links = verified(saved(more, "more", n_docs), "cross")
    found = components(more_links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    ids = rows.where("n > 0").select("key", "n", "one", "two").join(classes, ["n", "one", "two"]).select("key", "rep")
    label = found.select(F.col("node").alias("rep"), "component")
    top = ids.join(label, "rep", "left").select("key", F.coalesce("component", "rep").alias("component")).distinct()
    return rows.select("key", "n").distinct().join(top, "key", "left").withColumn("component", F.coalesce("component", "key"))


#: DuckDB SQL of the same rows.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN coalesce(len(l), 0) = 0 THEN []::VARCHAR[] WHEN len(l) < 5 THEN [array_to_string(l, ' ')]
  ELSE [array_to_string(l[i:i+4], ' ') FOR i IN range(1, len(l) - 3)] END) AS e FROM w),
n AS (SELECT doc_id, len(e)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(e) AS g FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
k AS MATERIALIZED (SELECT o.a, o.b FROM o JOIN n p ON p.doc_id = o.a JOIN n q ON q.doc_id = o.b WHERE 100 * c >= 75 * (p.n + q.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, k.b FROM r JOIN k ON k.a = r.b)
SELECT n.doc_id, n.n AS n_shingles, m.c AS component_id FROM n JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = n.doc_id
"""
