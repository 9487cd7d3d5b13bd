"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k smallest 63-bit hashes of a text's distinct word
shingles, in order; with fewer shingles it holds all and is exact. The
sketch of a union is the k smallest of both sketches, so sketches merge
across parts of a document or of a corpus in any grouping. From two
sketches follow resemblance, containment and distinct counts.

Null, empty and blank texts have an empty sketch; two empty ones resemble
each other fully, an empty and another one not at all. A text with fewer
words than a shingle has its whole sequence as the one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from . import kernels as K
from .common import keyed

K_SMALLEST = 128
SHINGLE = 5
RANGE_BYTES = 64 << 20  # of text in a range of documents, about


def block_sketches(raw: np.ndarray, offsets: np.ndarray, k: int, size: int) -> list[np.ndarray]:
    row, value = K.shingles(K.Words(raw, offsets), size)
    at = np.searchsorted(row, np.arange(len(offsets)))
    value = (value >> np.uint64(1)).view(np.int64)
    out = []
    for a, b in zip(at, at[1:]):
        own = value[a : min(b, a + 2 * k)]  # halving can make two neighbours equal
        own = own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own
        out.append(own[:k])
    return out


def list_array(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)))


def with_sketch(df: DataFrame, text_col: str = "text", out_col: str = "sketch", k: int = K_SMALLEST, size: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch (array of long) of a text column. No shuffle."""
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c != out_col], F.col(f"`{text_col}`").cast("string").alias("__text"))
    names = [*rows.columns[:-1], out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offsets in K.text_blocks(batch.column(len(names) - 1)):
                own = [batch.column(c).slice(i, j - i) for c in range(len(names) - 1)]
                yield pa.RecordBatch.from_arrays([*own, list_array(block_sketches(raw, offsets, k, size))], names=names)

    schema = StructType([*rows.schema.fields[:-1], StructField(out_col, ArrayType(LongType()))])
    return rows.mapInArrow(run, schema)


def merged(df: DataFrame, group: list[str], sketch_col: str = "sketch", k: int = K_SMALLEST) -> DataFrame:
    """One sketch per group: the k smallest distinct values of its rows.
    Row number limits apply on the map side, so no group is gathered. A
    group of empty sketches has an empty sketch."""
    values = df.select(*group, F.explode_outer(sketch_col).alias("__v")).distinct()
    nth = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("__v").asc_nulls_last()))
    least = values.withColumn("__n", nth).where(F.col("__n") <= k)
    return least.groupBy(*group).agg(F.array_sort(F.collect_list("__v")).alias(sketch_col))


def distinct_count(sketch: Column, k: int = K_SMALLEST) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    top = F.element_at(sketch, k).cast("double")
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(F.lit((k - 1) * 2.0**63) / top)


def resemblance(a: Column, b: Column, k: int = K_SMALLEST) -> Column:
    """Estimated Jaccard similarity of the two shingle sets."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, k: int = K_SMALLEST) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    common = resemblance(a, b, k) * distinct_count(union, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(common / distinct_count(a, k), F.lit(1.0)))


def fingerprint(sketch: Column) -> Column:
    """A sketch as text: 16 hex digits per value."""
    return F.array_join(F.transform(sketch, lambda v: F.lpad(F.hex(v), 16, "0")), "")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K_SMALLEST, size: int = SHINGLE) -> DataFrame:
    """Per row: id, n_chars, ``edited`` (the last half of the characters
    replaced by as many from the start of the next document, the first one
    following the last), and the sketches of the text, the edited text and
    the next document.

    One exchange: documents go to ranges of ids, and the first document of
    each range also goes to the range before it. Ranges come from id
    quantiles; their first ids (one per range) are all the driver sees.
    Repeated rows are one document; rows of one id with different texts
    follow each other by text."""
    spark = docs.sparkSession
    docs, _ = keyed(docs, id_col, text_col)
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // RANGE_BYTES))
    cuts = sorted(set(docs.approxQuantile("key", [i / ranges for i in range(1, ranges)], max(0.2 / ranges, 1e-5))))
    splits = [-float("inf"), *(cuts or [0.0]), float("inf")]  # an empty table has no quantiles
    ranged = Bucketizer(splits=splits, inputCol="at", outputCol="range").transform(docs.withColumn("at", F.col("key").cast("double")))
    ranged = ranged.select("key", "id", "text", F.col("range").cast("int").alias("range"))
    heads = [(r["key"], r["range"]) for r in ranged.groupBy("range").agg(F.min("key").alias("key")).orderBy("key").collect()]
    # (first key, range before, whether it closes the circle)
    before = [(key, heads[i - 1][1], int(i == 0)) for i, (key, _) in enumerate(heads)]
    links = F.broadcast(spark.createDataFrame(before, "key long, back int, tail int"))
    here = F.struct(F.col("range").alias("range"), F.lit(0).alias("tail"), F.lit(False).alias("only_next"))
    back = F.when(F.col("back").isNotNull(), F.struct(F.col("back").alias("range"), F.col("tail"), F.lit(True).alias("only_next")))
    dealt = ranged.join(links, "key", "left").select("key", "id", "text", F.explode(F.filter(F.array(here, back), lambda x: x.isNotNull())).alias("to"))
    dealt = dealt.select("to.range", "to.tail", "to.only_next", "key", "id", "text").repartition(ranges, "range")
    dealt = dealt.sortWithinPartitions("range", "tail", "key")

    def results(rows: list, following: str) -> pa.RecordBatch:
        """rows: (id, text, repeats) in order; following: the text after them."""
        texts = [t for _, t, _ in rows]
        after = [*texts[1:], following]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, after)]
        sketches = []
        for _, _, raw, offsets in K.text_blocks(pa.array([*texts, following, *edited], pa.large_string())):
            sketches += block_sketches(raw, offsets, k, size)
        m = len(rows)
        pick = np.repeat(np.arange(m), [n for _, _, n in rows])
        column = lambda values, kind: pa.array([values[i] for i in pick], kind)
        lists = lambda start: list_array([sketches[start + i] for i in pick])
        return pa.RecordBatch.from_arrays(
            [column([r for r, _, _ in rows], pa.int64()), column([len(t) for t in texts], pa.int64()), column(edited, pa.string()), lists(0), lists(m + 1), lists(1)],
            names=["id", "n_chars", "edited", "sketch", "edited_sketch", "next_sketch"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list = []  # consecutive documents of one range
        held, last = 0, None
        for batch in batches:
            for i in range(len(batch)):
                range_, only_next, key, id_, text = (batch.column(c)[i].as_py() for c in (0, 2, 3, 4, 5))
                text = text or ""
                if last is not None and last[0] == range_ and last[1] == key and not only_next:
                    waiting[-1][2] += 1
                    continue
                if waiting and last[0] != range_:
                    waiting = []  # not reached: every range ends with the document after it
                if waiting and (only_next or held >= K.BLOCK_BYTES):
                    yield results(waiting, text)
                    waiting, held = [], 0
                if not only_next:
                    waiting.append([id_, text, 1])
                    held += len(text)
                last = (range_, key)

    out = dealt.mapInArrow(run, "id long, n_chars long, edited string, sketch array<long>, edited_sketch array<long>, next_sketch array<long>")
    return out.withColumnRenamed("id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of :func:`with_next` rows."""
    return found.select(
        id_col, "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_count(F.col("sketch")).alias("n_shingles"),
    )
