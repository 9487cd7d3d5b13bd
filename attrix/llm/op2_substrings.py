"""Exact substring deduplication by distributed prefix doubling.

A byte goes if it lies in a ``length``-byte string that also starts
earlier: in a smaller document, or earlier in the same one.

Names of byte strings are built by doubling (the name of 2L bytes is the
name of the pair at p and p + L). Spark sorts (name, longer name, document,
position) rows and re-ranks the rows that are still tied at a greater
length, until they are unique or have reached ``length`` bytes:

* Round 0 has one row per anchor. The anchor of a ``length``-byte window is
  the position of its smallest ``k``-byte name, so equal windows have equal
  anchors, and a row stands for all windows of one anchor. Rows whose
  k-byte name is unique drop out. Of rows with equal whole extents
  all but the earliest are repeats.
* What is left tied on the shorter but not on the longer name goes on to
  round 1 in groups of ``STEP`` windows (the shorter name then covers the
  bytes all of them share, nearly ``length``), and to round 2 in single windows.

Rows are sorted, not gathered: a task reads its sorted rows as a stream and
holds one open row of a group, however large. Equal extents
are first reduced inside each batch. The text is shuffled once, by
document, and that exchange serves every round and the result.

Null texts are empty and have no spans; texts shorter than ``length`` stay
whole. Repeated rows (equal id and text) are one document; rows of one id
with different texts are ordered by text. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import free_name, keyed, release, saved

STEP = 8  # windows of a row in round 1
ROW = "core long, full long, key long, place long"
_POSITION = np.uint64((1 << 30) - 1)


def anchor_length(length: int) -> int:
    """Bytes of the names that anchors are chosen by."""
    return max(1, length * 36 // 100)


def place_of(start, lead, count):
    """Packed (first window, distance of its start to the anchor, windows)."""
    return (start << 24) | (lead << 12) | count


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 24, (place >> 12) & 4095, place & 4095


def windows_by_anchor(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Of a block: (row, first window, anchor, windows, k-byte names)."""
    k = anchor_length(length)
    name = K.names(raw, k)
    w = length - k + 1
    n = len(name) - w + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, name
    tagged = (name & ~_POSITION) | np.arange(len(name), dtype=np.uint64)
    anchor = (K.window_min(tagged, w) & _POSITION).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    p = np.flatnonzero(np.arange(n) + length <= offsets[1:][row])
    a, row = anchor[p], row[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(p)))
    return row[first], p[first], a[first], count, name


def extent_name(name: np.ndarray, first: np.ndarray, last: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Name of the bytes from window ``first`` to window ``last``; the two
    windows overlap, so with the shape they determine all bytes."""
    return K.pair_name(K.pair_name(name[first], name[last]), shape.astype(np.uint64))


def batch_of(core, full, key, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(full.view(np.int64)), pa.array(key), pa.array(place)], names=["core", "full", "key", "place"])


def first_round(docs: DataFrame, length: int) -> DataFrame:
    """One row per anchor. Inside a batch only the earliest of equal extents
    stays; the rest are known repeats and pass on as complements (negative
    places) under scattered names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            parts = []
            for i, j, raw, offsets in K.text_blocks(batch.column(1)):
                row, start, anchor, count, name = windows_by_anchor(raw, offsets, length)
                if len(row):
                    lead = anchor - start
                    full = extent_name(K.names(raw, length), start, start + count - 1, (lead << 12) | count)
                    parts.append((name[anchor], full, keys[i:j][row], place_of(start - offsets[row], lead, count)))
            if not parts:
                continue
            core, full, key, place = (np.concatenate(x) for x in zip(*parts))
            by = np.lexsort((place, key, full, core))
            core, full, key, place = core[by], full[by], key[by], place[by]
            again = np.zeros(len(core), bool)
            again[1:] = (core[1:] == core[:-1]) & (full[1:] == full[:-1])
            core[again] = K.pair_name(key[again].view(np.uint64), place[again].view(np.uint64))
            place[again] = ~place[again]
            yield batch_of(core, full, key, place)

    return docs.select("key", "text").mapInArrow(run, ROW)


def later_round(tied: DataFrame, length: int, step: int) -> DataFrame:
    """Rows of groups of ``step`` windows. ``tied``: key, text, places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places = batch.column(0).to_numpy(), batch.column(2)
            for i, j, raw, offsets in K.text_blocks(batch.column(1)):
                lists = places.slice(i, j - i)
                sizes = np.array([len(x) for x in lists], np.int64)
                place = lists.flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(j - i), sizes)
                start, lead, count = unpacked(place)
                at = start + offsets[row]
                # the bytes of each extent, one after another
                span = count + length - 1
                ends = np.cumsum(span)
                if not len(ends):
                    continue
                base = ends - span
                own = raw[np.arange(ends[-1]) - np.repeat(base - at, span)]
                whole = K.names(own, length)
                shared = K.names(own, length - step + 1)
                # one window after another, then cut where the group changes
                w_ends = np.cumsum(count)
                unit = np.repeat(np.arange(len(count)), count)
                i_th = np.arange(w_ends[-1]) - np.repeat(w_ends - count, count)
                r = lead[unit] - i_th
                group = r // step
                new = np.ones(len(unit), bool)
                new[1:] = (unit[1:] != unit[:-1]) | (group[1:] != group[:-1])
                f = np.flatnonzero(new)
                n = np.diff(np.append(f, len(unit)))
                u = unit[f]
                first = base[u] + i_th[f]
                g = group[f]
                core = K.pair_name(shared[base[u] + lead[u] - step * g] if step > 1 else whole[first], g.astype(np.uint64))
                if step > 1:
                    full = extent_name(whole, first, first + n - 1, (r[f] << 12) | n)
                else:
                    half = K.names(own, length // 2)
                    full = K.pair_name(half[first], half[first + length - length // 2])
                yield batch_of(core, full, keys[i:j][row[u]], place_of(start[u] + i_th[f], r[f], n))

    rest = [c for c in tied.columns if c not in ("key", "text", "places")]  # the exchange below it keeps one shape
    return tied.select("key", "text", "places", *rest).mapInArrow(run, ROW)


def ranked(rows: DataFrame) -> DataFrame:
    """(key, place, repeat): rows that repeat an earlier extent, and the
    earliest rows of extents that are tied on the shorter name only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core_, full_, many, held = None, None, False, None
        for batch in batches:
            core, full, key, place = (batch.column(i).to_numpy() for i in range(4))
            known = place < 0
            out_key, out_place, out_repeat = [key[known]], [~place[known]], [np.ones(known.sum(), bool)]
            core, full, key, place = core[~known], full[~known], key[~known], place[~known]
            if len(core):
                new = np.ones(len(core), bool)
                new[1:] = core[1:] != core[:-1]
                new[0] = core_ is None or core[0] != core_
                fresh = new.copy()
                fresh[1:] |= full[1:] != full[:-1]
                fresh[0] |= full[0] != full_
                out_key.append(key[~fresh])
                out_place.append(place[~fresh])
                out_repeat.append(np.ones((~fresh).sum(), bool))
                reps = np.flatnonzero(fresh)
                group = np.cumsum(new)[reps]  # 0: the group open from the batch before
                size = np.bincount(group, minlength=int(new.sum()) + 1)
                if size[0]:
                    if held is not None:
                        out_key.append(held[0])
                        out_place.append(held[1])
                        out_repeat.append(np.zeros(1, bool))
                        held = None
                    many = True
                tied = size[group] > 1
                tied[group == 0] = True
                out_key.append(key[reps[tied]])
                out_place.append(place[reps[tied]])
                out_repeat.append(np.zeros(tied.sum(), bool))
                if new.any():  # the last group stays open
                    many = size[-1] > 1
                    held = None if many else (key[reps[-1:]], place[reps[-1:]])
                core_, full_ = core[-1], full[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_key, out_place, out_repeat)], names=["key", "place", "repeat"])

    return rows.repartition("core").sortWithinPartitions("core", "full", "key", "place").mapInArrow(run, "key long, place long, repeat boolean")


def removed(docs: DataFrame, length: int) -> DataFrame:
    """id, n_bytes, spans (array of start, end), kept (binary; null for a
    null text), and ``row`` where it is carried."""
    rest = [c for c in docs.columns if c not in ("id", "text", "places")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            places = batch.column(2)
            for i, j, raw, offsets in K.text_blocks(batch.column(1)):
                spans, kept = [], []
                for r in range(i, j):
                    own = raw[offsets[r - i] : offsets[r - i + 1]]
                    if places[r].is_valid and len(places[r]):
                        start, _, count = unpacked(places[r].values.to_numpy())
                        depth = np.zeros(len(own) + 1, np.int32)
                        np.add.at(depth, np.minimum(start, len(own)), 1)
                        np.add.at(depth, np.minimum(start + count + length - 1, len(own)), -1)
                        gone = np.cumsum(depth) > 0
                        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone])))
                        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                        kept.append(own[~gone[:-1]].tobytes())
                    else:
                        spans.append([])
                        kept.append(own.tobytes())
                n = pa.array(np.diff(offsets).astype(np.int64))
                columns = [batch.column(0).slice(i, j - i), n, pa.array(spans, kind), pa.array(kept, pa.binary()), *(batch.column(3 + c).slice(i, j - i) for c in range(len(rest)))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "spans", "kept", *rest])

    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields)
    out = docs.select("id", "text", "places", *rest).mapInArrow(run, "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary" + extra)
    return out.drop("key")


def repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, carry: bool = False) -> DataFrame:
    """Per row: id, ``n_bytes``, ``spans`` removed (byte start and end,
    maximal runs) and ``kept`` (the remaining bytes, concatenated). With
    ``carry`` also ``row``, the other columns."""
    if not 16 <= length <= 4000:
        raise ValueError("length must be from 16 to 4000 bytes")
    spark = docs.sparkSession
    every, unique = keyed(docs, id_col, text_col, carry)
    every = every.where("key is not null")  # always so; said here, it is the same in every use of the exchange
    once = every if unique else every.dropDuplicates(["key"])
    release(spark)
    marks = saved(ranked(first_round(once, length)), "substrings")
    release(spark)  # the rows of the first round, the largest exchange

    # one exchange of the texts; Spark reuses it in each join below
    by_key = every.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key")

    def with_places(found: DataFrame, how: str) -> DataFrame:
        return by_key.join(found.groupBy("key").agg(F.collect_list("place").alias("places")), "key", how)

    tied = marks.where("not repeat")
    repeats = marks.where("repeat").select("key", "place")
    for step in (STEP, 1):
        rows = with_places(tied, "inner")
        if not unique:
            rows = rows.dropDuplicates(["key"])
        found = ranked(later_round(rows, length, step))
        repeats = repeats.unionByName(found.where("repeat").select("key", "place"))
        tied = found.where("not repeat")
    return removed(with_places(repeats, "left"), length).withColumnRenamed("id", id_col)


def with_kept_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, keep_null: bool = False) -> DataFrame:
    """``docs`` with the remaining text in place of the text, without the
    documents of which nothing remains. A character of which some bytes went
    is left out; a text that nothing was removed from stays as it was, empty
    ones included. A null text becomes empty, or stays null (``keep_null``)."""
    marked = docs.withColumn(null_col := free_name(docs, "was_null"), F.col(f"`{text_col}`").isNull())
    found = repeated_substrings(marked, id_col, text_col, length, carry=True)
    # bytes that are no full character decode to U+FFFD only where a cut is
    text = F.when(F.is_valid_utf8(F.col("kept").cast("string")), F.col("kept").cast("string"))
    text = F.coalesce(text, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\uFFFD", ""))
    found = found.withColumn("left", text).where((F.size("spans") == 0) | (F.col("left") != ""))
    text = F.when(~F.col(f"row.`{null_col}`"), F.col("left")) if keep_null else F.col("left")
    return found.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of :func:`repeated_substrings` rows."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return found.select(id_col, "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
