"""Token ids in binary files.

Every text is encoded by a public tokenizer and closed by an end id. Ids
are ranked by how often the whole corpus has them, and ranks are stored in
a byte-aligned variable-length code: two bits per rank in separate control
bytes say whether it takes 1, 2, 3 or 4 data bytes, so frequent ids take
one. Reading looks control bytes up in a numpy table of four lengths each
and gathers all ranks of a file at once.

A store is a folder with a Parquet table ``ranks`` (rank, id, n), a
Parquet table ``shards`` (one row per file) and the files that it lists.
Files hold documents in ascending order of id (null first); ``start`` of a
document is the number of ids of all documents before it. A task writes
files under names of its own and returns their rows; only files that the
committed table lists belong to the store, so attempts that failed or ran
twice leave nothing that a reader sees.

File: magic, then counts of documents, ranks, control bytes and data bytes
(little-endian 64 bits), per document its id, whether it has one, and its
number of ids, then the control bytes, then the data bytes.

Null, empty and blank texts hold the end id alone. Repeated rows, rows of
one id and rows without an id are documents each; rows of one id follow
each other by digest of their ids. An empty table makes a store without files.
The store lies in a folder that all executors see, under any scheme that
``pyarrow.fs`` opens.
"""

from __future__ import annotations

import json
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path
from . import kernels as K

MAGIC = b"ATXIDS01"
SHARD_IDS = 1 << 23  # ids of a file, from which the next one is begun
CACHED = 300_000  # pieces that an encoder remembers
LONGEST_CACHED = 64  # characters of a piece
TEXT_BYTES = 4 << 20  # encoded at once
READ_BYTES = 32 << 20  # of files, read by one task

# --- the code ---------------------------------------------------------------
#: lengths of the four ranks of each control byte
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)  # by length


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes) of 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    length = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = length - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    return control, data


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ranks of :func:`pack`'s bytes."""
    length = LENGTHS[control].ravel()[:n]
    begin = np.cumsum(length, dtype=np.int64) - length
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    words = np.ndarray((max(len(padded) - 3, 0),), "<u4", buffer=padded, strides=(1,))
    return words[begin] & MASKS[length]


def file_bytes(keys: np.ndarray, named: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    head = np.array([len(counts), len(ranks), len(control), len(data)], "<u8")
    return b"".join([MAGIC, head.tobytes(), keys.astype("<i8").tobytes(), named.astype(np.uint8).tobytes(), counts.astype("<u4").tobytes(), control.tobytes(), data.tobytes()])


def file_parts(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of documents, whether they have one, counts, ranks) of a file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    docs, n, n_control, n_data = (int(x) for x in np.frombuffer(raw, "<u8", 4, 8))
    at = 40
    out = []
    for kind, size in (("<i8", docs), (np.uint8, docs), ("<u4", docs), (np.uint8, n_control), (np.uint8, n_data)):
        out.append(np.frombuffer(raw, kind, size, at))
        at += out[-1].nbytes
    if at != len(raw):
        raise ValueError("a file of token ids has another length than its head says")
    return out[0], out[1].astype(bool), out[2].astype(np.int64), unpack(out[3], out[4], n)


# --- encoding ---------------------------------------------------------------
class Recent(dict):
    """A dict of at most about twice ``CACHED`` entries: when it is full,
    it starts anew and keeps the old entries as long as it isn't full again."""

    def __init__(self):
        self.old: dict = {}

    def recall(self, keys: set) -> set:
        """Bring back what is known of ``keys``; the rest is returned."""
        missing = keys - self.keys()
        if len(self) + len(missing) > CACHED:
            self.old = dict(self)
            self.clear()
            missing = keys
        again = missing & self.old.keys()
        self.update(zip(again, map(self.old.__getitem__, again)))
        return missing - again


#: class of each byte of a word: 1 letter, 2 digit, 3 mark, 4 none of these
_CLASS = np.full(256, 4, np.uint8)
_CLASS[0x21:0x7F] = 3
_CLASS[[*range(48, 58)]] = 2
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
#: the pattern by which the tokenizer cuts words (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def word_pieces(raw: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes without white space, start of each piece in them, pieces of
    each row) of a block of texts.

    Words of ASCII and of the letters of Latin-1, whose lower case and
    normal form follow letter by letter, are lower-cased and cut as
    ``PATTERN`` does. All other words, and those with the beginning of a
    special token, are one piece each, unchanged."""
    n, rows = len(raw), len(offsets) - 1
    if not n:
        return raw, np.zeros(0, np.int64), np.zeros(rows, np.int64)
    solid = ~K._WHITE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    kind = _CLASS[raw]
    follow = np.append(raw[1:], 0)
    odd = solid & ((kind == 4) | ((raw >= 0xC0) & (raw != 0xC3)) | ((raw == 0xC3) & ((follow == 0x97) | (follow == 0xB7))))
    for a, b in special:
        odd |= (raw == a) & (follow == b)
    word = np.cumsum(begins, dtype=np.int32) - 1
    is_odd = np.zeros(int(word[-1]) + 1, bool)
    is_odd[word[odd]] = True
    plain = solid & ~is_odd[word] if len(is_odd) else solid
    low = np.where(plain, K._LOWER[raw], raw)
    capital = np.flatnonzero(plain[1:] & (raw[:-1] == 0xC3) & (raw[1:] <= 0x9E)) + 1
    low[capital] += 32
    cut = begins.copy()
    cut[1:] |= plain[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
    # an apostrophe that begins a piece takes s, t, m, d, re, ve or ll along
    at = np.flatnonzero((low == 39) & cut & plain)
    if len(at):
        padded, fresh = np.append(low, [0, 0, 0]), np.append(begins, [True] * 3) | edge_after(edge, n)
        one, two = padded[at + 1], padded[at + 2]
        joins = ~fresh[at + 1]
        short = joins & np.isin(one, [115, 116, 109, 100])
        long = joins & ~fresh[at + 2] & (((two == 101) & ((one == 114) | (one == 118))) | ((one == 108) & (two == 108)))
        for own, size in ((at[short], 2), (at[long], 3)):
            cut[own + 1] = False
            end = own + size
            end = end[end < n]
            cut[end] |= solid[end]
    counts = np.diff(np.concatenate([[0], np.cumsum(cut)])[offsets])
    return low[solid], np.flatnonzero(cut[solid]), counts


def edge_after(edge: np.ndarray, n: int) -> np.ndarray:
    """Whether a row begins or the block has ended at each place, three
    places beyond the end included."""
    return np.concatenate([edge[:n], [True] * 3])


class WordEncoder:
    """Ids of texts, as the library gives them, piece by piece.

    The tokenizer's pattern never crosses white space, so a text's ids are
    those of its pieces. The model's ids of a piece are remembered; words
    that are not cut go to the library whole."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        cuts = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        if cuts != [PATTERN]:
            raise ValueError(f"a tokenizer that cuts words by {cuts}")
        self.whole_piece = regex.compile(PATTERN).fullmatch
        self.plain = re.compile("[!-~ß-öø-ÿ]+").fullmatch
        self.special = sorted({t["content"][:2].encode() for t in spec["added_tokens"]})
        self.spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known = Recent()

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def learn(self, missing: list[str]) -> None:
        """Remember the ids of new pieces."""
        cut, whole = [], []
        for piece in missing:
            (cut if self.plain(piece) and self.whole_piece(piece) else whole).append(piece)
        if cut:  # the model spells a piece by its bytes
            spelled = "".join(x for x, _ in self.spelled("\n".join(cut))).split(self.spelled("\n")[0][0])
            self.known.update(zip(cut, (self.packed([t.id for t in self.library.model.tokenize(x)]) for x in spelled)))
        self.known.update(zip(whole, (self.packed(e.ids) for e in self.library.encode_batch_fast(whole, add_special_tokens=False))))

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a block, number of ids of each)."""
        data, starts, counts = word_pieces(raw, offsets, self.special)
        edges = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        which, distinct = pieces.indices.to_numpy(), pieces.dictionary.to_pylist()
        self.learn(list(self.known.recall(set(distinct))))
        own = [*map(self.known.__getitem__, distinct), b"" if end_id is None else self.packed([end_id])]
        which = np.insert(which, np.cumsum(counts), len(distinct))  # the end of each text
        length = np.fromiter(map(len, own), np.int32, len(own)) // self.dtype.itemsize
        begin = np.cumsum(length, dtype=np.int32) - length
        pool = np.frombuffer(b"".join(own), self.dtype)
        n = length[which]
        ends = np.cumsum(n, dtype=np.int32)
        place = np.repeat(begin[which] - ends + n, n)  # from an id's place in the result to that in the pool
        place += np.arange(len(place), dtype=np.int32)
        for piece in distinct:
            if len(piece) > LONGEST_CACHED:
                self.known.pop(piece, None)
        return pool[place], np.diff(np.concatenate([[0], ends[np.cumsum(counts + 1) - 1]]))


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> WordEncoder:
    """One encoder per worker process and tokenizer."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
    return WordEncoder(tokenizer_file)


def encoded(df: DataFrame, tokenizer_file: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id long, ids binary, spot long): the ids of every row, packed in 2
    bytes each (4 for large vocabularies); ``spot`` is the row's place in
    its task. No shuffle."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_file)
        spot = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, j, raw, offsets in K.text_blocks(batch.column(1), TEXT_BYTES):
                ids, counts = enc.encode(raw, offsets, end_id)
                offsets = np.concatenate([[0], np.cumsum(counts * enc.dtype.itemsize)]).astype(np.int32)
                own = pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), own, pa.array(np.arange(spot, spot + j - i))], names=["id", "ids", "spot"])
                spot += j - i

    return rows.mapInArrow(run, "id long, ids binary, spot long")


# --- the store --------------------------------------------------------------
def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def write_ids(df: DataFrame, tokenizer_file: str, path: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text",
              shard_ids: int = SHARD_IDS) -> str:
    """Encode all rows of ``df`` and store them under ``path`` (new or empty)."""
    spark = df.sparkSession
    size = encoder(tokenizer_file).size
    dtype = encoder(tokenizer_file).dtype
    encoded(df, tokenizer_file, end_id, id_col, text_col).write.parquet(f"{path}/encoded")
    rows = spark.read.schema("id long, ids binary, spot long").parquet(f"{path}/encoded")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, _, raw, _ in K.text_blocks(batch.column(0)):
                total += np.bincount(raw.view(dtype), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    counts = rows.select("ids").mapInArrow(counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = counts.orderBy(F.desc("n"), "id").toPandas()  # a row per id of the vocabulary, at most
    ranked.insert(0, "rank", range(len(ranked)))
    spark.createDataFrame(ranked, "rank int, id int, n long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(size, np.uint32)
    rank_of[ranked["id"].to_numpy(int)] = ranked["rank"].to_numpy(np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)
    opened(path)[0].create_dir(f"{opened(path)[1]}/files", recursive=True)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, n = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        system, root = opened(path)
        keys: list = []
        counts_: list = []
        ranks: list = []

        def close() -> pa.RecordBatch:
            nonlocal keys, counts_, ranks, n
            key, count = pa.chunked_array(keys).combine_chunks(), np.concatenate(counts_)
            all_ranks = np.concatenate(ranks)
            raw = file_bytes(key.fill_null(0).to_numpy(), np.asarray(key.is_valid()), count, all_ranks)
            name = f"files/{part:06d}-{n:06d}-{attempt}.ids"
            with system.open_output_stream(f"{root}/{name}") as f:
                f.write(raw)
            row = [part, n, name, len(count), len(all_ranks), len(raw)]
            keys, counts_, ranks, n = [], [], [], n + 1
            return pa.RecordBatch.from_pydict(dict(zip(SHARD_COLUMNS, ([x] for x in row))), schema=SHARD_ARROW)

        held = 0
        for batch in batches:
            for i, j, raw, offsets in K.text_blocks(batch.column(1), min(K.BLOCK_BYTES, shard_ids * dtype.itemsize)):
                keys.append(batch.column(0).slice(i, j - i))
                counts_.append(np.diff(offsets) // dtype.itemsize)
                ranks.append(shared.value[raw.view(dtype)])
                held += len(ranks[-1])
                if held >= shard_ids:
                    yield close()
                    held = 0
        if keys:
            yield close()

    order = [F.col("id").asc_nulls_first(), F.xxhash64("ids"), F.col("spot")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select("id", "ids").mapInArrow(store, SHARD_SCHEMA).write.parquet(f"{path}/shards")
    return path


SHARD_COLUMNS = ["part", "shard", "name", "docs", "ids", "bytes"]
SHARD_SCHEMA = "part int, shard int, name string, docs long, ids long, bytes long"
SHARD_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("name", pa.string()), *[(c, pa.int64()) for c in SHARD_COLUMNS[3:]]])


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start long, n_tokens long, ids binary) of every document of a
    store; ``ids`` are little-endian unsigned 32-bit integers."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards")
    ranked = spark.read.schema("rank int, id int, n long").parquet(f"{path}/ranks").orderBy("rank").toPandas()
    shared = spark.sparkContext.broadcast(ranked["id"].to_numpy("<u4"))
    # ids before a part (few rows: one per writing task), then before a file of it
    parts = shards.groupBy("part").agg(F.sum("ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("inside", F.coalesce(F.sum("ids").over(within), F.lit(0))).join(parts, "part")
    files, held = shards.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(files, max(-(-held // READ_BYTES), 2 * spark.sparkContext.defaultParallelism)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(path)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_stream(f"{root}/{name}") as f:
                    keys, named, counts, ranks = file_parts(f.read())
                ids = shared.value[ranks]
                ends = np.cumsum(counts)
                begin = ends - counts
                i = 0
                while i < len(counts):  # a few megabytes at a time
                    j = max(i + 1, int(np.searchsorted(ends, begin[i] + K.BLOCK_BYTES // 4, "right")))
                    offsets = ((np.concatenate([begin[i:j], ends[j - 1 : j]]) - begin[i]) * 4).astype(np.int64)
                    own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(offsets), pa.py_buffer(ids[begin[i] : ends[j - 1]].tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i:j], mask=~named[i:j]), pa.array(begin[i:j] + start), pa.array(counts[i:j]), own.cast(pa.binary())], names=["id", "start", "n_tokens", "ids"])
                    i = j

    spread = placed.select("name", (F.col("base") + F.col("inside")).alias("start")).repartition(tasks, "name")
    return spread.mapInArrow(run, "id long, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def stored(df: DataFrame, tokenizer_file: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write a store in the shared folder and read it back."""
    path = shared_path(df.sparkSession, "llm", "ids")
    return read_ids(df.sparkSession, write_ids(df, tokenizer_file, path, end_id, id_col, text_col), id_col)


def digests(found: DataFrame) -> DataFrame:
    """The digest columns of :func:`read_ids` rows."""
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
