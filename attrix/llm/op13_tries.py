"""Prefix trie of conversations, built as a burst trie.

Sequences of turns that are equal count as one sequence with its members.
All sequences start in one container under the root. A container that
holds too many sequences bursts: the turns that all of them begin with
become a path of nodes, and the sequences go on, without these turns and
the next one, to a container for each next turn. When all containers are
small, Spark sorts each one's suffixes and a sweep over them, with a stack
of the nodes on the way to the current suffix, makes the nodes below its
head. Sums of the heads then rise through the bursts, last ones first.

Turns are named by a digest of role and text (128 bits decide that turns,
and sequences, are equal), so texts stay where they are. A conversation is
one row of its turns' names and lengths. Turns of one number follow each
other by name; a null number comes first, null roles and texts are empty.
Repeated rows are turns each. Rows without a conversation's id take no
part, and a table without any other rows has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

CONTAINER = 4096  # sequences of a container, beyond which it bursts
MEMBERS = 16  # bits of conversation ids that meet in one list of members
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
BRANCH, KEPT = 100, 6  # a conversation branches off the one with the id c - c % 100, after crc32(c) % 6 turns

NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def sequences(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv long, names array<string>, chars array<int>): the turns of
    every conversation in order."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    name = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.col(f"`{turn_col}`").cast("long")
    place = F.struct(turn.isNotNull().alias("numbered"), turn.alias("turn"), name.alias("name"), F.char_length(text).alias("chars"))
    rows = conversations.select(F.col(f"`{id_col}`").cast("long").alias("conv"), place.alias("place")).where("conv is not null")
    own = rows.groupBy("conv").agg(F.sort_array(F.collect_list("place")).alias("own"))
    return own.select("conv", F.col("own.name").alias("names"), F.col("own.chars").alias("chars"))


def branched(own: DataFrame, every: int = BRANCH, most: int = KEPT) -> DataFrame:
    """Rows of :func:`sequences`, every conversation c rebuilt as a branch:
    the first h turns of conversation c - c % ``every``, then its own after
    its first h, where h is the crc32 of c in decimal, modulo ``most``."""
    heads = own.where(F.col("conv") % every == 0).select(F.col("conv").alias("base"), *[F.slice(c, 1, most - 1).alias(f"base_{c}") for c in ("names", "chars")])
    kept = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    rows = own.withColumn("base", F.col("conv") - F.col("conv") % every).withColumn("kept", kept).join(heads, "base", "left")

    def whole(c: str) -> Column:
        return F.concat(F.when(F.col(f"base_{c}").isNull(), F.slice(c, 1, 0)).otherwise(F.slice(f"base_{c}", F.lit(1), F.col("kept"))), F.slice(c, F.col("kept") + 1, F.size(c)))

    return rows.select("conv", whole("names").alias("names"), whole("chars").alias("chars"))


def members(rows: DataFrame) -> DataFrame:
    """(key, ends): digest of each sequence's conversation ids, ascending.
    Ids are listed in ranges first; a sequence's lists are then hashed in
    order as they stream by, so none is held whole."""
    part = rows.groupBy("key", F.shiftright("conv", MEMBERS).alias("range")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    lists = part.select("key", "range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for batch in batches:
            keys, ends = [], []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == last:
                    digest.update(b",")
                else:
                    if last is not None:
                        keys.append(last)
                        ends.append(digest.hexdigest())
                    last, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ends, pa.string())], names=["key", "ends"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([digest.hexdigest()])], names=["key", "ends"])

    return lists.repartition("key").sortWithinPartitions("key", "range").select("key", "ids").mapInArrow(run, "key string, ends string")


def distinct_sequences(rows: DataFrame) -> DataFrame:
    """(names, chars, n, first, ends) of every distinct sequence."""
    rows = saved(rows.withColumn("key", F.md5(F.array_join("names", ""))), "sequences")
    each = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("conv").alias("first"), F.any_value("names").alias("names"), F.any_value("chars").alias("chars"))
    return each.join(members(rows), "key").drop("key")


class Node:
    """A node on the way to the suffix that the sweep is at."""

    __slots__ = ("name", "chars", "n", "first", "children", "leaves", "saved", "ends", "below")

    def __init__(self, name: str | None, chars: int):
        self.name, self.chars = name, chars
        self.n = self.children = self.leaves = self.saved = 0
        self.first, self.ends = None, NO_MEMBERS
        self.below: list[tuple] = []  # finished children, which wait for this node's first member

    def add(self, n: int, first: int) -> None:
        self.n += n
        self.first = first if self.first is None else min(self.first, first)


def swept(containers: DataFrame) -> DataFrame:
    """Nodes of containers (head, parent, depth, head_chars, names, chars,
    n, first, ends). Rows of heads have ``parent`` (the container above)
    and no ``parent_conv_id``; all others are complete. No more than one
    container's children of open nodes are held."""
    columns = ["head", "parent", "depth", "head_chars", "names", "chars", "n", "first", "ends"]
    rows = containers.select(*columns).repartition("head").sortWithinPartitions("head", "names")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[Node] = []
        at: tuple = (None, None, 0)  # head, parent, depth
        out: list[tuple] = []

        def close(to: int) -> None:
            while len(stack) > to:
                node = stack.pop()
                depth = at[2] + len(stack)
                node.leaves = node.leaves or 1
                node.saved += (node.n - 1) * node.chars
                out.extend((*row[:2], node.first, *row[3:], None, None) for row in node.below)
                row = (node.first, depth, None, node.n, node.children, node.leaves, node.saved, node.ends)
                if stack:
                    up = stack[-1]
                    up.add(node.n, node.first)
                    up.children += 1
                    up.leaves += node.leaves
                    up.saved += node.saved
                    up.below.append(row)
                else:
                    out.append((*row, at[0], at[1]))

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[] for _ in SWEPT]
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, SWEPT)], schema=SWEPT)
            out.clear()
            return batch

        for batch in batches:
            for head, parent, depth, head_chars, names, chars, n, first, ends in zip(*(batch.column(c).to_pylist() for c in range(len(columns)))):
                if head != at[0]:
                    close(0)
                    at = (head, parent, depth)
                    stack.append(Node(None, head_chars))
                same = 0
                while same < len(names) and same + 1 < len(stack) and stack[same + 1].name == names[same]:
                    same += 1
                close(same + 1)
                for name, length in zip(names[same:], chars[same:]):
                    stack.append(Node(name, length))
                stack[-1].add(n, first)
                stack[-1].ends = ends
            yield ready()
        close(0)
        yield ready()

    return rows.mapInArrow(run, f"{NODE}, head string, parent string")


SWEPT = pa.schema([(c, pa.string() if c in ("ends_sha256", "head", "parent") else pa.int32() if c == "depth" else pa.int64()) for c in [*NODE_COLUMNS, "head", "parent"]])


def trie(found: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The nodes (columns ``NODE``) of sequences (names, chars, n, first, ends)."""
    still = saved(found.select(F.lit("").alias("head"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth"), F.lit(0).alias("head_chars"),
                               "names", "chars", "n", "first", "ends"), "open")
    bursts: list[DataFrame] = []
    ends: list[DataFrame] = []
    small: list[DataFrame] = []
    while True:
        # the root always bursts, so that containers can lie on many machines
        sizes = still.groupBy("head", "parent", "depth", "head_chars").agg(
            F.count("*").alias("held"), F.min(F.struct("names", "chars")).alias("least"), F.max("names").alias("greatest"))
        sizes = sizes.where((F.col("held") > container) | F.col("parent").isNull())
        differ = F.array_position(F.zip_with("least.names", "greatest", lambda a, b: ~a.eqNullSafe(b)), True)
        common = F.when(F.isnull(differ) | (differ == 0), F.size("least.names")).otherwise(differ - 1).cast("int")
        burst = saved(sizes.withColumn("common", common).select("head", "parent", "depth", "head_chars", "common", F.slice("least.chars", F.lit(1), F.col("common")).alias("path")), "bursts")
        if burst.isEmpty():
            small.append(still)
            break
        bursts.append(burst)
        joined = still.join(burst.select("head", "common"), "head", "left")
        small.append(saved(joined.where("common is null").select(*still.columns), "small"))
        moving = joined.where("common is not null")
        ends.append(saved(moving.where(F.size("names") == F.col("common")).select(F.col("head").alias("parent"), "n", "first", "ends"), "ends"))
        after = F.col("common") + 1
        still = saved(moving.where(F.size("names") > F.col("common")).select(
            F.md5(F.concat("head", F.lit("/"), F.array_join(F.slice("names", F.lit(1), after), ""))).alias("head"), F.col("head").alias("parent"),
            (F.col("depth") + after).alias("depth"), F.element_at("chars", after).alias("head_chars"),
            *[F.slice(c, after + 1, F.size(c)).alias(c) for c in ("names", "chars")], "n", "first", "ends"), "open")

    all_small = small[0]
    for more in small[1:]:
        all_small = all_small.unionByName(more)
    nodes = saved(swept(all_small), "nodes")
    out = nodes.where("parent is null").select(*NODE_COLUMNS)
    heads = nodes.where("parent is not null")  # of containers, later of bursts

    for burst, own in zip(reversed(bursts), reversed(ends)):
        # heads' sums rise to the node that a burst branches at
        children = heads.join(burst.select(F.col("head").alias("parent")), "parent", "left_semi")
        parts = children.select("parent", "n_convs", F.col("conv_id").alias("first"), "n_leaves", "saved_tokens", F.lit(1).alias("child"), F.lit(None).cast("string").alias("ends"))
        parts = parts.unionByName(own.select("parent", F.col("n").alias("n_convs"), "first", *[F.lit(0).cast("long").alias(c) for c in ("n_leaves", "saved_tokens")], F.lit(0).alias("child"), "ends"))
        sums = parts.groupBy("parent").agg(F.sum("n_convs").alias("n_convs"), F.min("first").alias("conv_id"), F.sum("n_leaves").alias("leaves"),
                                           F.sum("saved_tokens").alias("below"), F.sum("child").alias("children"), F.max("ends").alias("ends"))
        rose = saved(burst.select("head", F.col("parent").alias("above"), "depth", "common", F.concat(F.array("head_chars"), "path").alias("path")).join(
            sums.withColumnRenamed("parent", "head"), "head"), "rose")
        # the path from the head to the branching node, all with its members
        at = F.posexplode("path").alias("step", "own")
        rest = F.aggregate(F.slice("path", F.col("step") + 1, F.size("path")), F.lit(0).cast("long"), lambda a, x: a + x)
        branches = F.col("step") == F.col("common")
        path = rose.select("*", at).select(
            "conv_id", (F.col("depth") + F.col("step")).cast("int").alias("depth"), F.when(F.col("step") > 0, F.col("conv_id")).alias("parent_conv_id"), "n_convs",
            F.when(branches, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.greatest("leaves", F.lit(1)).alias("n_leaves"),
            (F.col("below") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"),
            F.when(branches, F.coalesce("ends", F.lit(NO_MEMBERS))).otherwise(F.lit(NO_MEMBERS)).alias("ends_sha256"), F.when(F.col("step") == 0, F.col("head")).alias("head"), F.col("above").alias("parent"))
        # heads below now know their parent; this burst's head waits for its own
        above = rose.select(F.col("head").alias("parent"), F.col("conv_id").alias("up"))
        out = out.unionByName(children.join(above, "parent").withColumn("parent_conv_id", F.col("up")).select(*NODE_COLUMNS))
        out = out.unionByName(path.where("head is null or parent is null").select(*NODE_COLUMNS))
        heads = heads.unionByName(path.where("head is not null and parent is not null").select(*heads.columns))
    return out


def nodes(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The trie of all conversations, rebuilt as branches."""
    return trie(distinct_sequences(branched(sequences(conversations))), container)


# the same in SQL: every prefix of every conversation, and every node below every node
ORACLE = """
WITH turns AS (
  SELECT conv_id, turn, md5(length(r) || ':' || r || t) AS name, length(t) AS chars
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
own AS (
  SELECT conv_id, list(name ORDER BY turn NULLS FIRST, name) AS names, list(chars ORDER BY turn NULLS FIRST, name) AS chars,
    xor(4294967295, list_reduce(list_concat([4294967295], [CAST(ascii(d) AS BIGINT) FOR d IN string_split(CAST(conv_id AS VARCHAR), '')]),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM turns GROUP BY conv_id),
whole AS (
  SELECT o.conv_id, list_concat(coalesce(b.names[1:o.h], []), o.names[o.h + 1:]) AS names, list_concat(coalesce(b.chars[1:o.h], []), o.chars[o.h + 1:]) AS chars
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
prefix AS (
  SELECT conv_id, d, len(names) = d AS ends, md5(array_to_string(names[1:d], '')) AS p, CASE WHEN d > 0 THEN md5(array_to_string(names[1:d - 1], '')) END AS up,
    CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars
  FROM whole, generate_series(0, len(names)) g(d)),
node AS (
  SELECT d, p, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefix GROUP BY d, p),
child AS (
  SELECT d - 1 AS d, up AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY d, up),
full_node AS (
  SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (d, p)),
subtree AS (
  SELECT a.d, a.p, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM full_node n JOIN prefix a ON a.conv_id = n.conv_id AND a.d <= n.d GROUP BY a.d, a.p)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_node n JOIN subtree s USING (d, p) LEFT JOIN node up ON up.d = n.d - 1 AND up.p = n.up"""
