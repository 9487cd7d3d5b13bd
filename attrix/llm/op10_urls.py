"""URL filter: rules looked up in a memory-mapped sorted digest array.

A rule is a host, a path prefix and a verdict. It fits its host and all
subdomains if the path of the url starts with the rule's; the longest
fitting rule (host and path together, then host) decides, and a url
without one is allowed. Each rule's text (host + path) has a 64-bit xxhash
key in a sorted array; a worker maps the array from a file, probes all
candidate texts of a batch by vectorised binary search, and confirms every
hit against the stored text, so a collision never decides.

The index is broadcast only up to ``MOST_INDEX_BYTES``; larger rule sets
are joined on the candidate texts instead. Null urls and urls without
``://`` have an empty host and path and no rule. Of rules with equal host
and path, block wins. Repeated rows are judged each; extra columns stay.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"
MOST_INDEX_BYTES = 256 << 20
#: The rules of the registered query: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def digest(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def build_index(rules: Sequence[tuple[str, str, str]], key=digest) -> bytes:
    """The index file: counts, then sorted keys, text ends, host lengths,
    verdicts, path and host lengths in use, and the texts."""
    best: dict[tuple[bytes, bytes], int] = {}
    for host, path, verdict in rules:
        if verdict not in ("allow", "block") or path and not path.startswith("/"):
            raise ValueError(f"not a rule: {host}{path} {verdict}")
        at = (host.translate(str.maketrans(UPPER, LOWER)).encode(), path.encode())
        best[at] = max(best.get(at, 0), int(verdict == "block"))
    rows = sorted((key(h + p), h + p, len(h), v) for (h, p), v in best.items())
    keys = np.array([r[0] for r in rows], np.uint64)
    ends = np.cumsum([0] + [len(r[1]) for r in rows]).astype(np.int64)
    hosts = np.array([r[2] for r in rows], np.int64)
    verdicts = np.array([r[3] for r in rows], np.int64)
    paths = np.unique([len(r[1]) - r[2] for r in rows]).astype(np.int64)
    sizes = np.unique(hosts)
    counts = np.array([len(rows), len(paths), len(sizes)], np.int64)
    return b"".join(x.tobytes() for x in (counts, keys, ends, hosts, verdicts, paths, sizes)) + b"".join(r[1] for r in rows)


class RuleIndex:
    """An index, mapped from a file that goes with the process."""

    def __init__(self, data: bytes, key=digest):
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), len(data), access=mmap.ACCESS_READ)
        n, paths, sizes = np.frombuffer(self.map, np.int64, 3)
        at = 24
        parts = []
        for kind, count in ((np.uint64, n), (np.int64, n + 1), (np.int64, n), (np.int64, n), (np.int64, paths), (np.int64, sizes)):
            parts.append(np.frombuffer(self.map, kind, count, at))
            at += 8 * int(count)
        self.keys, self.ends, self.hosts, self.verdicts, self.paths, sizes_ = parts
        self.sizes, self.texts, self.key = set(sizes_.tolist()), at, key

    def candidates(self, host: bytes, path: bytes) -> list[tuple[bytes, int]]:
        """Texts that a fitting rule may have: host and domain suffixes by path prefixes."""
        ends = [b"".join((path[:k],)) for k in self.paths.tolist() if k <= len(path)]
        out, begin = [], 0
        while host:
            own = host[begin:]
            if len(own) in self.sizes:
                out += [(own + p, len(own)) for p in ends]
            begin = host.find(b".", begin) + 1
            if not begin:
                break
        return out

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str]]:
        texts: list[tuple[bytes, int]] = []
        owner: list[int] = []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            found = self.candidates(host.encode(), path.encode())
            texts += found
            owner += [i] * len(found)
        rule: list[str | None] = [None] * len(hosts)
        verdict = [DEFAULT] * len(hosts)
        rank = [(-1, -1)] * len(hosts)
        probe = np.array([self.key(t) for t, _ in texts], np.uint64)
        spot = np.searchsorted(self.keys, probe)
        hit = np.zeros(len(probe), bool)
        inside = spot < len(self.keys)
        hit[inside] = self.keys[spot[inside]] == probe[inside]
        for j in np.flatnonzero(hit):
            text, host_length = texts[j]
            k = int(spot[j])
            while k < len(self.keys) and self.keys[k] == probe[j]:  # all rules of the key
                stored = self.map[self.texts + int(self.ends[k]) : self.texts + int(self.ends[k + 1])]
                if stored == text and self.hosts[k] == host_length:
                    i = owner[j]
                    if (len(text), host_length) > rank[i]:
                        rank[i], rule[i] = (len(text), host_length), text.decode()
                        verdict[i] = "block" if self.verdicts[k] else "allow"
                k += 1
        return rule, verdict


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with the host and the path of a url column."""
    at = F.coalesce(F.instr(url_col, "://"), F.lit(0))
    rest = F.when(at > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)
    return pages.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, url_col: str = "url", most_index_bytes: int = MOST_INDEX_BYTES) -> DataFrame:
    """``pages`` with host, path, rule and verdict. ``rules``: tuples or a
    table (host, path, verdict)."""
    spark = pages.sparkSession
    clash = [c for c in ("host", "path", "rule", "verdict") if c in pages.columns]
    pages = with_host_path(pages.drop(*[c for c in clash if c != url_col]), url_col)
    if isinstance(rules, DataFrame):
        size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 32)).first()[0] or 0
        if size > most_index_bytes:
            return judged_by_join(pages, rules)
        rules = [tuple(r) for r in rules.select("host", "path", "verdict").collect()]  # within the bound
    data = build_index(rules)
    if len(data) > most_index_bytes:
        return judged_by_join(pages, spark.createDataFrame(list(rules), "host string, path string, verdict string"))
    shared = spark.sparkContext.broadcast(data)
    names = [*pages.columns, "rule", "verdict"]
    host_at, path_at = names.index("host"), names.index("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(shared.value)
        for batch in batches:
            rule, verdict = index.judge(batch.column(host_at).to_pylist(), batch.column(path_at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=names)

    return pages.mapInArrow(run, StructType([*pages.schema.fields, StructField("rule", StringType()), StructField("verdict", StringType())]))


def judged_by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for a rule set of any size: candidates joined on host and
    path, then the longest of each distinct (host, path)."""
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    lengths = rules.select(F.length("rule_path").alias("l")).distinct().agg(F.collect_set("l").alias("lengths"))
    sites = pages.select("host", "path").distinct().join(F.broadcast(lengths))  # one row
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    pairs = sites.withColumn("rule_host", F.explode(suffixes)).withColumn("l", F.explode("lengths")).where("l <= length(path) and rule_host <> ''")
    pairs = pairs.withColumn("rule_path", F.expr("substring(path, 1, l)"))
    longest = F.struct((F.length("rule_host") + F.length("rule_path")).alias("a"), F.length("rule_host").alias("b"), F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    best = pairs.join(rules, ["rule_host", "rule_path"]).groupBy("host", "path").agg(F.max(longest).alias("best"))
    return pages.join(best, ["host", "path"], "left").select(*[pages[c] for c in pages.columns], F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"))


ORACLE = r"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM r),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
b AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN b USING (page_id)
"""
