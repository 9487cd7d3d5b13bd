"""Token-id files, centroid clustering and the prefix trie: the library's
ids, brute force, odd rows and empty tables."""

import itertools
import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

from attrix.llm import op11_ids as ids
from attrix.llm import op12_centroids as centroids
from attrix.llm import op13_tries as tries
from attrix.llm.common import table
from attrix.session import shared_path

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def library_rows(library, rows):
    """(id, start, count, crc32) in order, ids of one key by nothing in particular."""
    start, out = 0, []
    for key, text in rows:
        own = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    return out


def test_code_round_trip():
    edges = [0, 1, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1]
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 5, 9, 1000):
        ranks = np.concatenate([np.array(edges[:n], np.uint32), (2 ** rng.uniform(0, 32, max(0, n - 9))).astype(np.uint32)])
        control, data = ids.pack(ranks)
        assert len(control) == -(-len(ranks) // 4)
        assert len(data) == sum(max(1, (int(r).bit_length() + 7) // 8) for r in ranks)
        assert (ids.unpack(control, data, len(ranks)) == ranks).all()
        keys = np.arange(2)
        back = ids.file_parts(ids.file_bytes(keys, np.array([True, False]), np.array([len(ranks), 0]), ranks))
        assert (back[3] == ranks).all() and back[2].tolist() == [len(ranks), 0] and back[1].tolist() == [True, False]
    with pytest.raises(ValueError):
        ids.file_parts(b"x" * 48)


def test_ids_equal_the_library(spark, library):
    docs = table(spark, SF, "documents")
    got = ids.digests(ids.stored(docs, WORDS)).orderBy("start").collect()
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert [tuple(r) for r in got] == library_rows(library, rows)


def test_ids_of_odd_rows(spark, library):
    odd = [
        (None, "x"), (None, None), (3, None), (3, ""), (3, " \t\n"), (3, "y"), (3, "y"), (1, "Z" * 100_000), (2, "don't can'T 12³ µm ªº ×÷"),
        (4, "\x1c a\x85b c İstanbul ΟΔΟΣ é ᾈ <|endoftext|>x<|start it's we'LL Ａ"), (5, "<|startoftext|>  <|endoftext|> 's'T\x1fy"), (6, "́ a ́b 한가"),
    ]
    df = spark.createDataFrame([(k, t, 1, "n") for k, t in odd], "doc_id long, text string, start int, ids string")
    got = ids.stored(df, WORDS).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((k for k, _ in odd), key=lambda k: (k is not None, k))
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got[:-1])]
    want = sorted((k is None, k or 0, *library.encode(t or "", add_special_tokens=False).ids, 2) for k, t in odd)
    assert sorted((r.doc_id is None, r.doc_id or 0, *np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    assert ids.stored(df.limit(0), WORDS).count() == 0


def test_ids_over_many_files_and_unlisted_ones(spark, library):
    docs = table(spark, SF, "documents").repartition(5)
    path = ids.write_ids(docs, WORDS, shared_path(spark, "llm", "ids"), shard_ids=2000)
    system, root = ids.opened(path)
    shards = spark.read.parquet(f"{path}/shards")
    assert shards.count() > 20
    ranked = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert all(a.n >= b.n for a, b in zip(ranked, ranked[1:])) and sum(r.n for r in ranked) == shards.agg({"ids": "sum"}).first()[0]
    with system.open_output_stream(f"{root}/files/000000-000000-left.ids") as f:  # of an attempt that failed
        f.write(b"half")
    got = ids.digests(ids.read_ids(spark, path)).orderBy("start").collect()
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert [tuple(r) for r in got] == library_rows(library, rows)


def test_encoder_forgets_and_learns_again(library, monkeypatch):
    monkeypatch.setattr(ids, "CACHED", 10)
    enc = ids.WordEncoder(WORDS)
    for text in ("a b c d e f g h", "one two, three! four five six", "a b, " * 30, "Seven été " + " ".join(map(str, range(40)))):
        raw = [x.encode() for x in ("", text, "", text)]
        got, counts = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 2)
        want = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert got.tolist() == [2, *want, 2, *want] and counts.tolist() == [1, len(want), 1, len(want)]


def test_pieces_of_any_text(library):
    rng = random.Random(9)
    enc = ids.WordEncoder(WORDS)
    some = list("aAzZéÉßÿŸ×÷09 \t\n\r\x0b\x1c\x7f\xa0'’\"-_.,<|>sStTmMdDrReEvVlLİıΣσςǅ½²ªº中\u0301🎉\u200d") + ["'s", "'re", "'LL", "''", "<|", "<|endoftext|>", "don't", "É'd"]
    texts = ["".join(rng.choices(some, k=rng.randint(0, 40))) for _ in range(4000)]
    raw = [t.encode() for t in texts]
    got, counts = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends):
        assert got[a:b].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        place = centroids.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def lloyd(rows, d, clusters, rounds=3, scale=64, seed=1):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((sha256(f"{seed}:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:clusters]
    c = [q for _, q in first]
    near = lambda q: min(range(len(c)), key=lambda k: (sum((a - b) ** 2 for a, b in zip(q, c[k])), k))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, q in kept:
            own[near(q)].append(q)
        for k, qs in own.items():
            c[k] = [sum(col) // len(qs) for col in zip(*qs)]
    return sorted(((i is not None, i or 0), near(q), sum((a - b) ** 2 for a, b in zip(q, c[near(q)]))) for i, q in kept), c


@pytest.mark.parametrize("spread", [0.05, 3.0, 1e5])
def test_clusters_equal_brute_force(spark, spread):
    rng = np.random.default_rng(int(spread))
    centres = rng.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] * spread + rng.normal(size=8) * spread / 8).tolist()) for i in range(900)]
    rows += [(901 + i, rows[3][1]) for i in range(400)]  # copies
    rows += [rows[7], rows[7], (None, rows[9][1])]
    odd = [(2000, None), (2001, [0.1] * 7), (2002, [0.1] * 7 + [None]), (2003, [float("nan")] * 8), (2004, [float("inf")] + [0.0] * 7), (2005, []), (2006, [0.0] * 8), (2007, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, "a") for i, v in rows + odd], "vec_id long, embedding array<double>, cluster string").repartition(4)
    found, c = centroids.clustered(df, clusters=6, dimensions=8)
    want, want_c = lloyd(rows + odd, 8, 6)
    assert c.tolist() == want_c
    assert sorted(((r.vec_id is not None, r.vec_id or 0), r.cluster, r.distance) for r in found.collect()) == want
    listed = centroids.listing(found, c).collect()
    assert {r.inertia for r in listed} == {sum(w[2] for w in want)}
    assert all(r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster) for r in listed)
    assert {r.cluster: r.centroid_sha256 for r in listed} == {k: sha256(",".join(map(str, want_c[k])).encode()).hexdigest() for k in {w[1] for w in want}}


def test_clusters_of_few_and_of_huge_vectors(spark):
    df = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64), (4, None)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in centroids.listing(*centroids.clustered(df)).collect()}
    assert sorted(found) == [1, 2, 3] and {r.distance for r in found.values()} == {0} and len({r.cluster for r in found.values()}) == 3
    assert centroids.listing(*centroids.clustered(df.limit(0))).count() == 0
    assert centroids.listing(*centroids.clustered(df.where("vec_id = 4"))).count() == 0


def test_boxes_never_lose_the_nearest_centroid():
    rng = np.random.default_rng(4)
    x, c = rng.integers(-8, 8, (64, 4)) + np.repeat(rng.integers(-50, 50, (8, 4)), 8, axis=0), rng.integers(-60, 60, (9, 4))
    able = centroids.candidates(x.reshape(8, 8, 4).min(axis=1), x.reshape(8, 8, 4).max(axis=1), c)
    d = ((x[:, None] - c) ** 2).sum(axis=2)
    assert not able.all()
    assert all(able[i // 8, k] for i in range(64) for k in np.flatnonzero(d[i] == d[i].min()))


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = __import__("hashlib").md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, name, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(np.fix(c / 100)) * 100
        whole[c] = own.get(base, [])[:h] + ts[h:]
    member, ends = defaultdict(list), defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            member[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    out = []
    for p, cs in member.items():
        below = [q for q in member if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) > len(q) and r[: len(q)] == q for r in below)]
        saved = sum((len(member[q]) - 1) * len(q[-1][1]) for q in below if q)
        out.append((min(cs), len(p), min(member[p[:-1]]) if p else None, len(cs), len(children), len(leaves), saved,
                    sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("container", [1, 2, 10, 4096])
def test_trie_equals_brute_force(spark, container):
    rng = random.Random(8)
    rows = []
    for c in [*range(-120, 260), 10_000_000_000, 10_000_000_007]:
        if rng.random() < 0.1:
            continue
        for t in range(rng.choice([0, 1, 2, 3, 9])):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", None, ""]), rng.choice(["a", "", None, "\U0001f600b", "common"])))
    rows += [(c, t, "user", "same " + "x" * t) for c in range(300, 380) for t in range(12)]  # copies, and one path for many
    rows += rows[:20] + [(None, 0, "user", "nobody"), (400, 0, "u", "é" * 50_000), (401, 0, "u", "é" * 50_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string").repartition(3)
    got = sorted(tuple(r[c] for c in tries.NODE_COLUMNS) for r in tries.nodes(df, container).collect())
    assert got == brute_trie(rows)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([(None, 0, "u", "x")], "conv_id long, turn long, role string, text string")
    assert tries.nodes(df).count() == tries.nodes(df.limit(0)).count() == 0
    df = spark.createDataFrame([(107, 0, "u", "x")], "conv_id long, turn long, role string, text string")  # no conversation 100: all its turns may go
    assert [tuple(r[c] for c in tries.NODE_COLUMNS) for r in tries.nodes(df).collect()] == brute_trie([(107, 0, "u", "x")])
