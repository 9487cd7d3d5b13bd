"""Substring dedup, Jaccard join, fingerprints, pieces and passages against
brute force, on odd tables: nulls, empty and long texts, repeated rows, ids
that are null or shared, empty tables, extra columns."""

import hashlib
import random
import re
from collections import defaultdict

import public_tokenizers
import pytest

from attrix.llm import graph
from attrix.llm import op2_substrings as substrings
from attrix.llm import op3_sketch as sketch
from attrix.llm import op5_jaccard as jaccard
from attrix.llm import op7_pieces as pieces
from attrix.llm import op8_chains as chains

MODEL = public_tokenizers.path("piece_bpe_32k.model")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(A_Z))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def corpus(n=160, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, rows = text(90), []
    base = [text(rng.randint(0, 120)) for _ in range(25)]
    for i in range(n):
        t = rng.choice(base)
        w = t.split(" ")
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        t = " ".join(w)
        if i % 9 == 0:
            t = text(30) + "\n" + passage + "\n" + text(20)
        if i % 17 == 0:
            t = "Ab" * rng.randint(1, 200)
        if i % 23 == 0:
            t = rng.choice([None, "", " \n\t ", "One two", "ONE two", "a b c d e"])
        rows.append((i * 7 + 3, t))
    rows.append((5, " ".join(base) * 8))  # long
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, key int")


def removed_by_force(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s in seen:
                gone[p : p + length] = [True] * length
            seen.add(s)
        runs = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("length", [100, 33])
def test_substrings(spark, rows, length):
    got = substrings.digests(substrings.repeated_substrings(table(spark, rows), length=length)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == removed_by_force(rows, length)


def test_substrings_odd_ids(spark):
    t = "some words that go on for a while " * 5
    df = spark.createDataFrame([(None, t), (4, t), (4, t), (4, "other"), (9, t[:120]), (9, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in substrings.digests(substrings.repeated_substrings(df)).collect())
    inner = len(t) - 34  # within the text, only its first period is new
    assert ("None", len(t), inner) in got and got.count(("4", len(t), len(t))) == 2
    assert ("4", 5, 0) in got and ("9", 120, 120) in got and ("9", 0, 0) in got
    assert substrings.repeated_substrings(df.limit(0)).count() == 0


def test_kept_text_has_whole_characters(spark):
    t = "é" * 80
    out = substrings.with_kept_text(spark.createDataFrame([(1, t, "a"), (2, "x" + t, "b"), (3, None, "c")], "doc_id long, text string, row string"))
    got = {r.doc_id: (r.text, r.row) for r in out.collect()}
    assert got[2] == ("x", "b") and got[3] == ("", "c") and set(got[1][0]) <= {"é"}


@pytest.mark.parametrize("keep, text", [(False, ""), (True, None)])
def test_kept_text_of_null(spark, keep, text):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in substrings.with_kept_text(docs, keep_null=keep).collect()} == {1: text, 2: ""}


def components_by_force(rows, percent=75):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_jaccard(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(table(spark, rows)).collect()}
    assert got == components_by_force(rows)


@pytest.mark.parametrize("boundary", [0, 4, 9])
def test_jaccard_at_any_boundary(spark, monkeypatch, boundary):
    rng = random.Random(boundary)
    base = [[rng.choice("abcdefgh") for _ in range(rng.randint(3, 16))] for _ in range(12)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        if rng.random() < 0.6:
            w = w[: rng.randint(1, len(w))] if rng.random() < 0.5 else [*w, rng.choice("abcdefgh")]
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard, "boundary_of", lambda costs, percent: boundary)
    monkeypatch.setattr(jaccard, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(jaccard, "LONG_LIST", 3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(table(spark, rows)).collect()}
    assert got == components_by_force(rows)


def test_jaccard_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (2, "A b c d e f"), (None, ""), (3, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.jaccard_components(df).collect())
    assert got == [("2", 2, "2"), ("3", 0, "3"), ("7", 2, "2"), ("7", 2, "2"), ("None", 0, "None")]
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 7] + [(100, 3), (100, 50), (8, 8)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    for a, b in edges:
        parent.setdefault(a, a)
        parent.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(parent[a], parent[b])
            changed |= parent[a] != m or parent[b] != m
            parent[a] = parent[b] = m
    assert got == parent


def test_fingerprints(spark, rows):
    got = {r.doc_id: r for r in sketch.digests(sketch.with_next(table(spark, rows))).collect()}
    ordered = sorted(rows)
    by_text = defaultdict(set)
    for k, (i, t) in enumerate(ordered):
        t, n = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        r, a, b = got[i], shingles(t), shingles(edited)
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        by_text[t].add(r.fingerprint)
        true = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(r.near_edited - true) < (1e-9 if len(a | b) <= sketch.K_SMALLEST else 0.2)
    assert len(got) == len(rows) and all(len(v) == 1 for v in by_text.values())


def test_fingerprints_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None), (1, "x y z"), (2, "q" * 9)], "doc_id long, text string")
    got = sketch.digests(sketch.with_next(df)).collect()
    assert sorted(r.n_chars for r in got) == [0, 3, 3, 5, 9] and len({r.fingerprint for r in got if r.doc_id is None}) == 1
    assert sketch.digests(sketch.with_next(df.limit(0))).count() == 0
    (alone,) = sketch.with_next(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert alone.edited == "abab"


def test_sketches_merge(spark):
    texts = [" ".join(str((i * 31 + j) % 500) for j in range(400)) for i in range(6)]
    parts = sketch.with_sketch(spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "g int, text string"))
    got = {r.g: list(r.sketch) for r in sketch.merged(parts, ["g"]).collect()}
    for g in (0, 1):
        every = sorted({v for r in parts.where(f"g = {g}").collect() for v in r.sketch})
        assert got[g] == every[: sketch.K_SMALLEST]
    row = sketch.merged(parts, ["g"]).where("g = 0")
    n = row.select(sketch.distinct_count(row["sketch"])).first()[0]
    true = len(set().union(*[shingles(t) for t in texts[::2]]))
    assert abs(n - true) < 0.35 * true
    assert row.select(sketch.containment(row["sketch"], row["sketch"])).first()[0] == 1.0


def test_pieces_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(1)
    parts = ["a", "the ", "ing", " ", "  ", "\n", "é", "▁", "12", "日本", "\U0001f600", "\t", "ß.", "\u0000", "　", "qzx"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(600)] + [None, "", " " * 500 + "x", "the " * 5000, "z" * 3000]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in pieces.encode_decode(df, MODEL).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert list(got[i].ids) == ids and got[i].decoded == sp.decode(ids)
    one = pieces.digests(pieces.encode_decode(df.where("doc_id = 3"), MODEL)).first()
    ids = sp.encode(texts[3])
    assert one.n_tokens == len(ids) and one.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert pieces.encode_decode(df.limit(0), MODEL).count() == 0


def test_passages(spark):
    rng = random.Random(2)
    text = lambda k: " ".join(str(rng.randrange(10**6)) for _ in range(k))
    passage = text(80).split(" ")
    fuzzy = list(passage)
    fuzzy[30] = "other"
    del fuzzy[55]
    rows = [(1, text(100)), (2, text(40) + " " + " ".join(passage) + " " + text(10)), (3, " ".join(fuzzy) + " " + text(60)), (4, None), (5, "short text"), (6, " ".join(passage[:30]) + " " + text(50))]
    got = chains.passages(table(spark, [*rows, rows[2]])).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.doc_id, r.source_id) == (3, 2) and (r.start_word, r.end_word) == (0, 79) and (r.source_start, r.source_end) == (40, 120)
    assert r.edits == 2 and r.identity > 0.97


def test_chains_are_best():
    rng = random.Random(4)
    for _ in range(200):
        parts = sorted({(rng.randrange(300), rng.randrange(300), rng.randint(chains.K_WORDS, 40)) for _ in range(rng.randint(1, 9))})

        def follows(p, q):
            return p[0] + p[2] - chains.K_WORDS + 1 <= q[0] and p[1] + p[2] - chains.K_WORDS + 1 <= q[1]

        def gap(p, q):
            inner = p[2] - chains.K_WORDS + 1
            return chains.GAP_COST * (q[0] - p[0] - inner + q[1] - p[1] - inner)

        best = {}
        for q in parts:
            best[q] = q[2] + max([0, *(best[p] - gap(p, q) for p in best if follows(p, q))])
        first = chains.chains(parts)[0]
        score = sum(p[2] for p in first) - sum(gap(p, q) for p, q in zip(first, first[1:]))
        assert abs(score - max(best.values())) < 1e-9


def parts_of_a_passage(copies):
    rng = random.Random(8)
    p = [str(rng.randrange(10**6)) for _ in range(60)]
    cuts = [p[:45], p[15:]] * copies + [p] + [p[:45], p[15:]] * copies + [p]
    return [(i + 1, " ".join(w)) for i, w in enumerate(cuts)], 2 * copies + 1, 4 * copies + 2


@pytest.mark.parametrize("copies", [1, 40])
def test_passage_with_documents_between(spark, copies):
    """Neither the first nor the previous document has the whole passage;
    also when its seeds have more than MANY occurrences."""
    rows, source, last = parts_of_a_passage(copies)
    want = [(last, 0, 60, source, 0, 60, 0)]
    for parts in (1, 7):  # the layout does not matter
        got = chains.passages(table(spark, rows).repartition(parts)).collect()
        assert [tuple(r)[:7] for r in got if r.doc_id == last] == want


def test_passages_with_evenly_spread_edits(spark):
    """Changed or inserted words after every 4, 5 or 6 and 9 equal ones:
    identity 0.8 to 0.9, no long run."""
    rng = random.Random(9)
    word = lambda: str(rng.randrange(10**6))
    rows, want = [], {}
    for n, (run, insert) in enumerate([(4, 0), (4, 1), (6, 0), (6, 1), (9, 0), (9, 1)]):
        passage, edited, k = [word() for _ in range(100)], [], 0
        while k < 100:
            edited += passage[k : k + run]
            if k + run < 100:
                edited.append(word())
            k += run + (not insert)
        rows.append((10 * n, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(30)])))
        rows.append((10 * n + 1, " ".join([word() for _ in range(40)] + edited + [word() for _ in range(40)])))
        want[10 * n + 1] = (10 * n, len(edited))
    got = {r.doc_id: r for r in chains.passages(table(spark, rows)).collect()}
    assert set(got) == set(want)
    for doc, (source, words_) in want.items():
        r = got[doc]
        assert r.source_id == source and r.identity >= 0.8
        # two equal words after an edit at an end gain nothing
        assert abs(r.start_word - 40) <= 1 and abs(r.end_word - 40 - words_) <= 3


def test_extension_goes_over_gaps():
    import numpy as np

    x = np.arange(60, dtype=np.uint32)
    y = np.concatenate([x[:10], [999], x[10:30], x[31:50], [777] * 10]).astype(np.uint32)
    assert chains.extension(x, y) == (50, 50, 2)
