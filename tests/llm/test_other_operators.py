"""Toxicity, revisits, mixing, neighbours, url filter and the pipeline:
oracle SQL, brute force, held-out labels, odd rows and empty tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from attrix.llm import op1_toxicity as toxicity
from attrix.llm import op4_revisits as revisits
from attrix.llm import op6_mix as mix
from attrix.llm import op9_neighbours as neighbours
from attrix.llm import op10_urls as urls
from attrix.llm import queries as llm
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert rows_of(E.queries()[name](spark, SF).toPandas()) == rows_of(con.execute(E.oracle_sql()[name]).df())


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6)))
    rows, labels = [], []
    for i in range(900):
        insult, threat = rng.random() < 0.3, False
        w = [word() for _ in range(rng.randint(5, 60))]
        if insult:
            w.insert(rng.randrange(len(w)), "Zorgo" + word() + "!")
            threat = rng.random() < 0.5
            w += ["kilbo"] * threat
        rows.append((i, " ".join(w), "p"))
        labels.append((i, int(insult), int(threat)))
    docs = spark.createDataFrame([*rows, (900, None, "p"), (901, "", "p"), (None, "x", "p")], "doc_id long, text string, p_insult string")
    known = spark.createDataFrame([*labels[:600], labels[0], (5000, 1, None)], "doc_id long, insult int, threat int")
    chain = toxicity.fit_chain(docs, known, ["insult", "threat"])
    assert len(chain.weights[1]) == len(chain.names[1]) + 2  # reads the first category
    got = {r.doc_id: r for r in toxicity.scored(docs, chain).collect()}
    held = labels[600:]
    for c in (1, 2):
        name = ("is_insult", "is_threat")[c - 1]
        assert np.mean([got[x[0]][name] == x[c] for x in held]) > 0.97
    assert len(got) == 903 and got[900].is_insult == 0
    none = toxicity.fit_chain(docs, known.limit(0), ["insult", "threat"])
    assert {r.is_insult for r in toxicity.scored(docs, none).collect()} == {0}
    assert toxicity.scored(docs.limit(0), chain).count() == 0


def test_linear_model_reaches_the_optimum():
    rng = np.random.default_rng(0)
    n, m = 300, 12
    x = (rng.random((n, m)) < 0.3).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ rng.normal(size=m) * 2 - 0.5)))).astype(float)
    row, col = np.nonzero(x)
    w = toxicity.fit_linear(row, col, m, np.zeros((n, 0)), y, steps=4000)
    gap = toxicity.sigmoid(x @ w[:m] + w[-1]) - y
    assert np.abs(x.T @ gap / n + toxicity.PENALTY * w[:m]).max() < 2e-3


def test_revisits(spark):
    h = lambda **k: [(n.replace("_", "-"), v) for n, v in k.items()]
    rows = [
        (1, "http://www.A.com/x/?b=2&a=1&utm_source=q#f", 100, 200, h(ETag='"v1"', Content_Length="5", Age="1")),
        (2, "https://a.com/x?a=1&b=2", 200, 200, h(ETag='"v2"', Content_Length="7", Age="1")),
        (3, "https://a.com:443/x/?a=1&b=2", 200, 304, h(etag='W/"v1"', age="9", content_length="0")),
        (4, "https://a.com/x?a=1&b=2", 300, 304, h(etag='"v1"')),
        (5, "https://a.com/x?a=1&b=2", 900000, 304, h(etag='"v2"', date="d")),
        (6, "https://b.org/", 50, 304, h(etag='"v2"')),
        (7, None, 60, 304, h()),
        (8, "http://c.org", 1, 200, h(Last_Modified="m")),
        (9, "http://c.org/", 2, 304, h(last_modified="m")),
        (10, "http://c.org", 3, 304, h()),
        (11, None, 1, 200, h()),
    ]
    df = spark.createDataFrame(rows, "record_id long, url string, time long, status int, headers array<struct<name: string, value: string>>")
    for ranges in (1, 7, 512):
        got = {r.record_id: r for r in revisits.resolved(df, ranges).collect()}
        assert {k: (r.response_id, r.outcome) for k, r in got.items()} == {
            3: (1, "etag"), 4: (None, "mismatch"), 5: (2, "etag"), 6: (None, "missing"), 7: (None, "missing"), 9: (8, "last-modified"), 10: (None, "mismatch")}
        assert {(e["name"].lower(), e["value"]) for e in got[3].headers} == {("etag", 'W/"v1"'), ("age", "9"), ("content-length", "5")}
    assert revisits.resolved(df.limit(0)).count() == 0


def test_mix(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randint(0, 40)), rng.choice(["a", "b", "c", "d", None]), "k") for i in range(400)]
    rows += [(400, None, "e", "k"), (401, "", "zz", "k"), (3, rows[3][1], rows[3][2], "k"), (None, "x y", "a", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mix.mixed(df).collect()
    assert len(got) == len(rows) and got == sorted(got, key=lambda r: r.position)
    total = sum(r.size for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size and r.copies == len(r.copy_positions)
        assert all(0 <= p <= 1 for p in r.copy_positions) and list(r.copy_positions) == sorted(r.copy_positions)
    names = sorted((s for s in by if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    size = {s: sum(r.size for r in by[s]) for s in by}
    # water filling, one capped source after another
    open_, left, want = set(names), 1.5 * total, {}
    while open_:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 2.0 * size[s]
            left -= want[s]
        open_ -= over
    for s in by:
        assert abs(by[s][0].target - want[s]) < 1e-6 * max(1, want[s])
        assert abs(sum(r.taken for r in by[s]) - want[s]) <= 1
    again = mix.mixed(df.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken, r.position)
    assert sorted(map(key, got)) == sorted(map(key, again))
    order = mix.in_training_order(df)
    assert order.columns == df.columns and order.count() == sum(r.copies for r in got)
    assert mix.mixed(df.limit(0)).count() == 0


def test_schedule_inverse(spark):
    for schedule in mix.SCHEDULES:
        times = [t / 50 for t in range(51)]
        xs = np.linspace(0, 1, 100001)
        w = np.interp(xs, [c[0] for c in schedule], [c[1] for c in schedule])
        area = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
        demand = np.interp(times, xs, area / area[-1])
        df = spark.createDataFrame([(t, float(d)) for t, d in zip(times, demand)], "t double, u double")
        off = df.select(F.max(F.abs(mix.time_of(F.col("u"), schedule) - F.col("t")))).first()[0]
        assert off < 1e-6


@pytest.mark.parametrize("hot", [False, True])
def test_neighbours(spark, monkeypatch, hot):
    monkeypatch.setattr(neighbours, "BIN_ROWS", 100)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16)) + rng.integers(0, 6, 3000)[:, None]
    if hot:
        x[::3] = x[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(5000, None, 1), (5100, [0.0] * 16, 1), (5200, [float("nan")] * 16, 1), (5300, [1.0], 1), (None, x[1].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = {}
    for r in neighbours.neighbours(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 100))
    found = 0
    for q, own in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        true = np.lexsort((np.arange(len(d)), d))[:10]
        own = sorted(own)
        assert [r for r, _, _ in own] == list(range(1, 11)) and all(abs(d[v] - s) < 1e-12 for _, v, s in own)
        found += len(set(true) & {v for _, v, _ in own})
    assert found >= 0.9 * 10 * len(got)


def test_neighbours_of_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (7, [1.0, 0.0]), (3, [1.0, 0.0]), (100, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.neighbours(df).collect())
    assert got == [(0, 1, 3), (0, 2, 7), (0, 3, 100), (100, 1, 0), (100, 2, 3), (100, 3, 7)]
    assert neighbours.neighbours(df.limit(0)).count() == 0


def test_neighbours_of_huge_vectors(spark):
    rows = [(100, [1e200, 0.0]), (1, [-1e200, 0.0]), (2, [1e200, 5e199]), (3, [1.7e308, 1.7e308]), (200, [-1e308, 0.0]), (4, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.neighbours(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert [i for i, _ in got[100]][:3] == [2, 4, 1] and got[100][0][1] == pytest.approx(5e199) and got[100][2][1] == pytest.approx(2e200)
    assert len(got[100]) == len(got[200]) == 5 and got[200][-1][0] == 3 and got[200][-1][1] == float("inf")


def test_urls(spark):
    rng = random.Random(3)
    hosts = ["example.com", "WWW.example.com", "a.www.example.com", "notexample.com", "x.net", "net", "com", "", "user@x.com:80", "é.net"]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/?q#z", "#t", "?u=/en/", "/EN/"]
    rows = [(i, rng.choice(["http://", "x://", ""]) + h + p, "v") for i, (h, p) in enumerate((h, p) for h in hosts for p in paths)]
    rows += [(900, None, "v"), (901, "", "v"), (902, "a://b://example.com/en/", "v"), (0, "http://x.net/es/", "v")]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    tables = [urls.judged(df), urls.judged(df, most_index_bytes=0)]
    (a, b) = (sorted((r.page_id, str(r.url), r.host, r.path, str(r.rule), r.verdict) for r in t.collect()) for t in tables)
    assert a == b and len(a) == len(rows)
    for _, url, host, path, rule, verdict in a:
        rest = url.split("://", 1)[1] if "://" in url else ""
        raw = rest
        for c in "/?#":
            raw = raw.split(c)[0]
        assert host == raw.translate(str.maketrans(urls.UPPER, urls.LOWER)) and path == rest[len(raw) :].split("?")[0].split("#")[0]
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (rule, verdict) == ((max(fits)[2], max(fits)[3]) if fits else ("None", "allow"))


def test_colliding_keys_are_confirmed():
    index = urls.RuleIndex(urls.build_index(urls.RULES, key=lambda t: len(t) % 3), key=lambda t: len(t) % 3)
    assert index.judge(["a.net", "b.com", "q.org"], ["/es/x", "/es/x", "/es/x"]) == (["net/es/", "com/", None], ["block", "allow", "allow"])


def test_pipeline(spark):
    """Each stage against what its operators' brute force implies."""
    import corpus_pipeline as pipeline

    from attrix.llm.common import saved

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = [docs]
    for name, stage in pipeline.STAGES:
        kept.append(saved(stage(spark, kept[-1], SF), name))
    assert all(k.columns == docs.columns for k in kept[:-1])
    ids = [[r.doc_id for r in k.select("doc_id").collect()] for k in kept]
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:]))
    clean = [i for i, t in labels.items() if not t]
    assert len(set(clean) & set(ids[1])) >= 0.97 * len(set(clean) & set(ids[0]))
    from tests.llm.test_text_operators import components_by_force, removed_by_force

    groups = components_by_force([(r.doc_id, r.text) for r in kept[1].collect()])
    assert sorted(ids[2]) == sorted(i for i, (_, c) in groups.items() if i == c)
    gone = removed_by_force([(r.doc_id, r.text) for r in kept[2].collect()], 100)
    assert set(ids[3]) >= {i for i, g in gone.items() if g[0] - g[1] > 3}
    sizes = {r.doc_id: r.copies for r in mix.mixed(kept[3]).collect()}
    assert sorted(ids[4]) == sorted(i for i, c in sizes.items() for _ in range(c))
    assert sorted(ids[5]) == sorted(ids[4]) and pipeline.ORACLE_SQL is None


def test_pipeline_keeps_texts_it_does_not_change(spark):
    """Null and empty texts pass every stage that doesn't judge them; rows
    that share an id or have none are told apart."""
    import corpus_pipeline as pipeline

    long = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"term{i}" for i in range(40))
    rows = [(1, None, "a"), (2, "", "a"), (3, " ", "b"), (4, long, "b"), (5, long, "c"), (6, other, "a"), (6, long, "a"), (6, other, "b"), (None, long + " more", "b"), (None, other + " else here", "c"), (None, None, "c"), (7, "x" * 250, "a")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars int")
    some = lambda df: sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "", r.text is None, r.source) for r in df.collect())
    one = pipeline.drop_near_copies(spark, docs, SF)
    # null ids come first: of each group the first row of the first id stays
    want = [(None, long + " more", "b"), (None, other + " else here", "c"), (None, None, "c"), (1, None, "a"), (2, "", "a"), (3, " ", "b"), (7, "x" * 250, "a")]
    assert some(one) == sorted(((i is not None, i or 0), t or "", t is None, s) for i, t, s in want)
    left = pipeline.drop_repeated_passages(spark, docs, SF)
    kept = {(r.doc_id, r.source): r for r in left.where("doc_id <= 3").collect()}
    assert kept[1, "a"].text is None and kept[2, "a"].text == "" and kept[3, "b"].text == " " and kept[1, "a"].n_chars == 0
    assert left.where("doc_id = 7").first().text == "x" and left.where("doc_id = 5").count() == 0
    for stage in (one, left):
        assert stage.columns == docs.columns
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def plain_chain(rows, labels, folds, categories):
    """The chain fitted by one process on sets of feature names."""
    have = {}
    for i, t in rows:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        have[i] = sorted(set(toxicity.block_features(raw, np.array([0, len(raw)]))[1].tolist()))
    known = sorted(i for i in labels if i in have)
    y = np.array([labels[i] for i in known], float)
    n = len(known)
    count = {}
    for i, own in zip(known, y):
        for f in have[i]:
            c = count.setdefault(f, [0, *[0] * len(categories)])
            c[0] += 1
            for k, v in enumerate(own):
                c[1 + k] += v
    count = {f: c for f, c in count.items() if c[0] >= toxicity.LEAST_DOCUMENTS}
    fold = np.array([folds[i] for i in known])
    earlier, seen = np.zeros((n, 0)), np.zeros((len(rows), 0))
    for k in range(len(categories)):
        share = y[:, k].mean()
        far = lambda f: abs(count[f][1 + k] - count[f][0] * share) / np.sqrt(count[f][0] * share * (1 - share) + 1)  # noqa: B023, E731
        signed = lambda f: np.uint32(f).view(np.int32)
        names = sorted(sorted(count, key=lambda f: (-far(f), signed(f)))[: toxicity.MOST_FEATURES])
        place = {f: c for c, f in enumerate(names)}

        def pairs(ids):
            return tuple(np.array([(r, place[f]) for r, i in enumerate(ids) for f in have[i] if f in place], np.int64).reshape(-1, 2).T)  # noqa: B023

        def fit(train):
            return toxicity.fit_linear(*pairs([known[r] for r in train]), len(names), earlier[train], y[train, k])  # noqa: B023

        def says(w, ids, before):
            r, c = pairs(ids)
            return toxicity.sigmoid(np.bincount(r, weights=w[c], minlength=len(ids)) + before @ w[len(names) : len(names) + before.shape[1]] + w[-1])  # noqa: B023

        final, out = fit(np.arange(n)), np.zeros(n)
        for m in set(fold):
            held = np.flatnonzero(fold == m)
            out[held] = says(fit(np.flatnonzero(fold != m)), [known[r] for r in held], earlier[held])
        seen = np.column_stack([seen, says(final, [i for i, _ in rows], seen)])
        earlier = np.column_stack([earlier, out])
    return seen


def test_toxicity_equals_a_plain_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(150).cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = {r.doc_id: (r.low_quality, r.toxic) for r in toxicity.chain_labels(labels).collect()}
    chain = toxicity.fit_chain(docs, toxicity.chain_labels(labels), toxicity.CATEGORIES)
    got = {r.doc_id: r for r in toxicity.scored(docs, chain).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    folds = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(toxicity.FOLDS)).cast("int").alias("f")).collect()}
    want = plain_chain(rows, known, folds, toxicity.CATEGORIES)
    assert sum(i in known for i, _ in rows) > 30
    for (i, _), p in zip(rows, want):
        assert got[i].p_low_quality == pytest.approx(p[0], abs=2e-3) and got[i].p_toxic == pytest.approx(p[1], abs=2e-3)
