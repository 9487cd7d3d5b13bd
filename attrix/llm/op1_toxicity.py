"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models; each model
also reads the probabilities of the categories before it. Those inputs are
out-of-fold predictions while fitting, so a later model learns from
earlier probabilities as they will be on unseen texts.

Features are presences of words (runs of letters and digits, lower case),
of their first 4, 5 and 6 bytes, and of ranges of a few style ratios,
named by 32-bit hashes. Those that a category's labels depend on most are
kept. The models are fitted on at most ``most_labelled`` labelled
documents (by a hash of the id); every document is scored.

Null and empty texts have no word features and are scored like any other
text. Documents without an id are scored but can't be labelled; of several
texts with one id the smallest is fitted, all are scored. Repeated
label rows count once (the greatest label), null labels not at all; a
category without two classes has its share of positives as probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from . import kernels as K
from .common import saved

MOST_LABELLED = 10_000
FOLDS = 5
MOST_FEATURES = 1024  # of each category
LEAST_DOCUMENTS = 5  # labelled documents that a feature must be in
PENALTY = 1e-4
BLOCK_BYTES = 1 << 18  # of text whose features are made at once
PREFIXES = (4, 5, 6)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def lowered(raw: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the Latin-1 letters in UTF-8."""
    out = K._LOWER[raw]
    if len(raw) > 1:
        capital = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        out[1:][capital] += 32
    return out


def block_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of a block, with repeats."""
    low = lowered(raw)
    n = len(raw)
    rows = len(offsets) - 1
    length = np.diff(offsets)
    out_row, out = [], []
    if n:
        letter = _LETTER[raw]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins, ends = letter.copy(), letter.copy()
        begins[1:] &= ~letter[:-1] | edge[1:-1]
        ends[:-1] &= ~letter[1:] | edge[1:-1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        row = np.searchsorted(offsets, start, "right") - 1
        power = np.full(n + 1, K._C1, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        scale = np.uint64(pow(pow(int(K._C1), -1, 1 << 64), n, 1 << 64))

        def name(a, b, tag):
            return K.mix((total[b] - total[a]) * power[n - a] * scale + np.array([tag], np.uint64) * K._C2)

        out_row.append(row)
        out.append(name(start, end, 1))
        for m in PREFIXES:
            long = end - start >= m
            out_row.append(row[long])
            out.append(name(start[long], start[long] + m, m))
    # ratios in ranges: capitals, marks, digits, lines, letters of words, length
    sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    size = np.maximum(length, 1)
    letters, white = sums(_LETTER[raw]), sums(K._WHITE[raw])
    ratios = (sums(_UPPER[raw]) / np.maximum(letters, 1), (length - letters - white) / size, sums((raw >= 48) & (raw <= 57)) / size, sums(raw == 10) / size, letters / np.maximum(white + 1, 1) / 32)
    for t, ratio in enumerate((*ratios, np.log2(size) / 32)):
        out_row.append(np.arange(rows))
        out.append(K.mix(np.minimum(ratio * 20, 20).astype(np.uint64) + np.uint64((t + 100) << 8)))
    return np.concatenate(out_row), np.concatenate(out) >> np.uint64(32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_linear(row: np.ndarray, col: np.ndarray, width: int, earlier: np.ndarray, y: np.ndarray, steps: int = 200) -> np.ndarray:
    """Weights (features, earlier probabilities, constant) of a logistic
    model on presences (row, col), by accelerated gradient descent with a
    ridge penalty. One class only: all zero but the constant."""
    n, m = len(y), earlier.shape[1]
    share = float(y.mean()) if n else 0.0
    w = np.zeros(width + m + 1)
    w[-1] = np.log((share + 1e-6) / (1 - share + 1e-6))
    if share in (0.0, 1.0):
        return w
    per_row = np.bincount(row, minlength=n)
    # bounds on the curvature, weight by weight
    reach = per_row.max(initial=0) if n else 0
    step = 1 / (0.25 * np.concatenate([np.maximum(np.bincount(col, weights=per_row[row] + m + 1.0, minlength=width), 1.0),
                                      np.full(m, n * (reach + m + 1.0)), [n * (per_row.mean() + m + 1.0)]]) / n + PENALTY)
    look, t = w.copy(), 1.0
    for _ in range(steps):
        z = np.bincount(row, weights=look[col], minlength=n) + earlier @ look[width : width + m] + look[-1]
        gap = (sigmoid(z) - y) / n
        grad = np.concatenate([np.bincount(col, weights=gap[row], minlength=width), earlier.T @ gap, [gap.sum()]])
        grad[:-1] += PENALTY * look[:-1]
        new = look - step * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if ((new - w) * (look - new)).sum() > 0:  # it overshoots
            t_new = 1.0
        if np.abs(new - w).max() < 1e-4:
            return new
        look = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from 0.05 to 0.95 with the best F1, nearest to 0.5 on ties."""
    cuts = np.arange(1, 20) / 20
    f1 = [2 * ((p >= c) & (y == 1)).sum() / max(1, (p >= c).sum() + (y == 1).sum()) for c in cuts]
    return float(min(cuts, key=lambda c: (-f1[int(round(c * 20)) - 1], abs(c - 0.5))))


@dataclass
class Chain:
    """Fitted models: sorted feature names and weights by category."""

    categories: list[str]
    names: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    cuts: list[float] = field(default_factory=list)  # probabilities from which a category holds

    def probabilities(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        """(rows, categories) in chain order."""
        out = np.zeros((rows, len(self.categories)))
        for c, (names, w) in enumerate(zip(self.names, self.weights)):
            z = np.full(rows, w[-1])
            if len(names):
                spot = np.minimum(np.searchsorted(names, feature), len(names) - 1)
                hit = names[spot] == feature
                pair = np.unique(row[hit] * len(names) + spot[hit])
                z += np.bincount(pair // len(names), weights=w[pair % len(names)], minlength=rows)
            z += out[:, :c] @ w[len(names) : len(names) + c]
            out[:, c] = sigmoid(z)
        return out


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
              most_labelled: int = MOST_LABELLED, folds: int = FOLDS) -> Chain:
    """Fit on labelled documents; ``categories`` are 0/1 columns of ``labels``."""
    chain = Chain(list(categories))
    known = labels.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).cast("int").alias(c) for c in categories]).dropna()
    known = known.groupBy("id").agg(*[F.max(c).alias(c) for c in categories])
    known = known.orderBy(F.xxhash64("id"), "id").limit(most_labelled)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offsets in K.text_blocks(batch.column(1), BLOCK_BYTES):
                row, value = block_features(raw, offsets)
                by = np.lexsort((value, row))
                row, value = row[by], value[by]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
                row, value = row[new], value[new]
                ends = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(value.astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists], names=["id", "features"])

    # the sample is bounded, so it may be broadcast to the scan of the texts
    ids = known.select("id")
    rows = texts.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text")).mapInArrow(features, "id long, features array<int>")
    rows = saved(rows.join(F.broadcast(known), "id").withColumn("fold", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(folds)).cast("int")), "labelled")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            value = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            each, at = np.unique(value, return_inverse=True)
            sums = [np.bincount(at, weights=w, minlength=len(each)).astype(np.int64) for w in (np.ones(len(at)), *(batch.column(1 + c).to_numpy()[row] for c in range(len(categories))))]
            yield pa.RecordBatch.from_arrays([pa.array(each), *map(pa.array, sums)], names=["f", "n", *categories])
            del value, row, each, at, sums
            K.give_back()

    counted = rows.select("features", *categories).mapInArrow(counts, "f int, n long" + "".join(f", `{c}` long" for c in categories))
    counted = counted.groupBy("f").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in categories])
    counted = saved(counted.where(F.col("n") >= LEAST_DOCUMENTS), "features")
    total = rows.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in categories]).first()

    for c in categories:
        n, share = total["n"], total[c] / max(1, total["n"])
        if 0 < share < 1:
            # distance of the positives from what independence expects, in standard deviations
            z = F.abs(F.col(c) - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1)
            best = counted.orderBy(z.desc(), "f").limit(MOST_FEATURES).select("f").toPandas()["f"].to_numpy(np.int32)
        else:
            best = np.zeros(0, np.int32)
        chain.names.append(np.sort(best.view(np.uint32)).astype(np.uint64))

    every = np.unique(np.concatenate([np.zeros(0, np.uint64), *chain.names]))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Features of the models only, as places in ``every``."""
        for batch in batches:
            lists = batch.column(0)
            value = lists.flatten().to_numpy().view(np.uint32).astype(np.uint64)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            spot = np.minimum(np.searchsorted(every, value), max(0, len(every) - 1))
            hit = every[spot] == value if len(every) else np.zeros(len(value), bool)
            ends = np.searchsorted(row[hit], np.arange(len(lists) + 1)).astype(np.int32)
            own = pa.ListArray.from_arrays(pa.array(ends), pa.array(spot[hit].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([own, *batch.columns[1:]], names=["features", *batch.schema.names[1:]])
            del value, row, spot, hit, ends, own
            K.give_back()

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "features")
    rows = saved(rows.select("features", *[x for x in rows.columns if x != "features"]).mapInArrow(chosen, f"features array<int>, {types}"), "chosen")

    earlier: list[str] = []
    for c, names in zip(categories, chain.names):
        before = list(earlier)
        place = np.full(len(every) + 1, -1)  # of the chain's features among this model's
        place[np.searchsorted(every, names)] = np.arange(len(names))

        def fit(key: tuple, part: pa.Table) -> pa.Table:
            model, part = key[0].as_py(), part.combine_chunks()
            column = lambda name: part.column(name).to_numpy()
            lists = part.column("features").combine_chunks()
            col = place[lists.flatten().to_numpy()]
            row = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
            row, col = row[col >= 0], col[col >= 0]
            p = np.stack([column(c) for c in before], axis=1) if before else np.zeros((len(part), 0))
            y = column("__y").astype(float)
            train = column("fold") != model
            spot = np.cumsum(train) - 1
            own = train[row]
            w = fit_linear(spot[row[own]], col[own], len(names), p[train], y[train])
            if model < 0:
                out = [pa.array([None], pa.int64()), pa.array([0.0]), pa.array([w.tolist()], pa.list_(pa.float64()))]
            else:
                z = np.bincount(row, weights=w[col], minlength=len(part)) + p @ w[len(names) : len(names) + len(before)] + w[-1]
                out = [pa.array(column("id")[~train]), pa.array(sigmoid(z)[~train]), pa.nulls(int((~train).sum()), pa.list_(pa.float64()))]
            del lists, row, col, own
            K.give_back()
            return pa.Table.from_arrays(out, names=["id", "p", "w"])

        models = rows.withColumn("__y", F.col(c)).withColumn("model", F.explode(F.array(*[F.lit(m) for m in range(-1, folds)])))
        fitted = models.groupBy("model").applyInArrow(fit, "id long, p double, w array<double>")
        fitted = saved(fitted, "fits")
        final = fitted.where("id is null").first()
        chain.weights.append(np.array(final["w"]) if final else np.array([*np.zeros(len(names) + len(before)), -13.8]))
        out_of_fold = fitted.where("id is not null").select("id", "p")
        seen = rows.select("id", c).join(F.broadcast(out_of_fold), "id").select("p", c).toPandas()  # the bounded sample
        chain.cuts.append(best_cut(seen["p"].to_numpy(), seen[c].to_numpy()))
        earlier.append(f"p_{c}")
        rows = rows.join(F.broadcast(out_of_fold.withColumnRenamed("p", earlier[-1])), "id")
    return chain


def scored(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` with ``p_<category>`` and the 0/1 ``is_<category>``. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    new = [f"p_{c}" for c in chain.categories] + [f"is_{c}" for c in chain.categories]
    docs = docs.drop(*new)
    rows = docs.withColumn("__text", F.col(f"`{text_col}`").cast("string"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offsets in K.text_blocks(batch.column(len(kept)), BLOCK_BYTES):
                p = shared.value.probabilities(*block_features(raw, offsets), j - i)
                columns = [batch.column(c).slice(i, j - i) for c in range(len(kept))]
                columns += [pa.array(p[:, c]) for c in range(p.shape[1])]
                columns += [pa.array((p[:, c] >= shared.value.cuts[c]).astype(np.int32)) for c in range(p.shape[1])]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    fields = [StructField(name, DoubleType() if name.startswith("p_") else IntegerType()) for name in new]
    return rows.mapInArrow(run, StructType([*docs.schema.fields, *fields]))


def chain_labels(labels: DataFrame) -> DataFrame:
    """The label table's categories: low_quality (quality 0), then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


CATEGORIES = ("low_quality", "toxic")
