"""Mixing sources to target weights along a time-varying curriculum.

Only DataFrame functions. Every source has a weight schedule, a piecewise
linear function of training time in [0, 1]; its integral, scaled to the
source's target, is the cumulative demand of words. The documents of a
source come in a fixed shuffled order; a document whose first word is the
source's u-th gets the time at which the demand reaches u (the inverse of
the integral), and all documents are range-sorted by that time.

Targets: the total is shared by weight; a source stops at ``most_repeats``
times its size and the excess is shared again by weight until none is
above. A source is taken whole as often as its target allows and then up
to the exact rest, so the last document may be taken in part.

Null texts have size 0 and take nothing; a null source is one source,
ordered last; ties in the shuffled order fall to the id, then to the size
and the text. Repeated rows are separate documents. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5.0, 2.0, 1.0)
#: Weight over time by place in the order of sources, repeating: (time, weight) corners.
SCHEDULES = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)
ORDER_DIGITS = 3  # hex digits of the order that cut a source into 16 ** 3 ranges


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, total_share: float = 1.5, most_repeats: float = 2.0) -> DataFrame:
    """(source, source_size, kind, target) from (source, source_size), one
    row per source: a table of sources, not of documents. ``kind`` is the
    source's place in the cycle of weights."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = sizes.withColumn("kind", ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    cap = F.col("source_size") * F.lit(float(most_repeats))
    # filled up to their caps in this order, the sources before a place are
    # capped and the rest share what is left by weight
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "kind", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * F.lit(float(total_share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    filled = kinds.withColumn("weight", weight).withColumn("cap", cap).withColumn("level", level)
    # true from the first source that isn't capped on, and from there the level falls
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(whole)
    share = F.least(F.coalesce(level * F.col("weight"), F.col("cap")), "cap")
    return filled.withColumn("target", share).select("source", "source_size", "kind", "target")


def schedule_pieces(schedule: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(start time, length, weight at the start, slope, demand before) of
    each linear piece, with the whole integral scaled to 1."""
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))
    if area <= 0 or schedule[0][0] != 0 or schedule[-1][0] != 1:
        raise ValueError("a schedule goes from time 0 to 1 and has a positive integral")
    pieces, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        if t1 <= t0 or min(w0, w1) < 0:
            raise ValueError("times grow and weights are not negative")
        pieces.append((t0, t1 - t0, w0 / area, (w1 - w0) / (t1 - t0) / area, before))
        before += (t1 - t0) * (w0 + w1) / 2 / area
    return pieces


def time_of(share: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """The time at which a share (0 to 1) of the demand is reached."""
    out = None
    for t0, length, w0, slope, before in reversed(schedule_pieces(schedule)):
        rest = F.greatest(share - F.lit(before), F.lit(0.0))
        # w0 t + slope t^2 / 2 = rest, in the form that is stable for a slope of 0
        root = F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + rest * F.lit(2 * slope), F.lit(0.0)))
        here = F.least(F.lit(t0) + F.when(root > 0, rest * 2 / root).otherwise(F.lit(0.0)), F.lit(t0 + length))
        out = here if out is None else F.when(share < F.lit(following), here).otherwise(out)
        following = before
    return out


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES, total_share: float = 1.5, most_repeats: float = 2.0, carry: bool = False) -> DataFrame:
    """Per document: id, source, size, source_size, target, taken (words,
    repeats counted), copies (times it is started) and position (the time of its
    first copy; later copies follow at the times of ``copy_positions``),
    range-sorted by position; with ``carry``, the whole ``row`` in place of the sort.

    The running sum of sizes in a source is built from the sums of ranges
    of the order, so no source has to fit one task."""
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    source = F.col(source_col).cast("string")
    # a key that is never null and sorts as the source does, null last
    key = F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("source"), word_count(F.col(text_col)).alias("size"), order.alias("order"),
                       F.xxhash64(text_col).alias("tie"), *([F.struct(*docs.columns).alias("row")] if carry else [])).withColumn("range", F.substring("order", 1, ORDER_DIGITS))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ranges = Window.partitionBy("source").orderBy("range")
    base = F.coalesce(F.sum("range_size").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, total_share, most_repeats)
    facts = sums.select("source", "range", base.alias("base")).join(plan, "source")
    within = Window.partitionBy("source", "range").orderBy("order", F.col("id").asc_nulls_first(), "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0))).join(facts, ["source", "range"])
    start = F.col("base") + F.col("ahead")
    goal = F.floor("target")
    rounds = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    # floor of a double quotient may be one off for huge sizes
    rounds = rounds - (rounds * F.col("source_size") > goal).cast("long")
    placed = placed.withColumn("start", start).withColumn("rounds", rounds.cast("long"))
    rest = F.least(F.greatest(goal - F.col("rounds") * F.col("source_size") - F.col("start"), F.lit(0)), F.col("size"))
    placed = placed.withColumn("rest", rest).withColumn("copies", F.col("rounds") + (F.col("rest") > 0).cast("long"))

    def position(words: Column) -> Column:
        share = F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))
        out = time_of(share, schedules[-1])
        for k in range(len(schedules) - 2, -1, -1):
            out = F.when(F.col("kind") % len(schedules) == k, time_of(share, schedules[k])).otherwise(out)
        return out

    nth = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).otherwise(F.array().cast("array<bigint>"))
    words = F.transform(nth, lambda k: (F.col("start") + k * F.col("source_size")).cast("double"))
    out = placed.select(
        F.col("id").alias(id_col), F.when(F.col("source") != "1", F.expr("substring(source, 2)")).alias(source_col), "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + F.col("rest")).cast("long").alias("taken"), "copies",
        F.transform(words, position).alias("copy_positions"), position(F.col("start").cast("double")).alias("position"), *(["row"] if carry else []),
    )
    return out if carry else out.orderBy("position", id_col)


def in_training_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` once per copy that the mix starts, whole,
    range-sorted by the time of the copy; documents that the mix doesn't
    reach go."""
    rows = mixed(docs, carry=True, **options)
    copies = rows.select(F.explode("copy_positions").alias("position"), "row")
    return copies.orderBy("position", F.xxhash64("row")).select("row.*")


#: DuckDB SQL of the digest columns with the default parameters.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
k AS (SELECT *, list_extract([5.0, 2.0, 1.0]::DOUBLE[], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT) AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
f AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, weight DESC, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, weight DESC, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM k),
g AS (SELECT *, max(CASE WHEN lvl <= cap / weight THEN lvl END) OVER () AS l FROM f),
t AS (SELECT source, source_size, least(coalesce(l * weight, cap), cap) AS target FROM g),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
  floor(t.target)::BIGINT AS goal FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 3) AS target,
  (CASE WHEN source_size > 0 THEN (goal // source_size) * size + least(greatest(goal - (goal // source_size) * source_size - start, 0), size) ELSE 0 END)::BIGINT AS taken FROM p
"""
