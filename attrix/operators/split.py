"""Repeatable stratified splits and seeded samples.

Rows are ordered inside each label by a seeded hash of the key (digits of
an md5, which SQL engines reproduce). Each label then sends its first
ceil(test%) rows to test, the next share to validation, the rest to
train: exact per-class shares, as a stratified shuffle split gives.

The per-label rank comes from ``ranking.running_sum``: hash-range buckets
with offsets, so no task holds a whole label. Rows without a label are a
class of their own and are split like the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .ranking import running_sum

def seeded_hash(key: str | Column, seed: int = K.SEED) -> Column:
    """The first 52 bits of md5('seed:key') as a long: keys of any type,
    another order for every seed, the same in any SQL engine."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def seeded_hash_sql(key: str, seed: int = K.SEED) -> str:
    return f"CAST(('0x' || md5('{seed}:' || CAST({key} AS VARCHAR))[1:13]) AS BIGINT)"


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_pct: int = 20,
    val_pct: int = 0,
    seed: int = K.SEED,
    **ranking_kw,
) -> DataFrame:
    """Add ``split`` in {train, val, test}. Percentages are integers of the
    whole; validation is carved from what remains after test, like two
    successive stratified splits (80/20, then 75/25 of the 80)."""
    hashed = df.withColumn("_h", seeded_hash(key, seed)).withColumn("_one", F.lit(1))
    ranked = running_sum(hashed, "_h", ["_one"], by=[label], tiebreak=[key], with_total=True, **ranking_kw)
    n_l = F.col("tot__one")
    n_test = F.floor((n_l * test_pct + 99) / 100)
    rest = 100 - test_pct
    n_val = F.floor(((n_l - n_test) * val_pct + rest - 1) / rest) if val_pct else F.lit(0)
    r = F.col("cum__one") - 1
    split = F.when(r < n_test, "test").when(r < n_test + n_val, "val").otherwise("train")
    return ranked.select(*df.columns, split.alias("split"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = K.SEED) -> DataFrame:
    """At most ``n`` rows, the same ones every run: the n smallest seeded
    hashes (each partition keeps its n best, then one small merge)."""
    return df.orderBy(seeded_hash(key, seed), F.col(key)).limit(n)


def save_splits(df: DataFrame, path: str, split_col: str = "split") -> str:
    """Write every split (train, val and test) as one parquet dataset
    partitioned by split; returns the path."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return path
