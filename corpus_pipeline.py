"""The corpus pipeline: toxic documents go, one document of each group of
near copies stays, passages that repeat go, the sources are mixed to their
target weights, and the result is encoded.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all rows
of the stage before; all but the last return the columns of ``documents``.
Its results have no SQL form (fitted models, tokenizer), so tests hold it
against a brute-force version."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.llm import op1_toxicity, op2_substrings, op5_jaccard, op6_mix, op7_pieces
from attrix.llm.common import release, saved, ship, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't find toxic."""
    ship(spark)
    chain = op1_toxicity.fit_chain(docs, op1_toxicity.chain_labels(table(spark, sf_dir, "labels")), op1_toxicity.CATEGORIES)
    return op1_toxicity.scored(docs, chain).where("is_toxic = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of links stays;
    of rows that share it, the one with the smallest text; of rows equal in
    both, one."""
    ship(spark)
    return op5_jaccard.one_of_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier 100-byte string covers;
    characters cut in half go, and documents that lose all their bytes.
    Documents that had no text stay."""
    ship(spark)
    kept = op2_substrings.with_kept_text(docs, length=100, keep_null=True)
    return kept.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once per copy that the mix starts."""
    ship(spark)
    release(spark)  # the stage before leaves its shuffles
    return op6_mix.in_training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document of the mix."""
    ship(spark)
    return op7_pieces.digests(op7_pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", drop_repeated_passages),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage reads what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
