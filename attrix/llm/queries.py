"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_toxicity as toxicity
from . import op2_substrings as substrings
from . import op3_sketch as sketch
from . import op4_revisits as revisits
from . import op5_jaccard as jaccard
from . import op6_mix as mix
from . import op7_pieces as pieces
from . import op8_chains as chains
from . import op9_neighbours as neighbours
from . import op10_urls as urls
from . import op11_ids as ids
from . import op12_centroids as centroids
from . import op13_tries as tries
from .common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    """Bytes covered by an earlier 100-byte string, removed."""
    return substrings.digests(substrings.repeated_substrings(table(spark, sf_dir, "documents")))


@query("op5_jaccard_join", jaccard.ORACLE)
def op5_jaccard_join(spark, sf_dir):
    """Components of documents linked at Jaccard 0.75 on 5-word shingles."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query("op6_mix_sources", mix.ORACLE)
def op6_mix_sources(spark, sf_dir):
    """Words that the curriculum mix takes of every document."""
    return mix.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


@query("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir):
    """Digests of every document's ids and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents")
    return pieces.digests(pieces.encode_decode(docs, public_tokenizers.path(PIECE_MODEL)))


@query("op4_warc_revisits", revisits.ORACLE)
def op4_warc_revisits(spark, sf_dir):
    """Not-modified records of the crawl of all pages, resolved."""
    return revisits.listing(revisits.resolved(revisits.crawl(table(spark, sf_dir, "pages"))))


@query("op1_toxicity_chain")
def op1_toxicity_chain(spark, sf_dir):
    """Category probabilities and decisions of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit_chain(docs, toxicity.chain_labels(table(spark, sf_dir, "labels")), toxicity.CATEGORIES)
    return toxicity.scored(docs, chain).drop("text")


@query("op3_fingerprints")
def op3_fingerprints(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return sketch.digests(sketch.with_next(table(spark, sf_dir, "documents")))


@query("op9_kmeans_tree")
def op9_kmeans_tree(spark, sf_dir):
    """Ten nearest vectors of every hundredth one."""
    return neighbours.neighbours(table(spark, sf_dir, "embeddings"))


@query("op10_url_filter", urls.ORACLE)
def op10_url_filter(spark, sf_dir):
    """Rule and verdict of every page's url."""
    return urls.judged(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@query("op8_fuzzy_passages")
def op8_fuzzy_passages(spark, sf_dir):
    """Passages of 50 words or more that an earlier document has, nearly or exactly."""
    return chains.passages(table(spark, sf_dir, "documents"))


@query("op11_token_ids")
def op11_token_ids(spark, sf_dir):
    """Places and digests of every document's ids, read back from the files."""
    return ids.digests(ids.stored(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER)))


@query("op12_centroids", centroids.ORACLE)
def op12_centroids(spark, sf_dir):
    """Cluster of every vector after three rounds from 16 of them."""
    return centroids.listing(*centroids.clustered(table(spark, sf_dir, "embeddings")))


@query("op13_prefix_trie", tries.ORACLE)
def op13_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of all conversations, rebuilt as branches."""
    return tries.nodes(table(spark, sf_dir, "conversations"))
