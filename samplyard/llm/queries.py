"""Registered queries of the operators, over whole tables, and their SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.llm import (
    bottomk,
    centroids,
    hilbert,
    merkle,
    paritysketch,
    perplexity,
    quality,
    replication,
    resync,
    sharding,
    substrings,
    urlrules,
    warc,
)
from samplyard.llm.tables import read, staged

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def op1_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.judge_documents(read(spark, sf_dir, "documents"))


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), 24).drop("atom")


def op3_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.fingerprints(read(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_documents(docs, read(spark, sf_dir, "labels"))
    held_out = quality.fold(F.col("doc_id")) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", quality.predicted(F.col("score")).alias("predicted"))


def op6_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.pack(read(spark, sf_dir, "documents"), WORD_MODEL, 2048)


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op8_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paritysketch.near_groups(read(spark, sf_dir, "documents"), words=3, percent=90)


def op9_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of the mixed corpus, which is written whole, with texts, in its global order."""
    mixed = staged(replication.shuffle_globally(replication.replicate(read(spark, sf_dir, "documents"))), "mixed")
    return replication.shuffle_globally(mixed.select("doc_id", "source", "rate", "copies", "copy", "order_key"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resync.token_counts(read(spark, sf_dir, "documents"), PIECE_MODEL)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


def op12_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(read(spark, sf_dir, "pages"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, seed=1)


QUERIES = {
    f.__name__: f
    for f in (
        op1_perplexity,
        op2_minimax_shards,
        op3_bottom_k,
        op4_substring_dedup,
        op5_quality_classifier,
        op6_hilbert_packing,
        op7_url_rules,
        op8_parity_sketch_join,
        op9_poisson_mixing,
        op10_token_counts,
        op11_merkle_manifest,
        op12_seekable_warc,
        op13_centroids,
    )
}

#: The distribution function of a source is summed term by term, as the operator does.
ORACLES = {
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_seekable_warc": warc.ORACLE,
    "op13_centroids": centroids.oracle(),
    "op9_poisson_mixing": """
WITH RECURSIVE counted AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rated AS (
  SELECT source,
         1.0::DOUBLE / (SELECT sum(1.0::DOUBLE) FROM counted) * (SELECT sum(n) FROM counted)::DOUBLE / n::DOUBLE AS rate
  FROM counted
),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM rated
  UNION ALL
  SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1)
  FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate)) + 40
),
draws AS (
  SELECT doc_id, source,
         ('0x' || substr(md5('17:' || doc_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM documents
),
counts AS (
  SELECT d.doc_id, d.source, any_value(c.rate) AS rate, count(*) FILTER (WHERE c.total <= d.u) AS copies
  FROM draws d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source
  GROUP BY d.doc_id, d.source
)
SELECT doc_id, source, rate, copies::INTEGER AS copies, t.copy::INTEGER AS copy,
       ('0x' || substr(md5('18:' || doc_id || ':' || t.copy), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS order_key
FROM counts, unnest(range(copies)) AS t(copy)
""",
}
