"""A corpus pipeline over ``documents``: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplyard.llm import hilbert, paritysketch, quality, replication, substrings
from samplyard.llm.queries import WORD_MODEL
from samplyard.llm.tables import read, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows the classifier accepts; labels are those of the input, on the documents there are."""
    scored = quality.score_documents(docs.select(*COLUMNS), read(spark, sf_dir, "labels"))
    return scored.filter(quality.predicted(F.col("score")) == 1).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 80 percent alike): the one with
    the least doc_id; texts without words stay.

    Rows that share a doc_id, or have none, stay one for each distinct text: the one least in lang,
    source and n_chars.
    """
    docs = docs.select(*COLUMNS)
    groups = staged(paritysketch.near_groups(docs, words=5, percent=80), "groups")
    kept = groups.filter("component_id = doc_id").select("doc_id").distinct()
    rows = docs.join(kept, "doc_id", "left_semi").unionByName(docs.filter("doc_id IS NULL"))
    least = F.min(F.struct("lang", "source", "n_chars")).alias("least")
    one = rows.groupBy("doc_id", F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text"), least)
    return one.select("doc_id", "text", "least.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from all but the first document; a document that keeps no word goes."""
    cut = substrings.remove_repeats(docs.select(*COLUMNS)).filter("n_removed = 0 OR n_removed < n_words")
    text = F.coalesce("kept_text", "text")
    return cut.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("n_removed") > 0, F.char_length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source with the same expected number of rows, in a global random order."""
    return replication.shuffle_globally(replication.replicate(docs.select(*COLUMNS))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, neighbours along the curve together."""
    return hilbert.pack(docs, WORD_MODEL, 2048)


STAGES = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express the first stage; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
