"""A corpus run: documents pass through five operators of threadwarden.llm.

Each stage works on all that the one before kept. All but the last return the columns of
documents; the last returns token ids. Every stage is written to the shared folder, so a lost
executor repeats part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadwarden.llm import exact_dedup, minhash, mixing, sentencepiece_viterbi, toxicity
from threadwarden.sources.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Learned from the labelled documents among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    detector = toxicity.learn(docs, labels, toxicity.fold(F.col("doc_id"), 3) != 1)
    return toxicity.drop_toxic(docs, detector)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their weights, in training order."""
    return mixing.mix_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and whether decoding gives its text again."""
    return sentencepiece_viterbi.encode_documents(
        docs, sentencepiece_viterbi.default_model(), ("doc_id", "lang", "source")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", tokenise),
]

# Compression lengths, signatures and merges have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
