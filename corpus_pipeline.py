"""The training-data pipeline: five stages, each an operator of boxloom.llm, from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's `docs`. All but the last return the columns of `documents`, whatever they are;
every stage sees all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxloom.llm import exact_dedup, jaccard, mixing, packing, quality
from boxloom.llm.common import materialise, scratch, table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is within their language's limit."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of largest id."""
    return exact_dedup.survivors(docs, exact_dedup.DigestIndex(spark, scratch(spark, "digest-index")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links: five-word shingles, similarity 0.8 or more."""
    return jaccard.survivors(docs, width=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the production weights, each up to twice."""
    return mixing.mixed(docs, budget=1.0, epochs=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048."""
    return packing.pack(docs, size=2048)


STAGES = [
    ("quality classifier", accept_quality),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The perplexity model and the tokenizer are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what lies between them is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{number}")
    return docs
