"""The corpus pipeline: five stages over the documents table, each written as Parquet and read again by the next.

    toxicity      documents that the pattern grammar scores 0.5 or more are left out
    exact_dedup   of equal texts the one with the smallest doc_id stays
    near_dedup    of each group of near copies (5-word shingles, similarity 0.8) one stays
    mixing        documents are repeated or left out so that sources meet their target weights
    bpe           the kept documents' tokens: counts and digests of ids and of the decoded text
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from showbill.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from showbill.llm.common import documents, settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.report(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: Learned scores, sketches and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, one per document copy in the mix: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settle(docs)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
