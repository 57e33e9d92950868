"""Exact deduplication by skew-safe combining (DataFrame operations only).

Every text is normalised and digested. Copies are combined three times, and each time rows are one group only if
digest and whole normalised text agree:

1. within each task (the map-side half of the first aggregation), so a task sends one row per text;
2. over salted digest groups, the salt being the task's number, so a text that every task holds is met by many reducers;
3. over the salts' winners.

What joins back to the documents is the digest alone, a few bytes, from a table that is written once: stage 3 has compared all whole texts of a digest,
and fails the job should one digest ever stand for two texts, rather than merge them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showbill.llm.common import SPACES, heavy_light_lookup, settle


def normalised(text="text"):
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def exact_groups(docs: DataFrame, salts: int = 16) -> DataFrame:
    """Groups of equal texts: digest (binary), keep_id, group_size. Reads doc_id and text."""
    texts = docs.select("doc_id", normalised().alias("_norm")).withColumn("digest", F.unhex(F.sha2("_norm", 256)))
    local = texts.withColumn("_salt", F.spark_partition_id() % salts)
    salted = local.groupBy("digest", "_salt", "_norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # Dealt by the digest, a whole group of texts is in one task, and both steps below need no further shuffle.
    winners = salted.repartition("digest").groupBy("digest", "_norm").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return winners.groupBy("digest").agg(F.count("*").alias("_texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")).select(
        "digest",
        "keep_id",
        F.when(F.col("_texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long")).alias("group_size"),
    )


def exact_dedup(docs: DataFrame, salts: int = 16) -> DataFrame:
    """Adds keep_id, group_size, kept and text_sha256 to every row of docs.

    Null texts count as empty and are copies of each other. Rows that repeat a doc_id with equal text get the same
    answer; group_size counts them all. A null doc_id is never the row that stays unless its whole group has none.
    An empty table gives an empty result. Columns of docs other than doc_id and text are carried along; if any has
    the name of an added column, in whatever case, the added column replaces it.
    """
    added = {"keep_id", "group_size", "kept", "text_sha256", "digest"}
    own = [c for c in docs.columns if c.lower() not in added]
    rows = docs.select(*[F.col(f"`{c}`") for c in own]).withColumn("digest", F.unhex(F.sha2(normalised(), 256)))
    joined = heavy_light_lookup(rows, settle(exact_groups(docs, salts)), "digest", "group_size", docs.agg(F.count("*")))
    return joined.select(
        *[F.col(f"`{c}`") for c in own],
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, salts: int = 16) -> DataFrame:
    """The rows that stay, with the columns of docs, whatever their names; of rows that repeat a doc_id and text, one stays, the same one in a rerun: that with the smallest hash of all its columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "doc_id", F.unhex(F.sha2(normalised(), 256)).alias("digest"))
    joined = heavy_light_lookup(rows, settle(exact_groups(docs, salts)), "digest", "group_size", docs.agg(F.count("*")))
    stay = joined.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return stay.groupBy("digest").agg(F.min_by("_doc", F.xxhash64(F.to_json("_doc"))).alias("_doc")).select("_doc.*")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_dedup(docs.select("doc_id", "text")).drop("text")


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
