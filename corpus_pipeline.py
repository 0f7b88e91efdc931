"""A training corpus from ``documents``: five stages, each on all that the one before kept.

Every stage is written as Parquet in the shared folder and read again, so a lost executor costs a
re-read and no stage is computed twice.

Null and empty texts pass where their score lets them; equal ones are copies, so one row stays. Null ids
are ids of their own rows: a row with an id stays before one without. All stages but the last return the
columns of the documents, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from remitlake.llm import byte_bpe, decontaminate, exact_dedup, quality, similarity_join
from remitlake.llm.queries import BYTE_BPE, BYTE_PATTERN, table
from remitlake.scratch import scratch_path


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similarity_join.keep_one_of_each_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and digests of the ids and of the text they decode to."""
    encoded = byte_bpe.encode(docs, BYTE_BPE, BYTE_PATTERN)
    return byte_bpe.digests(byte_bpe.decode(encoded, BYTE_BPE), "ids_le")


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", tokens),
]

#: The classifier and the similarity join cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
