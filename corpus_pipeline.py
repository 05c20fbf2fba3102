"""The corpus pipeline: five stages from documents to token digests.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame;
all but the last return the columns of ``documents``. ``run`` writes each stage as Parquet to the shared
folder and reads it again for the next.

Rows that a stage returns are lazy: what they read in the shared folder stays until the process ends, or the
innermost ``scratch`` around the call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attesta.llm import bpe, decontam, secret_scan, simhash, toxicity
from attesta.llm.common import bounded_batches, remove_table, scratch, table, until_done, write_table
from attesta.llm.queries import BPE_RANKS, PATTERN


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not reject."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of each document."""
    return bpe.digests(docs, BPE_RANKS, PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("byte_bpe", encoding_stage),
]

#: Neither fingerprints nor compression lengths can be had in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's table goes once the next is written; the last one's input stays until the process ends."""
    bounded_batches(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch():  # what the stage wrote for itself goes once its result is written
            docs, path = write_table(stage(spark, docs, sf_dir), name)
        if before:
            remove_table(spark, before)
        before = path
    until_done(lambda: remove_table(spark, before))
    return STAGES[-1][1](spark, docs, sf_dir)
