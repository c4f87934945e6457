"""The corpus pipeline: each stage works on all that the one before it kept, from a written table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pitbars.llm import line_dedup, order_minhash, packing, secrets_scan, toxicity
from pitbars.llm.common import checkpoint_dir, drop_written, shipped, table, written


@shipped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@shipped
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of runs of lines; documents of which nothing is left go."""
    return line_dedup.drop_repeats(docs)


@shipped
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return order_minhash.drop_copies(docs)


@shipped
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets replaced."""
    return secrets_scan.redact(docs)


@shipped
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in sequences for training."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeats), ("near_dedup", drop_copies), ("secrets", redact_secrets), ("packing", pack)]

#: No SQL: tokenizers, learned weights and alignments have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what lies between them is Parquet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        before = len(written)
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = f"{folder}/{i}-{name}"
            docs.write.parquet(path)
            drop_written(spark, before)  # what the stage wrote on its way
            docs = spark.read.parquet(path)
    return docs
