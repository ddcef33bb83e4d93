"""The corpus pipeline: quality rules, near duplicates, benchmark
decontamination, source mixing, packed token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``; all but the
last return the columns of documents.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.common import documents
from cohortlens.llm.decontaminate import remove_leaks
from cohortlens.llm.jaccard_join import keep_one
from cohortlens.llm.mixing import apply_mix
from cohortlens.llm.packing import pack_documents
from cohortlens.llm.quality_rules import apply_quality_rules
from cohortlens.session import checkpoint_dir


# Texts go to Python workers in batches of at most so many bytes. Batches are
# held by the executor's buffers and by the workers, which later stages reuse,
# so their size is what a stage leaves behind; results do not depend on it.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    spark.conf.set(*BATCH)
    return apply_quality_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents (five words, similarity 0.8 or more)
    the one with the smallest doc_id stays."""
    spark.conf.set(*BATCH)
    return keep_one(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    spark.conf.set(*BATCH)
    return remove_leaks(docs, documents(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources meet their targets."""
    spark.conf.set(*BATCH)
    return apply_mix(docs)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of the mix, packed into sequences."""
    spark.conf.set(*BATCH)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("source_mixing", mixing), ("token_packing", token_packing)]

# Model fits, components and draws are beyond SQL; tests/llm holds the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = documents(spark, sf_dir)
    root = os.path.join(checkpoint_dir(spark), "pipeline", uuid.uuid4().hex)
    for name, stage in STAGES:
        path = os.path.join(root, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
