"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.bisector_clusters import bisector_clusters
from cohortlens.llm.common import documents
from cohortlens.llm.cross_polytope import nearest_neighbours
from cohortlens.llm.decontaminate import find_leaks
from cohortlens.llm.filter_audit import audit_filters
from cohortlens.llm.jaccard_join import jaccard_join
from cohortlens.llm.mixing import mix_sources
from cohortlens.llm.packing import pack_documents
from cohortlens.llm.quality_classifier import classify_quality
from cohortlens.llm.quality_rules import quality_rules
from cohortlens.llm.secret_scan import joined, scan_secrets
from cohortlens.llm.sharding import reshard
from cohortlens.llm.suffix_dedup import suffix_dedup
from cohortlens.llm.token_counts import token_counts
from cohortlens.llm.twins import ORACLE_SQL  # noqa: F401
from cohortlens.sources.tables import table_path


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_secrets(documents(spark, sf_dir))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined("base_spans").cast("binary"), 256).alias("base_sha256"),
                      joined("all_spans").alias("spans"), "n_entropy")


def op3_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout shards by source, which leaves the shard of the hot
    source far above the others."""
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(8))
    out = reshard(documents(spark, sf_dir), old)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(spark, table_path(sf_dir, "documents"), documents(spark, sf_dir, "labels"))


def op13_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisector_clusters(documents(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_secret_scan, op3_token_packing, op4_suffix_dedup, op5_quality_rules, op6_token_counts,
    op7_source_mixing, op8_jaccard_join, op9_resharding, op10_decontamination,
    op11_nearest_neighbours, op12_filter_audit, op13_bisector_clusters)}
