"""Registered queries of the operators: name -> function of (session, folder), and DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shoptide.llm import (
    debruijn_spans,
    filter_audit,
    hilbert_shards,
    hnsw_dedup,
    line_runs,
    link_trust,
    mil_toxicity,
    minhash_containment,
    rtree_jaccard,
    secret_forest,
    tree_bpe,
    warc_members,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_forest.secret_findings(table(spark, folder, "documents"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return debruijn_spans.span_digests(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return mil_toxicity.toxicity_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


def op4_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_shards.shard_digests(table(spark, folder, "documents"))


def op5_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    return link_trust.url_verdicts(table(spark, folder, "pages"))


def op6_hnsw_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return rtree_jaccard.joined(table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_containment.find_leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return tree_bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_runs.line_dedup_digests(table(spark, folder, "documents"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


def op12_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    return warc_members.page_records(table(spark, folder, "pages"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_hilbert_shards": op4_hilbert_shards,
        "op5_link_trust": op5_link_trust,
        "op6_hnsw_dedup": op6_hnsw_dedup,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_decontamination": op8_decontamination,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_line_dedup": op10_line_dedup,
        "op11_filter_audit": op11_filter_audit,
        "op12_warc_members": op12_warc_members,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": debruijn_spans.oracle(),
        "op5_link_trust": link_trust.oracle(),
        "op6_hnsw_dedup": hnsw_dedup.oracle(),
        "op7_jaccard_join": rtree_jaccard.oracle(),
        "op8_decontamination": minhash_containment.oracle(),
        "op10_line_dedup": line_runs.oracle(),
        "op11_filter_audit": filter_audit.oracle(),
        "op12_warc_members": warc_members.oracle(),
    }
