"""From raw documents to token ids, one written table per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm import (
    common,
    line_runs,
    mil_toxicity,
    minhash_containment,
    rtree_jaccard,
    tree_bpe,
)
from shoptide.llm.queries import RANKS, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that score 0.5 or more."""
    model = mil_toxicity.train(docs, table(spark, sf_dir, "labels"))
    return mil_toxicity.score(docs, model).where("score < 0.5").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, without lines that several hold; counts characters anew."""
    kept = line_runs.dedup_lines(docs).drop("n_lines", "n_dropped")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near duplicates."""
    return rtree_jaccard.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that contain a benchmark item."""
    return minhash_containment.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids and their number."""
    path = public_tokenizers.path(RANKS)
    ids = tree_bpe.encode(docs.drop("n_tokens"), path, public_tokenizers.PATTERN)
    return ids.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]

#: A trained model decides in the first stage: SQL cannot say what it keeps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all documents, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
