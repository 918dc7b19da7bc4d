"""The corpus pipeline: documents in, token ids out.

``STAGES`` are applied in order; each result is written as Parquet to the shared
checkpoint folder and read again as the next stage's documents.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voxelflow.llm import bpe, common, decontam, quality, secret_scan, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands."""
    return quality.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash component (3-word shingles, 3 bits)."""
    return simhash.representatives(docs, 3, 3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_matched(docs, common.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every document."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality_rules), ("simhash", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("bpe", tokens)]

#: The tokenisers can't be expressed in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; a stage's folder goes once the next stage is written."""
    docs, last = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = common.shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if last is not None:
            common.remove_folder(spark, last)
        last = folder
    return docs
