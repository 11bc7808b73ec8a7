"""The corpus pipeline: documents that pass quality, without repeated lines, near copies and
benchmark passages, as byte-level BPE tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. ``run`` writes each stage's rows in the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm import bpe, decontaminate, lines, nearcopies, quality
from linkwright.llm.common import cut, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from labels that are not held out."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id").cast("bigint")))
    return quality.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three-line windows that occurred before go."""
    return lines.remove_repeats(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return nearcopies.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go; so do documents that mostly are one."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them."""
    ranks, pattern = bpe._public("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, ranks, pattern, digests=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level bpe", token_stage),
]

#: A classifier's fit and BPE merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
