"""From raw documents to packed training sequences, in stages over Parquet tables.

Stages: drop documents that the quality resampling rejects, drop repeated lines, keep one document of
each group of similar ones, drop documents that contain test items, pack the rest. Nulls, empty texts,
repeated rows and empty tables are treated as each operator's module says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterbook.llm.decontaminate import clean_documents
from meterbook.llm.line_dedup import without_repeated_lines
from meterbook.llm.ngram_join import one_of_each
from meterbook.llm.packing import pack
from meterbook.llm.quality_classifier import keep_selected
from meterbook.llm.queries import tokenizer_file
from meterbook.session import scratch_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Hashed models, MinHash bands and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
