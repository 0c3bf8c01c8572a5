"""One query for each operator of this package, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterbook.llm import decontaminate, filter_audit, lm_score, quality_rules, source_divergence, token_files, toxicity, url_filter
from meterbook.llm.html_extract import extract
from meterbook.llm.line_dedup import line_classes
from meterbook.llm.ngram_join import similar_documents
from meterbook.llm.packing import TOKENIZER, pack
from meterbook.llm.quality_classifier import resample


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return url_filter.judged(url_filter.captures_of(pages), url_filter.entries_of(pages))


def op2_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract(_table(spark, folder, "pages"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_classes(_table(spark, folder, "documents"))


def op4_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(_table(spark, folder, "documents"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"), tokenizer_file())


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return resample(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_rules(_table(spark, folder, "documents"))


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(_table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(_table(spark, folder, "documents"), tokenizer_file())


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.divergence(_table(spark, folder, "documents"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(spark, f"{folder}/documents.parquet", _table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_html_extract": op2_html_extract,
    "op3_line_dedup": op3_line_dedup,
    "op4_lm_score": op4_lm_score,
    "op5_decontaminate": op5_decontaminate,
    "op6_packing": op6_packing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_quality_rules": op8_quality_rules,
    "op9_ngram_join": op9_ngram_join,
    "op10_toxicity": op10_toxicity,
    "op11_token_ids": op11_token_ids,
    "op12_source_divergence": op12_source_divergence,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": url_filter.ORACLE_SQL,
    "op5_decontaminate": decontaminate.ORACLE_SQL,
    "op8_quality_rules": quality_rules.ORACLE_SQL,
    "op12_source_divergence": source_divergence.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}
