"""The registered queries of the corpus operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martline.llm import (
    cross_tokenizer,
    decontaminate,
    jaccard_join,
    language_id,
    lexical_search,
    licenses,
    line_dedup,
    lm_scoring,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    suffix_dedup,
)
from martline.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return cross_tokenizer.cross_tokenizer(table(spark, sf_dir, "documents"), *paths)


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = (
    op1_quality_rules,
    op2_quality_classifier,
    op3_decontamination,
    op4_license_scan,
    op5_suffix_dedup,
    op6_jaccard_join,
    op7_lm_scoring,
    op8_language_id,
    op9_line_dedup,
    op10_mixing,
    op11_cross_tokenizer,
    op12_best_fit_packing,
    op13_lexical_search,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op1_quality_rules": quality_rules.ORACLE, "op3_decontamination": decontaminate.ORACLE, "op10_mixing": mixing.ORACLE, "op13_lexical_search": lexical_search.ORACLE}
