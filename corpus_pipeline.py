"""The corpus pipeline: quality, near-duplicate, substring, contamination and mixing stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``; the last returns one row per document with the copies the mixture takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_classifier
from martline.llm.common import table
from martline.session import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar documents stays."""
    return jaccard_join.keep_one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines and passages that an earlier document or place holds are cut out of the text; ``n_chars`` follows."""
    cut = line_dedup.clean_texts(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document so that sources reach their target words."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: A trained classifier and MinHash signatures are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared checkpoint folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
