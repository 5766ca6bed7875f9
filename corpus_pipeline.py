"""The corpus pipeline: ``STAGES`` in order, each over all rows its predecessor
kept; every stage is written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, ngram_join, packing, pii, quality_rules
from strata.llm.common import boxed, table, unboxed
from strata.session import ensure_checkpoint_dir


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar documents stays."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window stay."""
    found = decontaminate.decontaminate(
        boxed(docs), table(spark, sf_dir, "benchmark"), keep=("row",)
    )
    return unboxed(found.where("not contaminated"), docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is masked; no row goes."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document, in sequences: one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", drop_poor),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_pii),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus_pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{base}/{k}_{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
