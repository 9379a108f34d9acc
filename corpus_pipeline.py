"""From raw documents to a mixed, clean training corpus, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns
the columns of ``docs``; the last returns the rows of the mix, each as often as it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm.common import table
from parley.llm.decontaminate import decontaminate
from parley.llm.line_dedup import keep_first_lines
from parley.llm.mixing import mix_documents
from parley.llm.near_dedup import keep_representatives
from parley.llm.quality import keep_quality, train_quality
from parley.plans.scratch import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those with nothing left go."""
    return keep_first_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mix_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The classifier and the random mix are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
