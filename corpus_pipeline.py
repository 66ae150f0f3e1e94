"""The corpus pipeline: documents by language, toxicity and near-duplication, mixed to target weights and packed into sequences.

Every stage takes (spark, docs, sf_dir) and all that the stage before it kept; what it returns is written as Parquet and read again.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clicklake.llm import language, mixing, packing, simhash, toxicity  # noqa: E402
from clicklake.llm.common import ship, table, written  # noqa: E402


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose pooled probabilities are near to none of the languages, go."""
    ship(spark)
    return language.accepted(docs, language.fit(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the classifier learns from the labels of the documents that came so far."""
    ship(spark)
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id (null last) stays; of repeated rows one. Null and empty texts
    are one group; no rows give none."""
    ship(spark)
    return simhash.keep_first(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and parts of documents that the mix draws, once for each time. Texts without a word are not drawn; repeated rows
    are documents each; no rows give none."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens: one row for each piece of a drawn text, with its sequence and place. Null and empty texts are the end id
    alone; repeated rows are packed each; no rows give none."""
    ship(spark)
    return packing.pack_documents(docs, forget=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained models, SimHash and tokenising are not expressible in SQL; tests/llm compares the pipeline with a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
