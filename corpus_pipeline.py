"""Corpus pipeline: toxicity, exact dedup, near-duplicate join, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a frame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from millrace.llm import exact, jaccard, mixing, packing, toxicity  # noqa: E402
from millrace.llm.common import cut, settled, table  # noqa: E402
from millrace.sinks.workspace import passing  # noqa: E402


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar, learned from the labels, doesn't reject."""
    return toxicity.drop_toxic(docs, table(settled(spark), sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    settled(spark)
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles connect."""
    settled(spark)
    return jaccard.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    settled(spark)
    return mixing.resample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    settled(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_jaccard", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: Trained models, similarity joins and tokenising have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(settled(spark), sf_dir, "documents")
    *early, (_, last) = STAGES
    for name, stage in early:
        with passing(spark) as keep:  # what a stage wrote for itself goes once its result is stored
            docs = keep(cut(stage(spark, docs, sf_dir), name))
    return last(spark, docs, sf_dir)
