"""From documents to packed training sequences: four of the operators, one after another.

Every stage takes ``(spark, docs, sf_dir)``, and what it returns is written as Parquet and read
again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boletim.llm import jaccard, mixing, packing, toxicity
from boletim.llm.common import table
from boletim.storage import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, learnt from the labels, don't reject."""
    return toxicity.ordinary(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    It is decided row by row: null and repeated ids make no difference, and of rows that repeat an
    id and text one stays. Documents without words are copies of none, and stay.
    """
    return jaccard.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for."""
    return mixing.emit(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_copies),
    ("source_mix", mixed),
    ("bin_slack_packing", packed),
]

# SQL can't express the models of the first stage or the packing plan of the last.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is kept in the shared folder."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
