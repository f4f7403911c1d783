"""Small helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that parts words, in a regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def tokenizer_file(name: str) -> str:
    return public_tokenizers.path(name)


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the path of Python workers started from here on.

    On a cluster the package comes with ``--py-files`` or is installed; the folder is then unused.
    """
    folder = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if folder not in known:
        environment["PYTHONPATH"] = os.pathsep.join([folder, *known])


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Have Spark hand Python at most ``rows`` rows at a time, both ways, while jobs run here: a
    worker then holds, and keeps after its peak, only as much. Jobs of the session that run
    meanwhile do the same, which is harmless."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove what a job has shuffled once the job is done, not when the driver happens
    to collect its garbage. Jobs of the session that run meanwhile do the same, which is harmless."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)
