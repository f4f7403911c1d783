"""Answering all questions in one go.

Apart, the nine questions shuffle the grade table seven times. Over the stored reductions it is
three: by student, by student to their network, and by student for the exact distinct counts.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from boletim.operators.distribution import grades_per_value
from boletim.operators.students import grades_per_network, grades_per_student
from boletim.plans.queries import NAMED_QUERIES
from boletim.storage import shared_folder
from boletim.warehouse import Warehouse


REDUCTIONS = {
    "per_student": lambda w: grades_per_student(w.nota),
    "per_value": lambda w: grades_per_value(w.nota),
    "per_network": grades_per_network,
}


def prepared(
    spark: SparkSession,
    w: Warehouse,
    folder: str | None = None,
    reductions: Iterable[str] = tuple(REDUCTIONS),
) -> Warehouse:
    """Reduce the grades once by student, by value and by network, for all questions.

    The ``reductions`` wanted are written to ``folder`` (by default in the shared folder of the cluster), so
    a lost executor does not bring the grade table's shuffle back.
    """
    folder = folder or shared_folder(spark, "prepared")

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return replace(w, **{name: stored(REDUCTIONS[name](w), name) for name in reductions})


def answer_all(
    spark: SparkSession, w: Warehouse, folder: str | None = None
) -> dict[str, DataFrame]:
    """The nine answers, over one shared reduction of the grades."""
    ready = prepared(spark, w, folder)
    return {name: question(ready) for name, question in NAMED_QUERIES.items()}
