"""Grades counted by value.

A ``decimal(4,1)`` has few distinct values, so (group, value) counts are tiny after the map-side
step, however many rows there are, and every statistic of a group can be taken from them exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boletim.warehouse import Warehouse


def grades_per_value(nota: DataFrame) -> DataFrame:
    """``disciplina, nota, linhas``: rows of each subject and grade."""
    return nota.groupBy("disciplina", "nota").agg(F.count(F.lit(1)).alias("linhas"))


def value_counts(w: Warehouse) -> DataFrame:
    return grades_per_value(w.nota) if w.per_value is None else w.per_value


def distinct_students(nota: DataFrame) -> DataFrame:
    """Per subject: rows with a student id, and distinct student ids."""
    pairs = nota.groupBy("disciplina", "aluno_id").agg(F.count(F.lit(1)).alias("linhas"))
    known = F.when(F.col("aluno_id").isNotNull(), F.col("linhas"))
    return pairs.groupBy("disciplina").agg(
        F.coalesce(F.sum(known), F.lit(0)).alias("total_notas"),
        F.count("aluno_id").alias("total_alunos"),
    )
