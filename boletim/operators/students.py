"""Roll-ups along school -> student -> grade.

The grade table is by far the largest. Where the answer allows, it is reduced to one row per
student before it meets the other two, and the student table to one row per (group, student).
Both reductions have a map-side step, and no join multiplies rows within a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boletim.functions.exact import MOMENTS, combine_moments, moments
from boletim.warehouse import Warehouse


def grades_per_student(nota: DataFrame) -> DataFrame:
    """``aluno_id`` and the moments of that student's grades."""
    known = nota.where(F.col("aluno_id").isNotNull())
    return known.groupBy("aluno_id").agg(*moments("nota"))


def students_per(w: Warehouse, keys: list[str]) -> DataFrame:
    """One row per school attribute(s) ``keys`` and student ``id``.

    ``peso`` is how many times the school-student join holds that pair: 1 when keys are unique,
    more when a table has repeated rows.
    """
    if keys == ["escola_id"]:
        pairs = w.aluno.where(F.col("escola_id").isNotNull()).groupBy("escola_id", "id")
        return pairs.agg(F.count(F.lit(1)).alias("peso"))
    schools = w.escola.groupBy("escola_id", *keys).agg(F.count(F.lit(1)).alias("copias"))
    placed = w.aluno.select("escola_id", "id").join(schools, "escola_id")
    return placed.groupBy(*keys, "id").agg(F.sum("copias").alias("peso"))


def student_moments(w: Warehouse, keys: list[str]) -> DataFrame:
    """:func:`students_per` with each student's grade moments, NULL where there are none."""
    students = students_per(w, keys)
    grades = grades_per_student(w.nota) if w.per_student is None else w.per_student
    return students.join(grades, students["id"] == grades["aluno_id"], "left").drop("aluno_id")


def school_moments(w: Warehouse) -> DataFrame:
    """Per school row: ``total_alunos`` (distinct) and grade moments; empty schools stay."""
    per_school = (
        student_moments(w, ["escola_id"])
        .groupBy("escola_id")
        .agg(F.count("id").alias("total_alunos"), *combine_moments("peso"))
    )
    schools = w.escola.groupBy("escola_id", "nome", "rede", "regiao").agg(
        F.count(F.lit(1)).alias("copias")
    )
    joined = schools.join(per_school, "escola_id", "left")
    repeated = {c: F.col("copias") * F.coalesce(F.col(c), F.lit(0)) for c in MOMENTS[:3]}
    return joined.withColumns(
        {**repeated, "total_alunos": F.coalesce(F.col("total_alunos"), F.lit(0))}
    ).drop("copias")


def _distinct_schools(w: Warehouse, keys: list[str]) -> DataFrame:
    rows = w.escola.select(*keys, "escola_id").distinct()
    return rows.select(*keys, F.col("escola_id").isNotNull().cast("bigint").alias("escolas"))


def entity_counts() -> list:
    """Aggregates that finish the ``escolas`` and ``alunos`` of a union."""
    return [
        F.coalesce(F.sum("escolas"), F.lit(0)).alias("total_escolas"),
        F.coalesce(F.sum("alunos"), F.lit(0)).alias("total_alunos"),
    ]


def group_moments(w: Warehouse, keys: list[str]) -> DataFrame:
    """Per ``keys``: ``total_escolas``, ``total_alunos`` (both distinct) and grade moments.

    Schools and students are counted in one final aggregation over their union, which keeps
    groups without students and puts NULL keys in one group.
    """
    schools = _distinct_schools(w, keys)
    students = student_moments(w, keys).withColumn(
        "alunos", F.col("id").isNotNull().cast("bigint")
    )
    rows = schools.unionByName(
        students.select(*keys, "alunos", "peso", *MOMENTS), allowMissingColumns=True
    )
    return rows.groupBy(*keys).agg(*entity_counts(), *combine_moments("peso"))


def grades_per_network(w: Warehouse, keys: tuple[str, ...] = ("disciplina", "rede")) -> DataFrame:
    """``keys, nota, peso``: placed grades by ``keys`` and value; without the subject among them,
    no subject text comes to the join.

    Grades come to the join unaggregated, since the result still needs their values; a student
    with very many of them is split by adaptive skew handling, the other side being one row per
    network. What leaves the join is small: a grade has few values.
    """
    students = _students_of_networks(w)
    placed = w.nota.join(students, w.nota["aluno_id"] == students["id"])
    return placed.groupBy(*keys, "nota").agg(F.sum("peso").alias("peso"))


def network_values(
    w: Warehouse, keys: tuple[str, ...] = ("disciplina", "rede")
) -> DataFrame:
    return grades_per_network(w, keys) if w.per_network is None else w.per_network


def _students_of_networks(w: Warehouse) -> DataFrame:
    return students_per(w, ["rede"]).where(F.col("id").isNotNull())


def network_rows(w: Warehouse) -> DataFrame:
    """Rows with ``escolas``, ``alunos`` or (``nota``, ``peso``), to aggregate by ``rede``."""
    schools = _distinct_schools(w, ["rede"])
    # This count reads the same rows and columns as the join of grades does, so that the exchange
    # of students is computed once and used by both.
    students = _students_of_networks(w).groupBy("rede")
    students = students.agg(F.count_if(F.col("peso") > 0).alias("alunos"))
    grades = network_values(w, ("rede",)).select("rede", "nota", "peso")
    return schools.unionByName(students, allowMissingColumns=True).unionByName(
        grades, allowMissingColumns=True
    )
