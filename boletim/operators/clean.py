"""Cleaning rules. Stateless, so the same functions serve batch and streaming reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boletim.schemas import AUDIT_COLUMNS, GRADE_RANGE, INGESTION_COLUMN


def _trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def _stamps(run_ts: datetime) -> dict[str, Column]:
    """One literal for the whole run: every table and every re-read carries the same time."""
    ts = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return {name: ts for name in (INGESTION_COLUMN, *AUDIT_COLUMNS)}


def clean_escolas(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumns(
        {
            "nome": _trimmed("nome"),
            "rede": F.lower(_trimmed("rede")),
            "regiao": _trimmed("regiao"),
            **_stamps(run_ts),
        }
    )


def clean_alunos(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumns(
        {
            "nome": _trimmed("nome"),
            # By way of double: text such as 12.7 becomes 12, and anything unreadable NULL.
            "idade": F.col("idade").try_cast("double").try_cast("int"),
            "genero": F.upper(_trimmed("genero")),
            **_stamps(run_ts),
        }
    )


def _grade() -> Column:
    return F.col("nota").try_cast("double")


def clean_notas(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Keep grades that are numbers within range; NaN and infinities fall outside it."""
    typed = df.withColumns({"disciplina": _trimmed("disciplina"), "nota": _grade()})
    return typed.where(F.col("nota").between(*GRADE_RANGE)).withColumns(_stamps(run_ts))


def rejected_notas(df: DataFrame) -> DataFrame:
    """The raw rows :func:`clean_notas` leaves out, as read, with the reason."""
    grade = _grade()
    kept = F.coalesce(grade.between(*GRADE_RANGE), F.lit(False))
    reason = (
        F.when(F.col("nota").isNull(), "ausente")
        .when(grade.isNull(), "ilegivel")
        .otherwise("fora_da_faixa")
    )
    return df.where(~kept).withColumn("motivo", reason)


CLEANERS = {"escola": clean_escolas, "aluno": clean_alunos, "nota": clean_notas}
