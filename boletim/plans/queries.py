"""The nine named questions, each a function of the warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boletim.functions.exact import (
    descriptive,
    mean,
    moments,
    percentile_cont,
    round2,
    round2_double,
)
from boletim.operators.distribution import distinct_students, value_counts
from boletim.operators.ranking import with_rank
from boletim.operators.students import (
    entity_counts,
    group_moments,
    network_rows,
    network_values,
    school_moments,
)
from boletim.warehouse import Warehouse

# Lowest mean of each label, and the label below all of them.
CLASS_FLOORS = ((7.0, "Excelente"), (6.0, "Bom"), (5.0, "Regular"))
CLASS_BELOW = "Precisa Melhorar"

# The bands of the grade histogram. The last one includes its upper end.
BANDS = ((0, 2), (2, 4), (4, 6), (6, 8), (8, 10))


def media_por_escola(w: Warehouse) -> DataFrame:
    """Grade statistics of each school, empty schools included."""
    return (
        school_moments(w)
        .select(
            "escola_id",
            F.col("nome").alias("escola_nome"),
            "rede",
            "regiao",
            "total_alunos",
            F.col("n").alias("total_notas"),
            *descriptive(
                {
                    "media": "media_geral",
                    "minimo": "nota_minima",
                    "maximo": "nota_maxima",
                    "desvio": "desvio_padrao",
                }
            ),
        )
        .orderBy(F.desc_nulls_last("media_geral"), "escola_id")
    )


def media_por_regiao(w: Warehouse) -> DataFrame:
    """Grade statistics of each region."""
    return (
        group_moments(w, ["regiao"])
        .select(
            "regiao",
            "total_escolas",
            "total_alunos",
            F.col("n").alias("total_notas"),
            *descriptive(
                {"media": "media_geral", "minimo": "nota_minima", "maximo": "nota_maxima"}
            ),
        )
        .orderBy(F.desc_nulls_last("media_geral"), "regiao")
    )


def ranking_escolas_regiao(w: Warehouse) -> DataFrame:
    """Rank of each school's mean in its region, beside the mean of the school means."""
    schools = school_moments(w).select("escola_id", "nome", "rede", "regiao", mean().alias("media"))
    ranked = with_rank(schools, ["regiao"], "media", "ranking_na_regiao", "media_da_regiao")
    return (
        ranked.orderBy(
            F.asc_nulls_last("regiao"), F.asc_nulls_last("ranking_na_regiao"), "escola_id"
        )
        .select(
            "regiao",
            F.col("nome").alias("escola_nome"),
            "rede",
            round2(F.col("media")).alias("media_escola"),
            "ranking_na_regiao",
            round2(F.col("media_da_regiao")).alias("media_da_regiao"),
        )
    )


def comparacao_redes(w: Warehouse) -> DataFrame:
    """Grade statistics of each school network, with the median."""
    return (
        network_rows(w)
        .groupBy("rede")
        .agg(
            *entity_counts(),
            *moments("nota", "peso"),
            percentile_cont(0.5, "nota", "peso").alias("p50"),
        )
        .select(
            "rede",
            "total_escolas",
            "total_alunos",
            F.col("n").alias("total_notas"),
            *descriptive(
                {
                    "media": "media_geral",
                    "desvio": "desvio_padrao",
                    "minimo": "nota_minima",
                    "maximo": "nota_maxima",
                }
            ),
            round2_double(F.col("p50")).alias("mediana"),
        )
        .orderBy(F.desc_nulls_first("media_geral"), "rede")
    )


def rede_por_regiao(w: Warehouse) -> DataFrame:
    """Mean grade of each network in each region."""
    return (
        group_moments(w, ["regiao", "rede"])
        .select(
            "regiao",
            "rede",
            "total_escolas",
            "total_alunos",
            *descriptive({"media": "media_nota"}),
        )
        .orderBy(F.asc_nulls_last("regiao"), F.desc_nulls_first("media_nota"), "rede")
    )


def _subject_moments(w: Warehouse, *more) -> DataFrame:
    return value_counts(w).groupBy("disciplina").agg(*moments("nota", "linhas"), *more)


def estatisticas_disciplina(w: Warehouse) -> DataFrame:
    """Grade statistics of each subject, with quartiles.

    Values and students are counted apart: the first needs no student ids and hardly a shuffle,
    and an exact distinct count beside other aggregates would carry those through its own.
    """
    quartiles = {"percentil_25": 0.25, "mediana": 0.5, "percentil_75": 0.75}
    return (
        value_counts(w)
        .unionByName(distinct_students(w.nota), allowMissingColumns=True)
        .groupBy("disciplina")
        .agg(
            F.sum("total_notas").alias("total_notas"),
            F.sum("total_alunos").alias("total_alunos"),
            *moments("nota", "linhas"),
            *[percentile_cont(p, "nota", "linhas").alias(name) for name, p in quartiles.items()],
        )
        .select(
            "disciplina",
            "total_notas",
            "total_alunos",
            *descriptive(
                {
                    "media": "media",
                    "desvio": "desvio_padrao",
                    "minimo": "nota_minima",
                    "maximo": "nota_maxima",
                }
            ),
            *[round2_double(F.col(name)).alias(name) for name in quartiles],
        )
        .orderBy(F.desc_nulls_first("media"), "disciplina")
    )


def _in_band(low: int, high: int):
    grade = F.col("nota")
    below = grade <= high if high == BANDS[-1][1] else grade < high
    return (grade >= low) & below


def histograma_disciplina(w: Warehouse) -> DataFrame:
    """Grades of each subject by band."""
    bands = [
        F.coalesce(F.sum(F.when(_in_band(low, high), F.col("linhas"))), F.lit(0)).alias(
            f"faixa_{low}_{high}"
        )
        for low, high in BANDS
    ]
    return (
        _subject_moments(w, *bands, F.sum("linhas").alias("total_notas"))
        .select(
            "disciplina",
            *[f"faixa_{low}_{high}" for low, high in BANDS],
            "total_notas",
            *descriptive({"media": "media"}),
        )
        .orderBy(F.desc_nulls_first("media"), "disciplina")
    )


def ranking_disciplinas(w: Warehouse) -> DataFrame:
    """Rank and label of each subject by its mean grade."""
    label = F.lit(CLASS_BELOW)
    for floor, name in reversed(CLASS_FLOORS):
        label = F.when(F.col("exata") >= F.lit(floor).cast("decimal(4,1)"), name).otherwise(label)
    subjects = _subject_moments(w).select("disciplina", mean().alias("exata"))
    return (
        with_rank(subjects, [], "exata", "ranking_geral")
        .select(
            "disciplina",
            round2(F.col("exata")).alias("media_nota"),
            "ranking_geral",
            label.alias("classificacao"),
        )
        .orderBy(F.desc_nulls_first("media_nota"), "disciplina")
    )


def disciplina_por_rede(w: Warehouse) -> DataFrame:
    """Grade statistics of each subject in each network."""
    return (
        network_values(w)
        .groupBy("disciplina", "rede")
        .agg(*moments("nota", "peso"))
        .select(
            "disciplina",
            "rede",
            F.col("n").alias("total_notas"),
            *descriptive({"media": "media_nota", "desvio": "desvio_padrao"}),
        )
        .orderBy(F.asc_nulls_last("disciplina"), F.desc_nulls_first("media_nota"), "rede")
    )


def media_global(w: Warehouse) -> DataFrame:
    """Mean of all grades, in one row."""
    return value_counts(w).agg(*moments("nota", "linhas")).select(
        F.col("n").alias("total_notas"), *descriptive({"media": "media"})
    )


NAMED_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    f.__name__: f
    for f in (
        media_por_escola,
        media_por_regiao,
        ranking_escolas_regiao,
        comparacao_redes,
        rede_por_regiao,
        estatisticas_disciplina,
        histograma_disciplina,
        ranking_disciplinas,
        disciplina_por_rede,
    )
}
