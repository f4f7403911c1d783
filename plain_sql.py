"""The nine questions as one plain Spark SQL statement each: what the library is timed against.

Written as a user would without it: joins of whole tables, distinct counts and percentiles by the
built-in aggregates, means by exact decimals. ``bench.py --plain`` times them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from boletim.warehouse import Warehouse


def _r2(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18,10)), 2) AS DOUBLE)"


_EXACT = "CAST(try_divide(CAST(sum(nota) AS DECIMAL(28,1)), count(nota)) AS DECIMAL(22,19))"
_MEAN, _SD = _r2(_EXACT), _r2("stddev_samp(nota)")
_LOW, _HIGH = _r2("min(nota)"), _r2("max(nota)")
_LINKED = """(SELECT e.*, a.id AS aluno, n.nota FROM {escola} e
    LEFT JOIN {aluno} a ON a.escola_id = e.escola_id LEFT JOIN {nota} n ON n.aluno_id = a.id)"""


def _percentile(p: float) -> str:
    return _r2(f"percentile(CAST(nota AS DOUBLE), {p})")


STATEMENTS = {
    "media_por_escola": f"""SELECT escola_id, nome AS escola_nome, rede, regiao,
        count(DISTINCT aluno) AS total_alunos, count(nota) AS total_notas, {_MEAN} AS media_geral,
        {_LOW} AS nota_minima, {_HIGH} AS nota_maxima, {_SD} AS desvio_padrao
        FROM {_LINKED} GROUP BY escola_id, nome, rede, regiao
        ORDER BY media_geral DESC NULLS LAST""",
    "media_por_regiao": f"""SELECT regiao, count(DISTINCT escola_id) AS total_escolas,
        count(DISTINCT aluno) AS total_alunos, count(nota) AS total_notas, {_MEAN} AS media_geral,
        {_LOW} AS nota_minima, {_HIGH} AS nota_maxima FROM {_LINKED} GROUP BY regiao
        ORDER BY media_geral DESC NULLS LAST""",
    "ranking_escolas_regiao": f"""SELECT regiao, nome AS escola_nome, rede,
        {_r2("media")} AS media_escola,
        rank() OVER (PARTITION BY regiao ORDER BY media DESC NULLS FIRST) AS ranking_na_regiao,
        {_r2("avg(media) OVER (PARTITION BY regiao)")} AS media_da_regiao
        FROM (SELECT escola_id, regiao, nome, rede, {_EXACT} AS media FROM {_LINKED}
            GROUP BY escola_id, regiao, nome, rede) ORDER BY regiao, ranking_na_regiao""",
    "comparacao_redes": f"""SELECT rede, count(DISTINCT escola_id) AS total_escolas,
        count(DISTINCT aluno) AS total_alunos, count(nota) AS total_notas, {_MEAN} AS media_geral,
        {_SD} AS desvio_padrao, {_LOW} AS nota_minima, {_HIGH} AS nota_maxima,
        {_percentile(0.5)} AS mediana FROM {_LINKED} GROUP BY rede
        ORDER BY media_geral DESC NULLS FIRST""",
    "rede_por_regiao": f"""SELECT regiao, rede, count(DISTINCT escola_id) AS total_escolas,
        count(DISTINCT aluno) AS total_alunos, {_MEAN} AS media_nota FROM {_LINKED}
        GROUP BY regiao, rede ORDER BY regiao, media_nota DESC NULLS FIRST""",
    "estatisticas_disciplina": f"""SELECT disciplina, count(aluno_id) AS total_notas,
        count(DISTINCT aluno_id) AS total_alunos, {_MEAN} AS media, {_SD} AS desvio_padrao,
        {_LOW} AS nota_minima, {_HIGH} AS nota_maxima, {_percentile(0.25)} AS percentil_25,
        {_percentile(0.5)} AS mediana, {_percentile(0.75)} AS percentil_75
        FROM {{nota}} GROUP BY disciplina ORDER BY media DESC NULLS FIRST""",
    "histograma_disciplina": f"""SELECT disciplina,
        count_if(nota >= 0 AND nota < 2) AS faixa_0_2, count_if(nota >= 2 AND nota < 4) AS faixa_2_4,
        count_if(nota >= 4 AND nota < 6) AS faixa_4_6, count_if(nota >= 6 AND nota < 8) AS faixa_6_8,
        count_if(nota >= 8 AND nota <= 10) AS faixa_8_10, count(*) AS total_notas, {_MEAN} AS media
        FROM {{nota}} GROUP BY disciplina ORDER BY media DESC NULLS FIRST""",
    "ranking_disciplinas": f"""SELECT disciplina, {_r2("media")} AS media_nota,
        rank() OVER (ORDER BY media DESC NULLS FIRST) AS ranking_geral,
        CASE WHEN media >= 7 THEN 'Excelente' WHEN media >= 6 THEN 'Bom'
        WHEN media >= 5 THEN 'Regular' ELSE 'Precisa Melhorar' END AS classificacao
        FROM (SELECT disciplina, {_EXACT} AS media FROM {{nota}} GROUP BY disciplina)
        ORDER BY media_nota DESC NULLS FIRST""",
    "disciplina_por_rede": f"""SELECT disciplina, rede, count(nota) AS total_notas,
        {_MEAN} AS media_nota, {_SD} AS desvio_padrao
        FROM {{nota}} n JOIN {{aluno}} a ON a.id = n.aluno_id
        JOIN {{escola}} e ON e.escola_id = a.escola_id
        GROUP BY disciplina, rede ORDER BY disciplina, media_nota DESC NULLS FIRST""",
}


def plain(name: str) -> Callable[[Warehouse], DataFrame]:
    """A question as its plain statement over the tables of a warehouse."""
    text = STATEMENTS[name]

    def run(w: Warehouse) -> DataFrame:
        used = {k: df for k, df in w.tables().items() if f"{{{k}}}" in text}
        return w.nota.sparkSession.sql(text, **used)

    return run
