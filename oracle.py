"""The same results in SQL that DuckDB runs, straight from the definition of each query.

Joins and distinct counts are written out in full here, with none of the library's pre-aggregation.
"""

from __future__ import annotations

from derived_views import RUN_TS, duckdb_ctes

_TS = f"TIMESTAMP '{RUN_TS.isoformat(sep=' ')}'"


def _r2(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(18,10)), 2) AS DOUBLE)"


_MEAN, _SD = _r2("avg(nota)"), _r2("stddev_samp(nota)")
_LOW, _HIGH = _r2("min(nota)"), _r2("max(nota)")
_EXACT_MEAN = "CAST(avg(nota) AS DECIMAL(18,10))"

# Schools with their students and grades; absent ones are NULL.
_LINKED = """ligado AS (SELECT e.*, a.id AS aluno, n.nota
    FROM escola e LEFT JOIN aluno a USING (escola_id) LEFT JOIN nota n ON n.aluno_id = a.id)"""

_RANKING = f"""regiao, nome AS escola_nome, rede, {_r2("media")} AS media_escola,
        rank() OVER (PARTITION BY regiao ORDER BY media DESC NULLS FIRST) AS ranking_na_regiao,
        {_r2("avg(media) OVER (PARTITION BY regiao)")} AS media_da_regiao"""


def _percentile(p: float) -> str:
    return _r2(f"quantile_cont(CAST(nota AS DOUBLE), {p})")


def _warehouse(select: str) -> str:
    return f"{duckdb_ctes('escola', 'aluno', 'nota')}, {_LINKED} {select}"


def _grades(select: str) -> str:
    return f"{duckdb_ctes('nota')} {select}"


NAMED = {
    "media_por_escola": _warehouse(
        f"""SELECT escola_id, nome AS escola_nome, rede, regiao,
        count(DISTINCT aluno) AS total_alunos, count(nota) AS total_notas, {_MEAN} AS media_geral,
        {_LOW} AS nota_minima, {_HIGH} AS nota_maxima, {_SD} AS desvio_padrao
        FROM ligado GROUP BY ALL"""
    ),
    "media_por_regiao": _warehouse(
        f"""SELECT regiao, count(DISTINCT escola_id) AS total_escolas,
        count(DISTINCT aluno) AS total_alunos, count(nota) AS total_notas, {_MEAN} AS media_geral,
        {_LOW} AS nota_minima, {_HIGH} AS nota_maxima FROM ligado GROUP BY ALL"""
    ),
    "ranking_escolas_regiao": _warehouse(
        f""", por_escola AS (SELECT escola_id, regiao, nome, rede, {_EXACT_MEAN} AS media
            FROM ligado GROUP BY ALL)
        SELECT {_RANKING} FROM por_escola"""
    ),
    "comparacao_redes": _warehouse(
        f"""SELECT rede, count(DISTINCT escola_id) AS total_escolas,
        count(DISTINCT aluno) AS total_alunos, count(nota) AS total_notas, {_MEAN} AS media_geral,
        {_SD} AS desvio_padrao, {_LOW} AS nota_minima, {_HIGH} AS nota_maxima,
        {_percentile(0.5)} AS mediana FROM ligado GROUP BY ALL"""
    ),
    "rede_por_regiao": _warehouse(
        f"""SELECT regiao, rede, count(DISTINCT escola_id) AS total_escolas,
        count(DISTINCT aluno) AS total_alunos, {_MEAN} AS media_nota FROM ligado GROUP BY ALL"""
    ),
    "estatisticas_disciplina": _grades(
        f"""SELECT disciplina, count(aluno_id) AS total_notas,
        count(DISTINCT aluno_id) AS total_alunos, {_MEAN} AS media, {_SD} AS desvio_padrao,
        {_LOW} AS nota_minima, {_HIGH} AS nota_maxima, {_percentile(0.25)} AS percentil_25,
        {_percentile(0.5)} AS mediana, {_percentile(0.75)} AS percentil_75
        FROM nota GROUP BY ALL"""
    ),
    "histograma_disciplina": _grades(
        f"""SELECT disciplina, count(*) FILTER (nota >= 0 AND nota < 2) AS faixa_0_2,
        count(*) FILTER (nota >= 2 AND nota < 4) AS faixa_2_4,
        count(*) FILTER (nota >= 4 AND nota < 6) AS faixa_4_6,
        count(*) FILTER (nota >= 6 AND nota < 8) AS faixa_6_8,
        count(*) FILTER (nota >= 8 AND nota <= 10) AS faixa_8_10,
        count(*) AS total_notas, {_MEAN} AS media FROM nota GROUP BY ALL"""
    ),
    "ranking_disciplinas": _grades(
        f""", por_disciplina AS (SELECT disciplina, {_EXACT_MEAN} AS media FROM nota GROUP BY ALL)
        SELECT disciplina, {_r2("media")} AS media_nota,
        rank() OVER (ORDER BY media DESC NULLS FIRST) AS ranking_geral,
        CASE WHEN media >= 7 THEN 'Excelente' WHEN media >= 6 THEN 'Bom'
        WHEN media >= 5 THEN 'Regular' ELSE 'Precisa Melhorar' END AS classificacao
        FROM por_disciplina"""
    ),
    "disciplina_por_rede": f"""{duckdb_ctes("escola", "aluno", "nota")}
        SELECT disciplina, rede, count(nota) AS total_notas, {_MEAN} AS media_nota,
        {_SD} AS desvio_padrao
        FROM escola JOIN aluno USING (escola_id) JOIN nota ON aluno_id = id GROUP BY ALL""",
    "media_global": _grades(
        f"SELECT count(nota) AS total_notas, {_MEAN} AS media FROM nota"
    ),
}

# The stated order of each result; of rows equal in it, that of the key.
ORDERS = {
    "media_por_escola": "media_geral DESC NULLS LAST, escola_id",
    "media_por_regiao": "media_geral DESC NULLS LAST, regiao",
    "ranking_escolas_regiao": "regiao NULLS LAST, ranking_na_regiao NULLS LAST, escola_id",
    "comparacao_redes": "media_geral DESC NULLS FIRST, rede",
    "rede_por_regiao": "regiao NULLS LAST, media_nota DESC NULLS FIRST, rede",
    "estatisticas_disciplina": "media DESC NULLS FIRST, disciplina",
    "histograma_disciplina": "media DESC NULLS FIRST, disciplina",
    "ranking_disciplinas": "media_nota DESC NULLS FIRST, disciplina",
    "disciplina_por_rede": "disciplina NULLS LAST, media_nota DESC NULLS FIRST, rede",
}


def _ordered(name: str) -> str:
    rows, left_out = NAMED[name], ""
    if name == "ranking_escolas_regiao":  # its order ends with a column that it does not return
        rows, left_out = rows.replace(f"SELECT {_RANKING}", f"SELECT escola_id, {_RANKING}"), "EXCLUDE (escola_id)"
    return f"""SELECT row_number() OVER (ORDER BY {ORDERS[name]}) AS posicao, * {left_out}
        FROM ({rows})"""


ORDERED = {f"ordem_{name}": _ordered(name) for name in ORDERS}

PREPARED = {
    f"{name}_prepared": NAMED[name]
    for name in ("ranking_escolas_regiao", "comparacao_redes", "estatisticas_disciplina")
}

_STAMPS = f"{_TS} AS ingestion_time, {_TS} AS created_at, {_TS} AS updated_at"
_CLEAN_ESCOLAS = f"""SELECT escola_id, trim(nome) AS nome, lower(trim(rede)) AS rede,
    trim(regiao) AS regiao, {_STAMPS} FROM escolas"""
_CLEAN_ALUNOS = f"""SELECT id, trim(nome) AS nome,
    TRY_CAST(trunc(TRY_CAST(idade AS DOUBLE)) AS INT) AS idade, upper(trim(genero)) AS genero,
    escola_id, {_STAMPS} FROM alunos"""
_CLEAN_NOTAS = f"""SELECT aluno_id, trim(disciplina) AS disciplina,
    TRY_CAST(nota AS DOUBLE) AS nota, {_STAMPS} FROM notas
    WHERE TRY_CAST(nota AS DOUBLE) BETWEEN 0 AND 10"""
_LOADED_NOTAS = f"""SELECT aluno_id, disciplina, CAST(CAST(nota AS DECIMAL(4,1)) AS DOUBLE) AS nota,
    ingestion_time FROM ({_CLEAN_NOTAS})"""

CLEAN = {
    "clean_escolas": f"{duckdb_ctes('escolas')} {_CLEAN_ESCOLAS}",
    "clean_alunos": f"{duckdb_ctes('alunos')} {_CLEAN_ALUNOS}",
    "clean_notas": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "rejected_notas": f"""{duckdb_ctes("notas")}
        SELECT aluno_id, disciplina, nota, CASE WHEN nota IS NULL THEN 'ausente'
        WHEN TRY_CAST(nota AS DOUBLE) IS NULL THEN 'ilegivel' ELSE 'fora_da_faixa' END AS motivo
        FROM notas WHERE coalesce(TRY_CAST(nota AS DOUBLE) BETWEEN 0 AND 10, false) = false""",
    "warehouse_nota": f"{duckdb_ctes('notas')} {_LOADED_NOTAS}",
}


def _dq(table: str, rule: str, key: str, detail: str, source: str) -> str:
    return (
        f"""SELECT '{table}' AS "table", '{rule}' AS rule, {key} AS key, {detail} AS detail """
        f"{source}"
    )


_NOTA_KEY = "concat(aluno_id, '|', disciplina)"
_TYPED_NOTAS = "tipada AS (SELECT * REPLACE (TRY_CAST(nota AS DOUBLE) AS nota) FROM notas)"
_SHOWN_NOTA = "concat('nota=', CASE WHEN isnan(nota) THEN 'NaN' ELSE CAST(nota AS VARCHAR) END)"
_DQ_UNIQUE = _dq(
    "nota", "unique", _NOTA_KEY, "CAST(count(*) AS VARCHAR)",
    "FROM nota GROUP BY aluno_id, disciplina HAVING count(*) > 1",
)
_DQ_FK_NOTA = _dq(
    "nota", "foreign_key", "aluno_id", "CAST(count(*) AS VARCHAR)",
    "FROM nota WHERE aluno_id NOT IN (SELECT id FROM aluno) GROUP BY aluno_id",
)
_DQ_FK_ALUNO = _dq(
    "aluno", "foreign_key", "escola_id", "CAST(count(*) AS VARCHAR)",
    "FROM aluno WHERE escola_id NOT IN (SELECT escola_id FROM escola) GROUP BY escola_id",
)

QUALITY = {
    "dq_not_null": f"{duckdb_ctes('alunos')}, limpo AS ({_CLEAN_ALUNOS}) "
    + _dq("aluno", "not_null", "id", "'idade'", "FROM limpo WHERE idade IS NULL"),
    "dq_length": f"{duckdb_ctes('alunos')}, limpo AS ({_CLEAN_ALUNOS}) "
    + _dq(
        "aluno", "length", "id", "concat('genero=', length(genero))",
        "FROM limpo WHERE length(genero) > 10",
    ),
    "dq_range": f"{duckdb_ctes('notas')}, {_TYPED_NOTAS} "
    + _dq(
        "nota", "range", _NOTA_KEY, _SHOWN_NOTA, "FROM tipada WHERE nota NOT BETWEEN 0 AND 10"
    ),
    "dq_decimal": f"{duckdb_ctes('notas')}, {_TYPED_NOTAS} "
    + _dq(
        "nota", "decimal", _NOTA_KEY, _SHOWN_NOTA,
        "FROM tipada WHERE nota IS NOT NULL AND TRY_CAST(nota AS DECIMAL(4,1)) IS NULL",
    ),
    "dq_unique_nota": f"{duckdb_ctes('nota')} {_DQ_UNIQUE}",
    "dq_fk_nota_aluno": f"{duckdb_ctes('nota', 'aluno')} {_DQ_FK_NOTA}",
    "dq_fk_aluno_escola": f"{duckdb_ctes('aluno', 'escola')} {_DQ_FK_ALUNO}",
    "dq_warehouse": f"""{duckdb_ctes("escola", "aluno", "nota")}
        {_DQ_UNIQUE} UNION ALL {_DQ_FK_NOTA} UNION ALL {_DQ_FK_ALUNO}""",
}

STORAGE = {
    "run_summary": f"""{duckdb_ctes("escolas", "alunos", "notas")}
        SELECT 'escola' AS dataset, count(*) AS lidas, count(*) AS gravadas FROM escolas
        UNION ALL SELECT 'aluno', count(*), count(*) FROM alunos
        UNION ALL SELECT 'nota', count(*),
        count(*) FILTER (coalesce(TRY_CAST(nota AS DOUBLE) BETWEEN 0 AND 10, false)) FROM notas""",
    "csv_roundtrip_notas": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "parquet_roundtrip_escola": f"{duckdb_ctes('escolas')} {_CLEAN_ESCOLAS}",
    "parquet_roundtrip_nota": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "parquet_roundtrip_aluno": f"{duckdb_ctes('alunos')} {_CLEAN_ALUNOS}",
    "parquet_pruned_nota": f"""{duckdb_ctes("notas")}
        SELECT * FROM ({_CLEAN_NOTAS}) WHERE disciplina = 'Matemática'""",
    "load_catalog_nota": f"{duckdb_ctes('notas')} {_LOADED_NOTAS}",
    "ingest_notas": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "ingest_after_batch": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "register_after_ingest": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "csv_headers_notas": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "register_headers_notas": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "catalog_tables": f"""{duckdb_ctes("escolas", "alunos", "notas")}
        SELECT row_number() OVER (ORDER BY table_name) AS posicao, * FROM (
        SELECT 'escola' AS table_name, 'MANAGED' AS table_type, 'Tabela de escolas' AS comentario,
        count(*) AS linhas FROM ({_CLEAN_ESCOLAS})
        UNION ALL SELECT 'aluno', 'MANAGED', 'Tabela de alunos', count(*) FROM ({_CLEAN_ALUNOS})
        WHERE idade IS NOT NULL AND length(genero) <= 10
        UNION ALL SELECT 'nota', 'MANAGED', 'Tabela de notas dos alunos por disciplina', count(*)
        FROM ({_CLEAN_NOTAS}))""",
    "register_nota": f"{duckdb_ctes('notas')} {_CLEAN_NOTAS}",
    "estatisticas_disciplina_catalog": NAMED["estatisticas_disciplina"],
    "load_defaults": f"""{duckdb_ctes("escolas")}
        SELECT escola_id, true AS criada, true AS alterada FROM ({_CLEAN_ESCOLAS})""",
    "load_status": f"""{duckdb_ctes("escolas", "alunos")}
        SELECT 'escola' AS "table", 'loaded' AS status UNION ALL
        SELECT 'aluno', CASE WHEN EXISTS (SELECT 1 FROM alunos WHERE escola_id IS NOT NULL
            AND escola_id NOT IN (SELECT escola_id FROM escolas)) THEN 'failed' ELSE 'loaded' END
        UNION ALL SELECT 'nota', CASE WHEN EXISTS (SELECT 1 FROM alunos WHERE escola_id IS NOT NULL
            AND escola_id NOT IN (SELECT escola_id FROM escolas)) THEN 'skipped' ELSE 'loaded' END""",
}
