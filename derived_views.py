"""School data derived from the test tables, in SQL that Spark and DuckDB both run.

Every base row is used. Some students sit at schools that do not exist (which leaves other
schools empty) and some have another id than their grades, so references are broken both ways;
grades repeat keys; raw text is padded, in mixed case and partly unreadable.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from boletim.warehouse import Warehouse

BASE_TABLES = ("region", "nation", "customer", "orders", "lineitem")
RUN_TS = datetime(2024, 3, 1, 12, 30)

_SUBJECT = """CASE l_linenumber WHEN 1 THEN 'Matemática' WHEN 2 THEN 'Português'
    WHEN 3 THEN 'Ciências' WHEN 4 THEN 'História' WHEN 5 THEN 'Geografia'
    WHEN 6 THEN 'Inglês' ELSE 'Outra' END"""
_SCHOOLS = """{customer} JOIN {nation} ON c_nationkey = n_nationkey
    JOIN {region} ON n_regionkey = r_regionkey"""
_NETWORK = "CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'pública' ELSE 'privada' END"
_STUDENT_ID = """CASE WHEN o_orderstatus = 'P' AND o_custkey % 5 = 1 THEN concat('T', o_orderkey)
    ELSE CAST(o_orderkey AS {text}) END"""
_SCHOOL_ID = """CASE WHEN o_custkey % 10 = 3 THEN concat('X', o_custkey)
    ELSE CAST(o_custkey AS {text}) END"""

# Warehouse layer, then the raw layer under the raw names.
VIEWS = {
    "escola": f"""SELECT CAST(c_custkey AS {{text}}) AS escola_id, c_name AS nome,
    {_NETWORK} AS rede, r_name AS regiao FROM {_SCHOOLS}""",
    "aluno": f"""SELECT {_STUDENT_ID} AS id, concat('Aluno ', o_orderkey) AS nome,
    CAST(10 + o_orderkey % 9 AS INT) AS idade, o_orderstatus AS genero, {_SCHOOL_ID} AS escola_id
    FROM {{orders}}""",
    "nota": f"""SELECT CAST(l_orderkey AS {{text}}) AS aluno_id, {_SUBJECT} AS disciplina,
    CAST(l_quantity / 4 AS DECIMAL(4,1)) AS nota
    FROM {{lineitem}} WHERE l_quantity / 4 BETWEEN 0 AND 10""",
    "escolas": f"""SELECT CAST(c_custkey AS {{text}}) AS escola_id,
    concat('  ', c_name, ' ') AS nome, concat(' ', upper({_NETWORK}), ' ') AS rede,
    CASE WHEN c_custkey % 11 = 0 THEN '   ' ELSE concat(r_name, '  ') END AS regiao
    FROM {_SCHOOLS}""",
    "alunos": f"""SELECT {_STUDENT_ID} AS id, concat(' Aluno ', o_orderkey, '  ') AS nome,
    CASE o_orderkey % 7 WHEN 0 THEN 'x' WHEN 1 THEN '12.7' WHEN 2 THEN ' 13 ' WHEN 3 THEN NULL
        WHEN 4 THEN '99999999999' ELSE CAST(10 + o_orderkey % 9 AS {{text}}) END AS idade,
    concat(' ', lower(o_orderstatus), CASE WHEN o_orderpriority = '5-LOW'
        THEN 'utro de texto longo' ELSE '' END) AS genero,
    {_SCHOOL_ID} AS escola_id FROM {{orders}}""",
    "notas": f"""SELECT CAST(l_orderkey AS {{text}}) AS aluno_id,
    concat(' ', {_SUBJECT}, '  ') AS disciplina,
    CASE WHEN l_partkey % 41 = 0 THEN 'abc' WHEN l_partkey % 43 = 0 THEN NULL
        WHEN l_partkey % 47 = 0 THEN 'NaN' WHEN l_partkey % 53 = 0 THEN '-0.01'
        WHEN l_partkey % 59 = 0 THEN '12345.6' WHEN l_partkey % 61 = 0 THEN ' 9.95 '
        ELSE CAST(l_quantity / 4 AS {{text}}) END AS nota FROM {{lineitem}}""",
}


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = [t for t in BASE_TABLES if f"{{{t}}}" in VIEWS[name]]
    sql = VIEWS[name].format(text="STRING", **{t: f"{{{t}}}" for t in used})
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(*(spark_view(spark, sf_dir, n) for n in ("escola", "aluno", "nota")))


def duckdb_ctes(*names: str) -> str:
    """A WITH clause holding the named views."""
    tables = {t: t for t in BASE_TABLES}
    views = [f"{n} AS ({VIEWS[n].format(text='VARCHAR', **tables)})" for n in names]
    return "WITH " + ",\n".join(views)
