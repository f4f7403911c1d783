from __future__ import annotations

import pytest
from pyspark.sql import types as T

from boletim.operators.clean import clean_alunos, clean_escolas, clean_notas, rejected_notas
from boletim.schemas import processed_schema, raw_schema
from boletim.warehouse import to_warehouse
from tests.data import RUN_TS, rows


def _frame(spark, name, data):
    return spark.createDataFrame(data, raw_schema(name))


def test_schools(spark):
    raw = _frame(
        spark,
        "escola",
        [
            ("E1", "  Escola A ", " PÚBLICA ", " Sul "),
            (" E9 ", "\tB", "privada", "   "),
            (None, None, None, None),
        ],
    )
    out = clean_escolas(raw, RUN_TS)
    assert rows(out.select("escola_id", "nome", "rede", "regiao")) == [
        ("E1", "Escola A", "pública", "Sul"),
        (" E9 ", "\tB", "privada", ""),
        (None, None, None, None),
    ]


@pytest.mark.parametrize(
    "text, age",
    [
        ("12", 12), ("12.7", 12), (" 13 ", 13), ("x", None), (None, None), ("", None),
        ("99999999999", None), ("NaN", None), ("-3", -3),
    ],
)
def test_age(spark, text, age):
    out = clean_alunos(_frame(spark, "aluno", [("A1", "N", text, "M", "E1")]), RUN_TS)
    assert out.first()["idade"] == age


def test_gender_and_types(spark):
    out = clean_alunos(_frame(spark, "aluno", [(" A1", " Ana ", "12", " outro ", " E1")]), RUN_TS)
    first = out.first()
    assert (first["id"], first["nome"], first["genero"], first["escola_id"]) == (
        " A1", "Ana", "OUTRO", " E1",
    )
    assert [f.dataType for f in out.schema] == [f.dataType for f in processed_schema("aluno")]


KEPT = {"0": 0.0, "10": 10.0, "9.95": 9.95, " 9.95 ": 9.95}
REJECTED = {
    "-0.01": "fora_da_faixa", "10.05": "fora_da_faixa", "NaN": "fora_da_faixa",
    "Infinity": "fora_da_faixa", "abc": "ilegivel", "": "ilegivel", None: "ausente",
}


def test_grades_kept_and_rejected(spark):
    data = [("A1", " Matemática ", g) for g in [*KEPT, *REJECTED]]
    raw = _frame(spark, "nota", data)
    kept = clean_notas(raw, RUN_TS)
    assert rows(kept.select("disciplina", "nota")) == [("Matemática", v) for v in KEPT.values()]
    rejected = rejected_notas(raw)
    assert {r["nota"]: r["motivo"] for r in rejected.collect()} == REJECTED
    assert kept.count() + rejected.count() == len(data)


def test_one_run_time_for_every_stamp(spark):
    out = clean_notas(_frame(spark, "nota", [("A1", "M", "7")]), RUN_TS)
    stamps = ["ingestion_time", "created_at", "updated_at"]
    assert rows(out.select(stamps)) == [(RUN_TS,) * 3]
    assert {out.schema[s].dataType for s in stamps} == {T.TimestampNTZType()}


def test_warehouse_rounds_half_up_after_the_range_filter(spark):
    texts = ["0.25", "0.35", "9.55", "9.95", "10.04"]
    raw = _frame(spark, "nota", [("A1", "M", t) for t in texts])
    out = to_warehouse(clean_notas(raw, RUN_TS), "nota")
    assert [str(r["nota"]) for r in out.collect()] == ["0.3", "0.4", "9.6", "10.0"]
    assert out.columns == ["aluno_id", "disciplina", "nota", "ingestion_time"]
    assert out.schema["nota"].dataType == T.DecimalType(4, 1)


def test_cleaning_is_one_projection(spark):
    plan = clean_escolas(_frame(spark, "escola", []), RUN_TS)
    optimized = plan._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Project") <= 1
