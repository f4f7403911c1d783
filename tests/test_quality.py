from __future__ import annotations

from decimal import Decimal

from boletim.operators.quality import (
    check_decimal,
    check_fk,
    check_length,
    check_not_null,
    check_range,
    check_unique,
    check_warehouse,
    violation_counts,
)
from boletim.schemas import INGESTION_COLUMN
from boletim.warehouse import Warehouse
from tests.data import rows


def _sorted(df):
    return sorted(rows(df), key=repr)


def test_not_null_reports_every_column(spark):
    data = [("1", None, None), ("2", "x", "y"), (None, "x", None)]
    df = spark.createDataFrame(data, "k string, a string, b string")
    assert _sorted(check_not_null(df, "t", ["k"], ["k", "a", "b"])) == [
        ("t", "not_null", "1", "a"),
        ("t", "not_null", "1", "b"),
        ("t", "not_null", "NULL", "b"),
        ("t", "not_null", "NULL", "k"),
    ]


def test_unique(spark):
    data = [("a", "x"), ("a", "x"), ("a", "y"), (None, "y"), ("b", None), ("b", None)]
    df = spark.createDataFrame(data, "p string, q string")
    assert _sorted(check_unique(df, "t", ["p", "q"])) == [
        ("t", "unique", "NULL|y", "1"),
        ("t", "unique", "a|x", "2"),
        ("t", "unique", "b|NULL", "2"),
    ]


def test_fk_lists_each_missing_parent_once(spark):
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,), ("y",)], "c string")
    parent = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "p string")
    assert _sorted(check_fk(child, "t", "c", parent, "p")) == [
        ("t", "foreign_key", "y", "1"),
        ("t", "foreign_key", "z", "2"),
    ]


def test_range_lets_null_pass(spark):
    data = [("1", -0.5), ("2", 0.0), ("3", 10.0), ("4", 10.5), ("5", None)]
    df = spark.createDataFrame(data, "k string, v double")
    assert _sorted(check_range(df, "t", ["k"], "v", 0, 10)) == [
        ("t", "range", "1", "v=-0.5"),
        ("t", "range", "4", "v=10.5"),
    ]


def test_length_counts_characters(spark):
    df = spark.createDataFrame([("1", "ção"), ("2", "çãos"), ("3", None)], "k string, v string")
    assert _sorted(check_length(df, "t", ["k"], {"v": 3})) == [("t", "length", "2", "v=4")]


def test_decimal(spark):
    data = [("1", 999.94), ("2", 999.95), ("3", float("nan")), ("4", None)]
    df = spark.createDataFrame(data, "k string, v double")
    assert _sorted(check_decimal(df, "t", ["k"], "v", 4, 1)) == [
        ("t", "decimal", "2", "v=999.95"),
        ("t", "decimal", "3", "v=NaN"),
    ]


def test_whole_warehouse(spark):
    escola = spark.createDataFrame(
        [("E1", "n", "r", "Sul"), ("E1", "n", "r", "Sul"), ("E2", None, "r", "x" * 51)],
        "escola_id string, nome string, rede string, regiao string",
    )
    aluno = spark.createDataFrame(
        [("A1", "n", 12, "M", "E1"), ("A2", "n", None, "muito longo", "E9")],
        "id string, nome string, idade int, genero string, escola_id string",
    )
    nota = spark.createDataFrame(
        [("A1", "M", Decimal("10.1")), ("A7", "M", Decimal("5.0")), ("A7", "M", Decimal("5.0"))],
        "aluno_id string, disciplina string, nota decimal(4,1)",
    )
    found = check_warehouse(Warehouse(escola, aluno, nota))
    assert _sorted(found) == sorted(
        [
            ("escola", "unique", "E1", "2"),
            ("escola", "not_null", "E2", "nome"),
            ("escola", "length", "E2", "regiao=51"),
            ("aluno", "not_null", "A2", "idade"),
            ("aluno", "length", "A2", "genero=11"),
            ("aluno", "foreign_key", "E9", "1"),
            ("nota", "range", "A1|M", "nota=10.1"),
            ("nota", "unique", "A7|M", "2"),
            ("nota", "foreign_key", "A7", "2"),
        ],
        key=repr,
    )
    counts = {(r["table"], r["rule"]): r["violations"] for r in violation_counts(found).collect()}
    assert counts[("nota", "foreign_key")] == 1
    assert INGESTION_COLUMN not in found.columns


def test_row_rules_share_one_scan(spark, tmp_path):
    from boletim.operators.quality import check_rows
    from boletim.schemas import NOTA

    spark.range(1).selectExpr(
        "'A' aluno_id", "'M' disciplina", "cast(1 as decimal(4,1)) nota"
    ).write.parquet(str(tmp_path / "n"))
    df = spark.read.parquet(str(tmp_path / "n"))
    plan = check_rows(df, NOTA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    plan = check_not_null(df, "nota", ["aluno_id"], ["aluno_id", "nota"])
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(aluno_id),IsNull(nota))]" in plan
