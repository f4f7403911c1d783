"""What the plans must keep at scale: scans, pruning, hot keys."""

from __future__ import annotations

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import derived_views
from boletim.operators.clean import clean_notas
from boletim.operators.quality import check_warehouse
from boletim.operators.ranking import with_rank
from boletim.plans.queries import NAMED_QUERIES, media_global
from boletim.plans.report import answer_all, prepared
from boletim.schemas import raw_schema
from boletim.sinks.parquet import write_processed
from boletim.sources.processed import read_processed
from boletim.warehouse import Warehouse, to_warehouse
from tests.conftest import SF_DIR
from tests.data import RUN_TS, golden, rows
from tests.test_queries import GOLDEN


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("name", NAMED_QUERIES)
def test_scans_of_each_table(spark, conf, name, broadcast):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    plan = final_plan(NAMED_QUERIES[name](derived_views.warehouse(spark, SF_DIR)))
    grades = len(re.findall(r"FileScan parquet \[l_", plan))
    students = len(re.findall(r"FileScan parquet \[o_", plan))
    assert grades == (2 if name == "estatisticas_disciplina" else 1)
    assert students <= 1
    for unneeded in ("l_extendedprice", "l_shipdate", "o_totalprice", "o_orderdate", "c_acctbal"):
        assert unneeded not in plan


def test_checks_scan_each_table_twice(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = final_plan(check_warehouse(derived_views.warehouse(spark, SF_DIR)))
    reads = re.sub(r"== Initial Plan ==.*", "", plan, flags=re.S)
    assert len(re.findall(r"FileScan parquet \[l_", reads)) == 2
    assert len(re.findall(r"FileScan parquet \[o_", reads)) == 2
    assert len(re.findall(r"FileScan parquet \[c_", reads)) == 2


def test_network_comparison_shuffles_no_subject(spark):
    plan = final_plan(NAMED_QUERIES["comparacao_redes"](derived_views.warehouse(spark, SF_DIR)))
    assert "l_linenumber" not in plan and "disciplina" not in plan


def test_values_are_counted_without_student_ids(spark, tmp_path):
    base = str(tmp_path)
    raw = spark.createDataFrame([("A1", "M", "7"), ("A2", "H", "8")], raw_schema("nota"))
    write_processed(clean_notas(raw, RUN_TS), base, "nota")
    w = Warehouse(None, None, to_warehouse(read_processed(spark, base, "nota"), "nota"))
    names = ("histograma_disciplina", "ranking_disciplinas")
    for question in (*[NAMED_QUERIES[n] for n in names], media_global):
        assert "ReadSchema: struct<nota:double>" in final_plan(question(w))


HOT_ROWS = 60_000


@pytest.fixture(scope="module")
def hot_folder(spark, tmp_path_factory):
    """A third of the grades on one student, a third of the students at one school."""
    folder = tmp_path_factory.mktemp("hot")
    third = F.col("id") % 3 == 0
    escola = spark.range(300).select(
        F.concat(F.lit("E"), "id").alias("escola_id"),
        F.concat(F.lit("Escola "), "id").alias("nome"),
        F.when(F.col("id") % 2 == 0, "pública").otherwise("privada").alias("rede"),
        F.when(F.col("id") % 5 == 0, "Sul").otherwise("Norte").alias("regiao"),
    )
    aluno = spark.range(HOT_ROWS).select(
        F.concat(F.lit("A"), "id").alias("id"),
        F.when(third, "E0").otherwise(F.concat(F.lit("E"), F.col("id") % 300)).alias("escola_id"),
    )
    nota = spark.range(HOT_ROWS).select(
        F.when(third, "A0").otherwise(F.concat(F.lit("A"), "id")).alias("aluno_id"),
        F.when(F.col("id") % 4 == 0, "Inglês").otherwise("Matemática").alias("disciplina"),
        (F.pmod(F.hash("id"), F.lit(101)) / 10).cast("decimal(4,1)").alias("nota"),
    )
    for name, df in (("escola", escola), ("aluno", aluno), ("nota", nota)):
        df.repartition(8).write.parquet(str(folder / name))
    return folder


def hot_warehouse(spark, folder) -> Warehouse:
    return Warehouse(*(spark.read.parquet(str(folder / n)) for n in ("escola", "aluno", "nota")))


@pytest.fixture
def shuffle_everything(conf):
    """Joins as for large tables, with sizes scaled down."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
        spark__sql__files__maxPartitionBytes="64KB",
        spark__sql__files__openCostInBytes="0",
        spark__sql__shuffle__partitions="16",
    )


@pytest.mark.parametrize("name", ["disciplina_por_rede", "comparacao_redes"])
def test_hot_student_is_split_over_tasks(spark, hot_folder, shuffle_everything, name):
    w = hot_warehouse(spark, hot_folder)
    plan = final_plan(NAMED_QUERIES[name](w))
    assert "SortMergeJoin(skew=true) [aluno_id" in plan


@pytest.mark.parametrize("name", ["media_por_regiao", "rede_por_regiao", "comparacao_redes"])
def test_hot_school_is_split_over_tasks(spark, hot_folder, shuffle_everything, name):
    w = hot_warehouse(spark, hot_folder)
    assert "SortMergeJoin(skew=true) [escola_id" in final_plan(NAMED_QUERIES[name](w))


@pytest.mark.parametrize("name", NAMED_QUERIES)
def test_hot_keys_do_not_change_results(spark, hot_folder, shuffle_everything, conf, name):
    w = hot_warehouse(spark, hot_folder)
    split = rows(NAMED_QUERIES[name](w))
    conf(spark__sql__autoBroadcastJoinThreshold="10MB", spark__sql__adaptive__enabled="false")
    assert rows(NAMED_QUERIES[name](w)) == split


@pytest.mark.parametrize("keys", [[], ["g"], ["g", "h"]])
def test_rank_equals_the_window_function(spark, keys):
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None])
        other = Decimal(rnd.randint(0, 10**6)) / 10**5
        v = rnd.choice([None, Decimal(10), other, Decimal("6.66666")])
        data.append((i, g, rnd.choice(["x", None]), v))
    df = spark.createDataFrame(data, "i int, g string, h string, v decimal(22,19)")
    got = with_rank(df, keys, "v", "r", "m")
    window = Window.partitionBy(*keys)
    want = df.select(
        "*",
        F.rank().over(window.orderBy(F.desc_nulls_first("v"))).cast("bigint").alias("r"),
        F.avg(F.col("v").cast("double")).over(window).alias("m"),
    )
    assert got.columns == want.columns
    for a, b in zip(sorted(rows(got)), sorted(rows(want)), strict=True):
        assert a[:5] == b[:5] and float(a[5]) == pytest.approx(b[5])


def test_all_answers_over_one_reduction(spark, tmp_path):
    answers = answer_all(spark, golden(spark), str(tmp_path))
    assert {name: rows(df) for name, df in answers.items()} == GOLDEN


def test_prepared_questions_leave_the_grades_alone(spark):
    ready = prepared(spark, derived_views.warehouse(spark, SF_DIR))
    for name in NAMED_QUERIES:
        if name == "estatisticas_disciplina":
            continue  # its distinct students are counted from the grades
        assert "FileScan parquet [l_" not in final_plan(NAMED_QUERIES[name](ready))


def test_hot_value_is_split_over_tasks(spark, tmp_path, shuffle_everything):
    """Most rows share one value, which the join of ranks back to the rows has to split."""
    value = F.when(F.col("id") % 3 > 0, F.pmod(F.hash("id"), F.lit(99_999)) / 10_000)
    df = spark.range(HOT_ROWS).select(
        "id", F.lit("Sul").alias("g"), value.cast("decimal(22,19)").alias("v")
    )
    df.repartition(8).write.parquet(str(tmp_path / "v"))
    ranked = with_rank(spark.read.parquet(str(tmp_path / "v")), ["g"], "v", "r", "m")
    assert "SortMergeJoin(skew=true) [coalesce(g" in final_plan(ranked)
    assert ranked.where("v is null").select("r").distinct().collect() == [(1,)]
