"""The batch job and its loads.

JDBC writes are recorded, not sent: no database is started for the tests.
"""

from __future__ import annotations

import re
from unittest.mock import patch

import pytest
from pyspark.sql import DataFrameWriter

from boletim.plans.etl import load_input, run_pipeline
from boletim.schemas import ENTITIES
from boletim.sinks.load import CatalogTarget, ConstraintError, JdbcTarget, load_jdbc
from boletim.sinks.tables import create_warehouse
from boletim.warehouse import Warehouse
from tests.data import RUN_TS, rows

RAW = {
    "escolas": "escola_id,nome,rede,regiao\nE1, Um ,PÚBLICA,Sul\nE2,Dois,privada,Norte\n",
    "alunos": "id,nome,idade,genero,escola_id\nA1,Ana,12,f,E1\nA2,Rui,12.7,m,E2\n",
    "notas": "aluno_id,disciplina,nota\nA1,Inglês,9.95\nA2,Inglês,0.25\nA2,História,11\n",
}


def write_raw_files(tmp_path, **changes):
    for name, text in {**RAW, **changes}.items():
        (tmp_path / "raw" / name).mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path / "raw"), str(tmp_path / "processed")


@pytest.fixture
def catalog(spark):
    spark.sql("DROP DATABASE IF EXISTS t_load CASCADE")
    create_warehouse(spark, "t_load")
    yield CatalogTarget(spark, "t_load")
    spark.sql("DROP DATABASE t_load CASCADE")


def test_job_without_warehouse(spark, tmp_path):
    summary = run_pipeline(spark, *write_raw_files(tmp_path), RUN_TS)
    assert sorted(rows(summary.counts)) == [("aluno", 2, 2), ("escola", 2, 2), ("nota", 3, 2)]
    assert summary.loads == []
    w = Warehouse.from_processed(spark, str(tmp_path / "processed"))
    assert sorted(str(r["nota"]) for r in w.nota.collect()) == ["0.3", "10.0"]


def test_job_loads_the_catalog(spark, tmp_path, catalog):
    summary = run_pipeline(spark, *write_raw_files(tmp_path), RUN_TS, catalog)
    assert [(s.table, s.status) for s in summary.loads] == [(n, "loaded") for n in ENTITIES]
    w = Warehouse.from_catalog(spark, "t_load")
    assert sorted(rows(w.escola.select("escola_id", "nome", "rede", "regiao"))) == [
        ("E1", "Um", "pública", "Sul"), ("E2", "Dois", "privada", "Norte"),
    ]
    first = w.nota.first()
    assert first["ingestion_time"] == RUN_TS
    # Left out of the batch, so filled by the table's default.
    assert first["created_at"] is not None and first["created_at"] != RUN_TS


def test_second_load_breaks_the_keys(spark, tmp_path, catalog):
    paths = write_raw_files(tmp_path)
    run_pipeline(spark, *paths, RUN_TS, catalog)
    with pytest.raises(ConstraintError, match="escola: unique=2"):
        run_pipeline(spark, *paths, RUN_TS, catalog)
    assert spark.table("t_load.escola").count() == 2


def test_logged_failure_keeps_parquet_and_skips_the_rest(spark, tmp_path, catalog):
    orphan = RAW["alunos"] + "A3,Eva,13,f,E9\n"
    paths = write_raw_files(tmp_path, alunos=orphan)
    summary = run_pipeline(spark, *paths, RUN_TS, catalog, on_error="log")
    assert [s.status for s in summary.loads] == ["loaded", "failed", "skipped"]
    assert "foreign_key=1" in summary.loads[1].message
    assert sorted(rows(summary.counts))[0] == ("aluno", 3, 3)
    assert spark.table("t_load.aluno").count() == 0


def test_grades_of_known_students_can_follow_later(spark, tmp_path, catalog):
    paths = write_raw_files(tmp_path)
    run_pipeline(spark, *paths, RUN_TS, catalog)
    later = spark.createDataFrame(
        [("A1", "História", 7.0)], "aluno_id string, disciplina string, nota double"
    )
    stamped = later.selectExpr("*", "timestamp_ntz'2024-03-02 00:00:00' ingestion_time")
    from boletim.sinks.load import batch_violations

    nothing = {n: spark.table(f"t_load.{n}").limit(0) for n in ("escola", "aluno")}
    assert batch_violations({**nothing, "nota": stamped}, "nota", catalog).isEmpty()


def test_blank_region_is_loaded_as_text(spark, tmp_path):
    blank = RAW["escolas"] + "E3,Três,privada,   \n"
    raw, processed = write_raw_files(tmp_path, escolas=blank)
    run_pipeline(spark, raw, processed, RUN_TS)
    loaded = load_input(spark, processed, "escola")
    assert sorted(rows(loaded.select("escola_id", "regiao"))) == [
        ("E1", "Sul"), ("E2", "Norte"), ("E3", ""),
    ]


class Recorder:
    """Stands in for a database: ``DataFrameWriter.jdbc`` and the statements run in it."""

    def __init__(self, fail_on=None):
        self.calls, self.fail_on = [], fail_on
        self.log, self.runs, self.moved = [], set(), []

    def __call__(self, writer, url, table, mode=None, properties=None):
        if self.fail_on and table.startswith(self.fail_on):
            raise RuntimeError("connection lost")
        self.calls.append((writer._df, url, table, mode, properties))
        self.log.append(f"{mode} {table}")

    def execute(self, spark, url, properties, statements):
        for text in statements:
            if self.fail_on and text.startswith(self.fail_on):
                raise RuntimeError("connection lost")
            self.log.append(text)
            claim = re.match(r"WITH claimed AS \(INSERT INTO boletim_loads .* VALUES \((.*?)\)", text)
            if claim:  # what the database does: nothing is moved for a run that it has noted
                new = claim[1] not in self.runs
                self.runs.add(claim[1])
                self.moved += re.findall(r"\) INSERT INTO (\w+)", text) if new else []
                return int(new)
        return 0


def _run_with(recorder, spark, tmp_path, **options):
    login = {"user": "u", "password": "p"}
    target = JdbcTarget("jdbc:postgresql://db/x", login, "Run 1'", recorder.execute)
    with patch.object(DataFrameWriter, "jdbc", lambda self, *a, **k: recorder(self, *a, **k)):
        return run_pipeline(spark, *write_raw_files(tmp_path), RUN_TS, target, **options)


def test_jdbc_loads_parents_first_by_way_of_a_stage(spark, tmp_path):
    recorder = Recorder()
    _run_with(recorder, spark, tmp_path)
    assert [(c[2], c[3]) for c in recorder.calls] == [(f"{n}_stage_run1", "overwrite") for n in ENTITIES]
    df, _, _, _, properties = recorder.calls[2]
    assert df.columns == ["aluno_id", "disciplina", "nota", "ingestion_time"]
    assert df.schema["nota"].dataType.simpleString() == "decimal(4,1)"
    assert properties["sslmode"] == "require" and properties["ssl"] == "true"
    assert properties["driver"] == "org.postgresql.Driver" and properties["user"] == "u"
    assert recorder.moved == list(ENTITIES)
    assert recorder.log[-4:] == [
        "overwrite nota_stage_run1",
        "CREATE TABLE IF NOT EXISTS boletim_loads (run_id VARCHAR(100) NOT NULL, "
        "table_name VARCHAR(50) NOT NULL, PRIMARY KEY (run_id, table_name))",
        "WITH claimed AS (INSERT INTO boletim_loads (run_id, table_name) VALUES ('Run 1\'\'', 'nota') "
        "ON CONFLICT DO NOTHING RETURNING run_id) "
        "INSERT INTO nota (aluno_id, disciplina, nota, ingestion_time) "
        "SELECT DISTINCT aluno_id, disciplina, nota, ingestion_time FROM nota_stage_run1 "
        "WHERE EXISTS (SELECT 1 FROM claimed)",
        "DROP TABLE nota_stage_run1",
    ]


def test_jdbc_load_tried_again_adds_what_is_missing(spark, tmp_path):
    recorder = Recorder("aluno_stage")
    summary = _run_with(recorder, spark, tmp_path, on_error="log")
    assert [s.status for s in summary.loads] == ["loaded", "failed", "skipped"]
    assert recorder.moved == ["escola"] and summary.counts.count() == 3
    recorder.fail_on = "DROP TABLE aluno"
    _run_with(recorder, spark, tmp_path, on_error="log")
    assert recorder.moved == ["escola", "aluno"]
    recorder.fail_on = None
    again = _run_with(recorder, spark, tmp_path)
    assert recorder.moved == ["escola", "aluno", "nota"]
    assert [s.message for s in again.loads] == ["nothing to add for run Run 1'"] * 2 + [""]


def test_jdbc_failure_is_raised(spark, tmp_path):
    with pytest.raises(RuntimeError, match="connection lost"):
        _run_with(Recorder("aluno"), spark, tmp_path)


def test_other_databases_note_the_run_in_the_same_transaction():
    from boletim.sinks.load import publishing

    move, note = publishing("jdbc:other:x", "s", "t", ["a", "b"], "r")
    known = "WHERE NOT EXISTS (SELECT 1 FROM boletim_loads WHERE run_id = 'r' AND table_name = 't')"
    assert move == f"INSERT INTO t (a, b) SELECT DISTINCT a, b FROM s {known}"
    assert note == f"INSERT INTO boletim_loads (run_id, table_name) SELECT DISTINCT 'r', 't' FROM s {known}"


def test_jdbc_options_of_other_databases(spark):
    recorder = Recorder()
    with patch.object(DataFrameWriter, "jdbc", lambda self, *a, **k: recorder(self, *a, **k)):
        load_jdbc(spark.range(1), "jdbc:other:x", "t", {"numPartitions": "4"})
    properties = recorder.calls[0][4]
    assert properties == {"numPartitions": "4", "batchsize": "10000"}


def test_command_line_job(spark, tmp_path, catalog, caplog):
    from boletim.job import main

    raw, processed = write_raw_files(tmp_path)
    options = ["--run-ts", "2024-03-01T12:30:00", "--catalog-db", "t_load"]
    with caplog.at_level("INFO"):
        main(["--raw", raw, "--processed", processed, *options])
    assert "nota: 3 rows read, 2 written" in caplog.text
    assert "load of nota: loaded" in caplog.text
    assert spark.table("t_load.nota").first()["ingestion_time"] == RUN_TS


def test_command_line_target(spark, monkeypatch):
    from boletim.job import parse, target_of

    monkeypatch.setenv("DB_PASSWORD", "s")
    paths = ["--raw", "r", "--processed", "p"]
    jdbc = ["--jdbc-url", "jdbc:x", "--jdbc-user", "u", "--jdbc-password-env", "DB_PASSWORD"]
    assert target_of(spark, parse([*paths, *jdbc])) == JdbcTarget(
        "jdbc:x", {"user": "u", "password": "s"}
    )
    assert target_of(spark, parse(paths)) is None


def test_own_sql_over_the_tables(spark, tmp_path):
    raw, processed = write_raw_files(tmp_path)
    run_pipeline(spark, raw, processed, RUN_TS)
    Warehouse.from_processed(spark, processed).create_views()
    found = spark.sql(
        "SELECT e.regiao, percentile_cont(0.5) WITHIN GROUP (ORDER BY n.nota) p, count(*) c "
        "FROM escola e JOIN aluno a USING (escola_id) JOIN nota n ON n.aluno_id = a.id "
        "GROUP BY ALL ORDER BY 1"
    )
    assert [(r["regiao"], float(r["p"]), r["c"]) for r in found.collect()] == [
        ("Norte", 0.3, 1), ("Sul", 10.0, 1),
    ]


def test_references_are_left_to_a_database(spark):
    """A grade of a student who is in the database already is no error of the batch."""
    from boletim.sinks.load import batch_violations

    grade = spark.sql(
        "SELECT 'A9' AS aluno_id, 'Ing' AS disciplina, CAST(7 AS DECIMAL(4,1)) AS nota"
    )
    students = spark.sql("SELECT 'A1' AS id, 'x' AS nome, 1 AS idade, 'f' AS genero, 'E1' AS escola_id")
    tables = {"escola": None, "aluno": students, "nota": grade}
    target = JdbcTarget("jdbc:postgresql://db/x")
    assert batch_violations(tables, "nota", target).isEmpty()
    twice = {**tables, "nota": grade.union(grade)}
    assert [r["rule"] for r in batch_violations(twice, "nota", target).collect()] == ["unique"]


def test_missing_ingestion_time_blocks_the_load(spark, tmp_path, catalog):
    school = spark.sql(
        "SELECT 'E1' AS escola_id, 'Um' AS nome, 'x' AS rede, 'Sul' AS regiao,"
        " CAST(NULL AS TIMESTAMP_NTZ) AS ingestion_time"
    )
    from boletim.sinks.load import load_warehouse

    with pytest.raises(ConstraintError, match="not_null=1"):
        load_warehouse({"escola": school, "aluno": None, "nota": None}, catalog)


def test_stored_keys_are_cut_to_the_batch(spark, tmp_path, catalog):
    from boletim.sinks.load import batch_violations

    run_pipeline(spark, *write_raw_files(tmp_path), RUN_TS, catalog)
    nota = spark.table("t_load.nota").limit(1)
    found = batch_violations(
        {n: spark.table(f"t_load.{n}") for n in ENTITIES} | {"nota": nota}, "nota", catalog
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and found.count() == 1
    # The filter stands over the scan of the stored keys, below any exchange.
    lines, below = plan.split("\n"), []
    for i, line in enumerate(lines):
        if "Filter" in line and "scalar-subquery" in line:
            at = line.index("Filter")
            below.append(next(x for x in lines[i + 1 :] if x[at : at + 3] == "+- "))
    assert any("Relation spark_catalog.t_load.nota" in x for x in below)


def test_bloom_filter_loses_no_key(spark):
    from boletim.operators.bloom import bloom_filter, might_hold

    keys = spark.range(0, 3000).selectExpr("IF(id = 7, NULL, concat('A', id)) AS a", "id % 9 AS b")
    others = spark.range(3000, 40_000).selectExpr("concat('A', id) AS a", "id % 9 AS b")
    for bits, most in ((1 << 16, 0.01), (1 << 10, 1.0)):
        words = bloom_filter(keys.union(keys), ["a", "b"], bits)
        assert len(words.first()["words"]) == bits >> 6
        held = might_hold(words, ["a", "b"], bits)
        assert keys.where(held).count() == 3000
        assert others.where(held).count() <= most * 37_000
    nothing = bloom_filter(keys.limit(0), ["a", "b"], 1 << 10)
    assert keys.where(might_hold(nothing, ["a", "b"], 1 << 10)).count() == 0


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    from boletim.plans import etl

    raw, processed = write_raw_files(tmp_path)
    reads = []
    original = etl.read_files
    with patch.object(etl, "read_files", lambda *a, **k: reads.append(a[2]) or original(*a, **k)):
        done = etl.clean_to_part(spark, raw, processed, "nota", RUN_TS)
    assert (done.read, done.written) == (3, 2) and reads == ["nota"]


def test_rows_of_repeated_tasks_do_not_count(spark, tmp_path):
    """Where the tasks' count is above what the files hold, the raw rows are counted anew."""
    from boletim.plans import etl

    class Twice(etl.Observation):
        @property
        def get(self):
            return {k: 2 * v for k, v in super().get.items()}

    raw, processed = write_raw_files(tmp_path)
    with patch.object(etl, "Observation", Twice):
        done = etl.clean_to_part(spark, raw, processed, "nota", RUN_TS)
    assert (done.read, done.written) == (3, 2)


def test_files_without_rows_make_an_empty_layer(spark, tmp_path):
    paths = write_raw_files(
        tmp_path, escolas="escola_id,nome,rede,regiao\n", alunos="",
        notas="aluno_id,disciplina,nota\nA1,M,99\n",
    )
    summary = run_pipeline(spark, *paths, RUN_TS)
    assert sorted(rows(summary.counts)) == [("aluno", 0, 0), ("escola", 0, 0), ("nota", 1, 0)]
    w = Warehouse.from_processed(spark, paths[1])
    assert [df.count() for df in w.tables().values()] == [0, 0, 0]
