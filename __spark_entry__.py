
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

import oracle  # noqa: E402
from boletim.operators.clean import (  # noqa: E402
    clean_alunos,
    clean_escolas,
    clean_notas,
    rejected_notas,
)
from boletim.operators.order import with_position  # noqa: E402
from boletim.operators.quality import (  # noqa: E402
    check_decimal,
    check_fk,
    check_length,
    check_not_null,
    check_range,
    check_unique,
    check_warehouse,
)
from boletim.plans.etl import row_counts, run_pipeline  # noqa: E402
from boletim.plans.queries import NAMED_QUERIES, media_global  # noqa: E402
from boletim.plans.report import prepared  # noqa: E402
from boletim.schemas import (  # noqa: E402
    ALUNO,
    ENTITIES,
    GRADE_RANGE,
    NOTA,
    processed_schema,
    raw_schema,
)
from boletim.sinks.load import CatalogTarget  # noqa: E402
from boletim.sinks.parquet import write_processed  # noqa: E402
from boletim.sinks.tables import create_warehouse  # noqa: E402
from boletim.sources.catalog import (  # noqa: E402
    list_tables,
    register_dataset,
    register_processed,
)
from boletim.sources.processed import read_processed  # noqa: E402
from boletim.sources.raw import list_files, raw_path, read_raw, write_raw  # noqa: E402
from boletim.storage import shared_folder  # noqa: E402
from boletim.streaming.ingest import ingest_new  # noqa: E402
from boletim.warehouse import Warehouse, to_warehouse  # noqa: E402
from derived_views import RUN_TS, spark_view, warehouse  # noqa: E402

LLM_QUERIES, LLM_SQL = {}, {}
if os.path.exists(f"{HERE}/corpus_pipeline.py") and os.path.exists(f"{HERE}/boletim/llm/queries.py"):
    import corpus_pipeline
    from boletim.llm.queries import QUERIES
    from boletim.llm.sql import SQL as LLM_SQL

    LLM_QUERIES = {**QUERIES, "pipeline": corpus_pipeline.run}

Query = Callable[[SparkSession, str], DataFrame]


def _named(question: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: question(warehouse(spark, sf_dir))


def _prepared(question: Callable[[Warehouse], DataFrame], reduction: str) -> Query:
    """The question over grades reduced and written beforehand."""
    return lambda spark, sf_dir: question(
        prepared(spark, warehouse(spark, sf_dir), reductions=[reduction])
    )


def _on_view(name: str, work: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: work(spark_view(spark, sf_dir, name))


def _typed_notas(raw: DataFrame) -> DataFrame:
    """Grades as numbers but not yet filtered, so that range and precision can fail."""
    return raw.withColumn("nota", F.col("nota").try_cast("double"))


def _dq_fk_nota(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return check_fk(w.nota, "nota", "aluno_id", w.aluno, "id")


def _dq_fk_aluno(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return check_fk(w.aluno, "aluno", "escola_id", w.escola, "escola_id")


def _warehouse_rows(df: DataFrame) -> DataFrame:
    """Warehouse grades, shown as doubles after the decimal rounding."""
    return df.select(
        "aluno_id", "disciplina", F.col("nota").cast("double").alias("nota"), "ingestion_time"
    )


def _raw_layer(spark: SparkSession, sf_dir: str, *names: str) -> str:
    base = shared_folder(spark, "raw")
    for name in names:
        write_raw(spark_view(spark, sf_dir, name), base, name)
    return base


def _run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_layer(spark, sf_dir, "escolas", "alunos", "notas")
    return run_pipeline(spark, raw, shared_folder(spark, "processed"), RUN_TS).counts


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_layer(spark, sf_dir, "notas")
    return clean_notas(read_raw(spark, raw, "notas"), RUN_TS)


def _parquet_roundtrip(spark: SparkSession, cleaned: DataFrame, name: str) -> DataFrame:
    base = shared_folder(spark, "processed")
    write_processed(cleaned, base, name)
    return read_processed(spark, base, name)


def _roundtrip_escola(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_escolas(spark_view(spark, sf_dir, "escolas"), RUN_TS)
    return _parquet_roundtrip(spark, cleaned, "escola")


def _roundtrip_aluno(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_alunos(spark_view(spark, sf_dir, "alunos"), RUN_TS)
    return _parquet_roundtrip(spark, cleaned, "aluno")


def _pruned_nota(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_notas(spark_view(spark, sf_dir, "notas"), RUN_TS)
    stored = _parquet_roundtrip(spark, cleaned, "nota")
    return stored.where(F.col("disciplina") == "Matemática")


def _roundtrip_nota(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_notas(spark_view(spark, sf_dir, "notas"), RUN_TS)
    return _parquet_roundtrip(spark, cleaned, "nota")


def _new_database(spark: SparkSession) -> str:
    path = shared_folder(spark, "warehouse")
    db = "boletim_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    return db


def _load_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert cleaned grades into a fresh warehouse table and read it back."""
    db = _new_database(spark)
    create_warehouse(spark, db)
    cleaned = clean_notas(spark_view(spark, sf_dir, "notas"), RUN_TS)
    CatalogTarget(spark, db).append(to_warehouse(cleaned, "nota"), "nota")
    return _warehouse_rows(spark.table(f"{db}.nota"))


def _ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Take the raw files, then run again: nothing is taken twice."""
    raw = _raw_layer(spark, sf_dir, "notas")
    out, checkpoint = shared_folder(spark, "ingested"), shared_folder(spark, "taken")
    for _ in range(2):
        ingest_new(spark, raw, "notas", out, checkpoint, RUN_TS)
    return read_processed(spark, out, "nota")


_PADDED = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _batch_then_ingest(spark: SparkSession, sf_dir: str) -> str:
    """A layer with one part of the grades by the batch job, then the other by ingest."""
    raw, out = shared_folder(spark, "raw"), shared_folder(spark, "processed")
    later = F.coalesce(F.pmod(F.xxhash64("aluno_id"), F.lit(3)) == 0, F.lit(False))
    notas = spark_view(spark, sf_dir, "notas")
    write_raw(notas.where(~later), raw, "notas")
    files = list_files(spark, raw_path(raw, "notas"))
    write_processed(clean_notas(read_raw(spark, raw, "notas"), RUN_TS), out, "nota", files)
    # The files that follow have their columns in another order.
    rest = notas.where(later).select("nota", "aluno_id", "disciplina")
    rest.write.mode("append").options(**_PADDED).csv(raw_path(raw, "notas"))
    ingest_new(spark, raw, "notas", out, shared_folder(spark, "taken"), RUN_TS)
    return out


def _ingest_after_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_processed(spark, _batch_then_ingest(spark, sf_dir), "nota")


def _register_after_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered layer holds what the batch job and what the ingest has written."""
    db = _new_database(spark)
    done = register_processed(spark, db, _batch_then_ingest(spark, sf_dir), "nota")
    return spark.table(done.table)


def _mixed_headers(spark: SparkSession, sf_dir: str) -> str:
    """Raw grades in files of three headers: declared, in another order, with another column."""
    base = shared_folder(spark, "raw")
    notas = spark_view(spark, sf_dir, "notas")
    third = F.pmod(F.xxhash64("aluno_id", "disciplina"), F.lit(3))
    more = F.concat("aluno_id", F.lit("/x")).alias("turma")
    layouts = (["aluno_id", "disciplina", "nota"], ["nota", "disciplina", "aluno_id"],
               [more, "nota", "aluno_id", "disciplina"])
    for k, columns in enumerate(layouts):
        part = notas.where(F.coalesce(third, F.lit(0)) == k).select(*columns)
        part.write.mode("append").options(**_PADDED).csv(raw_path(base, "notas"))
    return base


def _csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_notas(read_raw(spark, _mixed_headers(spark, sf_dir), "notas"), RUN_TS)


def _register_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table over raw files whose headers differ."""
    db, path = _new_database(spark), raw_path(_mixed_headers(spark, sf_dir), "notas")
    done = register_dataset(spark, db, "notas", path, "csv", raw_schema("notas"))
    notas = spark.table(done.table).select(NOTA.column_names)
    return clean_notas(notas, RUN_TS)


def _register_nota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer registered before and after its grades are replaced."""
    db, base = _new_database(spark), shared_folder(spark, "processed")
    view = spark_view(spark, sf_dir, "notas")
    first = F.trim("disciplina") != "Matemática"
    for part in (view.where(first), view):
        write_processed(clean_notas(part, RUN_TS), base, "nota")
        register_processed(spark, db, base, "nota")
    return spark.table(f"{db}.nota")


def _statistics_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question over grades that are stored as doubles behind a registered layer."""
    db, base = _new_database(spark), shared_folder(spark, "processed")
    w = warehouse(spark, sf_dir)
    for name, df in w.tables().items():
        stamps = {
            c: F.lit(RUN_TS).cast("timestamp_ntz")
            for c in processed_schema(name).names if c not in df.columns
        }
        numbers = {"nota": F.col("nota").cast("double")} if name == "nota" else {}
        write_processed(df.withColumns({**stamps, **numbers}), base, name)
        register_processed(spark, db, base, name)
    return NAMED_QUERIES["estatisticas_disciplina"](Warehouse.from_catalog(spark, db))


def _catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse's tables in the order they are listed, with comments and rows."""
    db = _new_database(spark)
    create_warehouse(spark, db)
    cleaners = {"escola": clean_escolas, "aluno": clean_alunos, "nota": clean_notas}
    target = CatalogTarget(spark, db)
    for name, clean in cleaners.items():
        cleaned = clean(spark_view(spark, sf_dir, ENTITIES[name].raw_name), RUN_TS)
        kept = reduce(lambda df, c: df.where(F.col(c).isNotNull()), ENTITIES[name].column_names, cleaned)
        lengths = ENTITIES[name].lengths
        kept = reduce(lambda df, c: df.where(F.char_length(c) <= lengths[c]), lengths, kept)
        target.append(to_warehouse(kept, name), name)
    listed = with_position(list_tables(spark, db, [*cleaners, "outra"]))
    comments = [(n, spark.catalog.getTable(f"{db}.{n}").description) for n in cleaners]
    about = spark.createDataFrame(comments, "table_name string, comentario string")
    counts = row_counts({n: spark.table(f"{db}.{n}") for n in cleaners})
    return listed.join(about, "table_name").join(
        counts.withColumnRenamed("dataset", "table_name"), "table_name"
    )


def _ordered(question: Callable[[Warehouse], DataFrame]) -> Query:
    """The question's rows with their places, which show its order."""
    return lambda spark, sf_dir: with_position(question(warehouse(spark, sf_dir)))


def _loads(spark: SparkSession, sf_dir: str) -> tuple[str, list]:
    raw, db = _raw_layer(spark, sf_dir, "escolas", "alunos", "notas"), _new_database(spark)
    create_warehouse(spark, db)
    target = CatalogTarget(spark, db)
    folder = shared_folder(spark, "processed")
    return db, run_pipeline(spark, raw, folder, RUN_TS, target, on_error="log").loads


def _load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(s.table, s.status) for s in _loads(spark, sf_dir)[1]]
    return spark.createDataFrame(rows, "table string, status string")


def _load_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose left-out columns the table has filled."""
    db, _ = _loads(spark, sf_dir)
    return spark.table(f"{db}.escola").select(
        "escola_id",
        F.col("created_at").isNotNull().alias("criada"),
        F.col("updated_at").isNotNull().alias("alterada"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """Mean grade and spread of every school, empty schools included."""
    w = warehouse(spark, "/root/testdata/sf0.001")
    return NAMED_QUERIES["media_por_escola"](w)


def queries() -> dict[str, Query]:
    named = {name: _named(question) for name, question in NAMED_QUERIES.items()}
    return {
        **named,
        **{f"ordem_{name}": _ordered(question) for name, question in NAMED_QUERIES.items()},
        "media_global": _named(media_global),
        "ranking_escolas_regiao_prepared": _prepared(
            NAMED_QUERIES["ranking_escolas_regiao"], "per_student"
        ),
        "comparacao_redes_prepared": _prepared(NAMED_QUERIES["comparacao_redes"], "per_network"),
        "estatisticas_disciplina_prepared": _prepared(
            NAMED_QUERIES["estatisticas_disciplina"], "per_value"
        ),
        "clean_escolas": _on_view("escolas", lambda df: clean_escolas(df, RUN_TS)),
        "clean_alunos": _on_view("alunos", lambda df: clean_alunos(df, RUN_TS)),
        "clean_notas": _on_view("notas", lambda df: clean_notas(df, RUN_TS)),
        "rejected_notas": _on_view("notas", rejected_notas),
        "warehouse_nota": _on_view(
            "notas", lambda df: _warehouse_rows(to_warehouse(clean_notas(df, RUN_TS), "nota"))
        ),
        "dq_not_null": _on_view(
            "alunos",
            lambda df: check_not_null(
                clean_alunos(df, RUN_TS), "aluno", ALUNO.key, ALUNO.column_names
            ),
        ),
        "dq_length": _on_view(
            "alunos",
            lambda df: check_length(clean_alunos(df, RUN_TS), "aluno", ALUNO.key, ALUNO.lengths),
        ),
        "dq_range": _on_view(
            "notas",
            lambda df: check_range(
                _typed_notas(df), "nota", NOTA.key, "nota", *GRADE_RANGE
            ),
        ),
        "dq_decimal": _on_view(
            "notas",
            lambda df: check_decimal(
                _typed_notas(df), "nota", NOTA.key, "nota", 4, 1
            ),
        ),
        "dq_unique_nota": _on_view("nota", lambda df: check_unique(df, "nota", NOTA.key)),
        "dq_fk_nota_aluno": _dq_fk_nota,
        "dq_fk_aluno_escola": _dq_fk_aluno,
        "dq_warehouse": _named(check_warehouse),
        "run_summary": _run_summary,
        "csv_roundtrip_notas": _csv_roundtrip,
        "parquet_roundtrip_escola": _roundtrip_escola,
        "parquet_roundtrip_aluno": _roundtrip_aluno,
        "parquet_pruned_nota": _pruned_nota,
        "load_catalog_nota": _load_catalog,
        "ingest_notas": _ingest,
        "ingest_after_batch": _ingest_after_batch,
        "register_after_ingest": _register_after_ingest,
        "csv_headers_notas": _csv_headers,
        "register_headers_notas": _register_headers,
        "catalog_tables": _catalog_tables,
        "parquet_roundtrip_nota": _roundtrip_nota,
        "register_nota": _register_nota,
        "estatisticas_disciplina_catalog": _statistics_catalog,
        "load_status": _load_status,
        "load_defaults": _load_defaults,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {
        **oracle.NAMED,
        **oracle.ORDERED,
        **oracle.PREPARED,
        **oracle.CLEAN,
        **oracle.QUALITY,
        **oracle.STORAGE,
        **LLM_SQL,
    }
