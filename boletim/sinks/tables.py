"""Warehouse tables in the Spark catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from boletim.schemas import AUDIT_COLUMNS, ENTITIES, INGESTION_COLUMN, Entity


def _columns_sql(e: Entity) -> str:
    columns = [f"{c.name} {c.sql_type} NOT NULL" for c in e.columns]
    columns.append(f"{INGESTION_COLUMN} TIMESTAMP_NTZ NOT NULL")
    columns += [f"{c} TIMESTAMP_NTZ DEFAULT localtimestamp()" for c in AUDIT_COLUMNS]
    return ", ".join(columns)


def create_warehouse(spark: SparkSession, db: str) -> None:
    """Create the missing tables, with types, length limits, defaults and comments.

    Keys, references and NOT NULL are not enforced by file tables; they are checked before a
    load (:mod:`boletim.sinks.load`). Tables are not partitioned, since a partition directory
    cannot tell empty text from NULL.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for e in ENTITIES.values():
        # COMMENT ON TABLE afterwards would rewrite the schema without its length limits.
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{e.name} ({_columns_sql(e)}) "
            f"USING parquet COMMENT '{e.comment}'"
        )
