"""The three warehouse tables as a bundle of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boletim.schemas import AUDIT_COLUMNS, ENTITIES, entity
from boletim.sources.processed import read_processed, with_blank_text


def to_warehouse(df: DataFrame, name: str) -> DataFrame:
    """Shape a cleaned dataset for the warehouse.

    Audit columns are dropped, so the table's own defaults fill them. Grades are rounded half up
    to one decimal here, after the range filter, so no database has to round (some truncate).
    """
    return _with_decimals(df.drop(*AUDIT_COLUMNS), name)


def _with_decimals(df: DataFrame, name: str) -> DataFrame:
    casts = {c.name: c.sql_type for c in entity(name).columns if c.sql_type.startswith("decimal")}
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})


@dataclass(frozen=True)
class Warehouse:
    """The three tables, and reductions of the grades made beforehand, if any.

    Grades must be ``decimal(4,1)``, for which the statistics are exact.
    """

    escola: DataFrame
    aluno: DataFrame
    nota: DataFrame
    per_student: DataFrame | None = None
    per_value: DataFrame | None = None
    per_network: DataFrame | None = None

    def __post_init__(self) -> None:
        kind = self.nota.schema["nota"].dataType.simpleString()
        if kind != "decimal(4,1)":
            raise ValueError(f"grades are {kind}; shape the table with to_warehouse first")

    @classmethod
    def from_processed(cls, spark: SparkSession, base: str) -> Warehouse:
        return cls(*(to_warehouse(read_processed(spark, base, n), n) for n in ENTITIES))

    @classmethod
    def from_catalog(cls, spark: SparkSession, db: str) -> Warehouse:
        """Tables of a database: those of the warehouse, or the registered processed layer."""
        tables = (with_blank_text(spark.table(f"{db}.{n}"), n) for n in ENTITIES)
        return cls(*(_with_decimals(df, n) for df, n in zip(tables, ENTITIES)))

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in ENTITIES}

    def create_views(self) -> None:
        """Name the tables for SQL text in this session: ``escola``, ``aluno``, ``nota``."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)
