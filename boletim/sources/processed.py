"""Processed layer: cleaned Parquet, partitioned by region (schools) and subject (grades)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from boletim.schemas import entity, processed_schema
from boletim.sources.layer import (
    FILE_COLUMN,
    PART_COLUMN,
    LivePart,
    live_parts,
    part_path,
    processed_path,
)

# Empty text in a partition column, which a path would turn into NULL.
BLANK = "__BLANK__"


def _mapped(df: DataFrame, name: str, value: Column, out: Column) -> DataFrame:
    column = entity(name).partition_by
    if not column:
        return df
    return df.withColumn(column, F.when(F.col(column) == value, out).otherwise(F.col(column)))


def with_blank_paths(df: DataFrame, name: str) -> DataFrame:
    """Empty text of the partition column in the form that a path keeps."""
    return _mapped(df, name, F.lit(""), F.lit(BLANK))


def with_blank_text(df: DataFrame, name: str) -> DataFrame:
    return _mapped(df, name, F.lit(BLANK), F.lit(""))


def parts_schema(name: str) -> T.StructType:
    """Columns of the part folders: those of the dataset, the raw file of a row, the part."""
    extra = [T.StructField(c, T.StringType()) for c in (FILE_COLUMN, PART_COLUMN)]
    return T.StructType([*processed_schema(name).fields, *extra])


def _parts(spark: SparkSession, base: str, name: str, parts: list[LivePart]) -> DataFrame:
    """Rows that count, from one scan of the parts that count whole and one of each other."""
    reader = spark.read.schema(parts_schema(name)).option("basePath", processed_path(base, name))
    whole = [part_path(base, name, p.id) for p in parts if not p.dead]
    frames = [reader.parquet(*whole)] if whole else []
    for p in parts:
        if p.dead:
            rows = reader.parquet(part_path(base, name, p.id))
            frames.append(rows.where(~F.col(FILE_COLUMN).isin(list(p.dead))))
    columns = processed_schema(name).names
    return reduce(DataFrame.unionByName, [df.select(columns) for df in frames])


def read_processed(
    spark: SparkSession, base: str, name: str, version: int | None = None
) -> DataFrame:
    """Read a dataset back with the declared schema: partition values stay text.

    The parts are settled here, from the log: what is published later does not change the frame.
    ``version`` reads the layer as it was then. A folder that no entry of the log speaks of, as
    another tool may have written it, is read as it is.
    """
    parts = live_parts(spark, base, name, version)
    if parts:
        return with_blank_text(_parts(spark, base, name, parts), name)
    try:
        df = spark.read.schema(processed_schema(name)).parquet(processed_path(base, name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = None
    if df is None or version is not None or any(PART_COLUMN + "=" in f for f in df.inputFiles()):
        raise FileNotFoundError(f"no processed data of {name} in {base}")
    return with_blank_text(df.select(processed_schema(name).names), name)
