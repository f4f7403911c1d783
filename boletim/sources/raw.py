"""Raw layer: one folder of headered UTF-8 CSV files per entity."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boletim.schemas import entity
from boletim.sources.layer import FILE_COLUMN, plain

#: Headers that are read at a time.
HEADERS_AT_ONCE = 16


def raw_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{entity(name).raw_name}"


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder, by name; nothing of them is read."""
    return sorted(plain(unquote(f)) for f in spark.read.text(path).inputFiles())


def opened(file: str) -> str:
    """A listed file as a reader takes it, without being a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", file)


def file_of_row() -> Column:
    """The raw file that a row was read from, as listed."""
    # A plus sign stands for itself in a path, and for a space in what is decoded here.
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^file:/+", "file:/")


def header_groups(spark: SparkSession, files: Iterable[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the columns of their header; files without one are left out.

    Only the first rows of each file are read, by a small job per file, several at a time.
    """

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).csv(opened(file)).columns)

    files = list(files)
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, columns in zip(files, pool.map(header, files)):
            if columns:
                groups.setdefault(columns, []).append(file)
    return groups


def _aligned(df: DataFrame, name: str) -> list[Column]:
    """The declared columns, by name; NULL text for those the files do not have."""
    known = {c.lower() for c in df.columns}
    missing = F.lit(None).cast("string")
    return [
        (F.col(c) if c.lower() in known else missing).alias(c) for c in entity(name).column_names
    ]


def read_files(
    spark: SparkSession, files: Iterable[str], name: str, infer: bool = False, origin: bool = False
) -> DataFrame:
    """Read raw files whose headers may differ, each row once.

    Files are grouped by their header, and the groups are united by column name: columns come in any
    order, further ones are ignored, and one that a file lacks is NULL there, save those of the key,
    without which a file is refused. ``origin`` adds the raw file of each row.
    """
    e = entity(name)
    parts = []
    for header, group in sorted(header_groups(spark, files).items()):
        lost = {c.lower() for c in e.key} - {c.lower() for c in header}
        if lost:
            raise ValueError(f"{e.raw_name}: no column {', '.join(sorted(lost))} in {group[0]}")
        reader = spark.read.option("header", True).option("enforceSchema", False)
        if infer:
            reader = reader.option("inferSchema", True)
        else:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
        df = reader.csv([opened(f) for f in group])
        more = [file_of_row().alias(FILE_COLUMN)] if origin else []
        parts.append(df.select(*_aligned(df, name), *more))
    if not parts:
        columns = [*e.column_names, *([FILE_COLUMN] if origin else [])]
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    return reduce(DataFrame.unionByName, parts)


def read_raw(spark: SparkSession, base: str, name: str, infer: bool = False) -> DataFrame:
    """Read one raw dataset.

    Columns are matched by header name, file by file, and are text unless ``infer`` is set, which
    costs a pass over the files.
    """
    return read_files(spark, list_files(spark, raw_path(base, name)), name, infer)


def write_raw(df: DataFrame, base: str, name: str) -> None:
    """Write one raw dataset, full overwrite; padding of the text is kept."""
    padding = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer = df.select(entity(name).column_names).write.mode("overwrite").option("header", True)
    writer.options(**padding).csv(raw_path(base, name))
