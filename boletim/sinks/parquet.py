"""Cleaned Parquet layer: every write is a part of its own, which then replaces or adds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from boletim.schemas import entity, processed_schema
from boletim.sources.layer import FILE_COLUMN, RUN, Part, new_part, part_path, publish
from boletim.sources.processed import with_blank_paths


def write_part(
    df: DataFrame, base: str, name: str, kind: str = RUN, files: Iterable[str] = ()
) -> Part:
    """Write one cleaned dataset as a part that does not count before it is published.

    Partitioned data is rebalanced by its region or subject column first: each task then writes one
    directory rather than every task all of them, and a directory with most of the rows is split
    over many tasks at the advisory partition size. Unpartitioned data is written as it was read.
    """
    part = new_part(name, kind, files)
    column = entity(name).partition_by
    origin = [FILE_COLUMN] if FILE_COLUMN in df.columns else []
    out = with_blank_paths(df.select(*processed_schema(name).names, *origin), name)
    if column:
        writer = out.hint("rebalance", column).write.partitionBy(column)
    else:
        writer = out.write
    writer.parquet(part_path(base, name, part.id))
    return part


def write_processed(df: DataFrame, base: str, name: str, files: Iterable[str] = ()) -> None:
    """Replace one cleaned dataset, as a run that has read the raw ``files``.

    Ingested rows of other files stay beside it.
    """
    publish(df.sparkSession, base, [write_part(df, base, name, RUN, files)])


def replace_layer(spark: SparkSession, df: DataFrame, base: str, name: str, files: list[str]):
    """The batch job's write of one dataset; ``df`` must hold all rows of ``files``."""
    write_processed(df, base, name, files)
