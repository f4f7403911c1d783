"""The batch job: raw CSV -> cleaned Parquet -> warehouse."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial, reduce
from typing import Literal

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from boletim.operators.clean import CLEANERS
from boletim.schemas import ENTITIES, processed_schema
from boletim.sinks.load import LoadStatus, Target, load_warehouse
from boletim.sinks.parquet import write_part
from boletim.sources.layer import Part, part_path, publish
from boletim.sources.processed import read_processed
from boletim.sources.raw import list_files, raw_path, read_files, read_raw
from boletim.warehouse import to_warehouse

log = logging.getLogger(__name__)

COUNTS_SCHEMA = "dataset string, lidas bigint, gravadas bigint"


@dataclass(frozen=True)
class Summary:
    """``counts`` holds ``dataset, lidas, gravadas``; ``loads`` one status per table."""

    counts: DataFrame
    loads: list[LoadStatus] = field(default_factory=list)


@dataclass(frozen=True)
class Written:
    """A part, and the rows read for it and written to it."""

    part: Part
    read: int
    written: int


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``dataset, linhas`` in one job; a Parquet count only reads footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("dataset"), "linhas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def run_counts(spark: SparkSession, raw: str, processed: str) -> DataFrame:
    """Rows of the raw files and of the layer, per dataset, as they are now.

    Cleaning drops grades only, so of the raw files only theirs are counted.
    """
    tables = {n: read_processed(spark, processed, n) for n in ENTITIES}
    tables["raw"] = read_raw(spark, raw, "nota")
    found = {r["dataset"]: r["linhas"] for r in row_counts(tables).collect()}
    rows = [(n, found["raw"] if n == "nota" else found[n], found[n]) for n in ENTITIES]
    return spark.createDataFrame(rows, COUNTS_SCHEMA)


def _counted(observation: Observation) -> int | None:
    """The rows observed; None where no task had any, and so nothing was observed."""
    try:
        return observation.get["rows"]
    except Py4JJavaError:
        return None


def clean_to_part(
    spark: SparkSession, raw: str, processed: str, name: str, run_ts: datetime
) -> Written:
    """Clean one dataset into a part, counting its rows on the way.

    Rows are counted by the tasks that write them, before and after cleaning. A stage that is run
    again, for a lost executor, counts its rows again; but then the second count is above that of
    the files' footers, and the raw rows are counted by a read of their own.
    """
    files = list_files(spark, raw_path(raw, name))
    before, after = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    source = read_files(spark, files, name)
    cleaned = CLEANERS[name](source.observe(before, rows), run_ts).observe(after, rows)
    part = write_part(cleaned, processed, name, files=files)
    stored = spark.read.schema(processed_schema(name)).parquet(part_path(processed, name, part.id))
    read, written = _counted(before), stored.count()
    if read is None or _counted(after) != written:
        log.info("%s: the tasks' counts are not the files', raw rows are read again", name)
        read = source.count()
    return Written(part, read, written)


def load_input(spark: SparkSession, processed: str, name: str) -> DataFrame:
    """Warehouse rows of one dataset, taken from the Parquet layer."""
    return to_warehouse(read_processed(spark, processed, name), name)


def run_pipeline(
    spark: SparkSession,
    raw: str,
    processed: str,
    run_ts: datetime,
    warehouse: Target | None = None,
    on_error: Literal["raise", "log"] = "raise",
) -> Summary:
    """Clean and store the three datasets, then load them if a ``warehouse`` is given.

    The raw text is read once, for the write; what follows reads Parquet. The three datasets appear
    in the layer together, in place of the last run's and of the ingested rows whose files this run
    has read. With ``on_error="log"`` a failed load leaves the Parquet layer and the job's success
    in place.
    """
    done = {}
    for name in ENTITIES:
        done[name] = clean_to_part(spark, raw, processed, name, run_ts)
        log.info("%s written", name)
    publish(spark, processed, [w.part for w in done.values()])
    loads: list[LoadStatus] = []
    if warehouse is not None:
        tables = {n: partial(load_input, spark, processed, n) for n in ENTITIES}
        loads = load_warehouse(tables, warehouse, on_error)
    counts = [(n, w.read, w.written) for n, w in done.items()]
    return Summary(spark.createDataFrame(counts, COUNTS_SCHEMA), loads)
