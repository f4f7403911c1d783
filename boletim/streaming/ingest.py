"""Incremental ingest: each raw file is taken once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from boletim.operators.clean import CLEANERS
from boletim.schemas import entity
from boletim.sinks.parquet import write_part
from boletim.sources.layer import INGEST, plain, publish, taken_files
from boletim.sources.raw import raw_path, read_files

# The columns of a listing of files.
LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_new(
    spark: SparkSession, base: str, name: str, out: str, checkpoint: str, run_ts: datetime
) -> None:
    """Clean the raw files not seen before and add them to the Parquet layer.

    The stream only lists files; each batch of them is then read by header, so headers may differ.
    ``checkpoint`` records what was listed and must outlive the job, on shared storage. Whether a
    file is in the layer is for the layer's log to say: files that the current run or an earlier
    ingest holds are left out, also after a restart, a replay or with a new checkpoint. A batch
    counts once its part is published, and a batch job may run meanwhile. One ingest of a dataset
    should run at a time; of two, the rows of a file that both took still count once. Cleaning keeps
    no state, so there is no watermark. Returns when the files present are done.
    """
    e = entity(name)
    listing = spark.readStream.format("binaryFile").schema(LISTING).load(raw_path(base, name))

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        held = taken_files(session, out, name)
        fresh = sorted({plain(r["path"]) for r in batch.collect()} - held)
        if fresh:
            rows = read_files(session, fresh, name, origin=True)
            cleaned = CLEANERS[e.name](rows, run_ts)
            publish(session, out, [write_part(cleaned, out, name, INGEST, fresh)])

    writer = (
        # The content is not read: nothing asks for it.
        listing.select("path")
        .writeStream.foreachBatch(add)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
    )
    writer.start().awaitTermination()
