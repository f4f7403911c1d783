"""The processed layer as immutable parts, and the log that says which of them count.

Every write makes a part: a folder of its own, ``<base>/<dataset>/part=<id>``, that nothing changes
afterwards. It counts from the moment an entry of the log names it. An entry is one small file, so
it is there or not, and it may name parts of several datasets, which then appear together. Each
entry has a version, one above the highest before it.

A part is of one of two kinds. A *run* replaces the runs before it. An *ingest* adds to them, until a
run has read the same raw files. Both list the raw files they hold, and what counts is decided when
reading, from the log alone:

* of runs, the one of the highest version;
* of an ingest, the rows of those raw files that neither a run published since, nor the run that was
  current when it was published, nor an earlier ingest holds.

So a file that arrives while a run is under way stays, whichever of both is published first, and no
row counts twice. An ingest that a run has read in part keeps its rows of the other files: ingested
rows carry their raw file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from boletim.schemas import entity

RUN, INGEST = "run", "ingest"
PART_COLUMN = "part"
FILE_COLUMN = "raw_file"
LOG_SCHEMA = "entity string, part string, kind string, version bigint, file string"


@dataclass(frozen=True)
class Part:
    """A written part of a dataset, and the raw files it was made from."""

    entity: str
    id: str
    kind: str
    files: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class LivePart:
    """A part that counts. ``dead`` are the raw files whose rows in it do not."""

    id: str
    kind: str
    dead: tuple[str, ...] = ()


def processed_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{entity(name).name}"


def part_path(base: str, name: str, part: str) -> str:
    return f"{processed_path(base, name)}/{PART_COLUMN}={part}"


def log_path(base: str) -> str:
    return f"{base.rstrip('/')}/log"


def new_part(name: str, kind: str, files: Iterable[str] = ()) -> Part:
    part = f"{kind}-{uuid.uuid4().hex}"
    return Part(entity(name).name, part, kind, sorted(set(map(plain, files))))


def plain(file: str) -> str:
    """The path of a listed file, with local files written one way."""
    head, slashes, rest = file.partition(":")
    return f"file:/{rest.lstrip('/')}" if slashes and head == "file" else file


def entries(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """Rows of the log, one per part and raw file; a part without any has one with a NULL file."""
    try:
        found = spark.read.schema(LOG_SCHEMA).parquet(log_path(base))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], LOG_SCHEMA)
    return found if version is None else found.where(F.col("version") <= version)


def current_version(spark: SparkSession, base: str) -> int:
    """Version of the newest entry, 0 without any."""
    return entries(spark, base).agg(F.max("version")).first()[0] or 0


def publish(spark: SparkSession, base: str, parts: Iterable[Part]) -> int:
    """Make parts count, all at once; returns the version they appear in."""
    version = current_version(spark, base) + 1
    rows = [(p.entity, p.id, p.kind, version, f) for p in parts for f in p.files or [None]]
    entry = f"{log_path(base)}/entry={version:010d}-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.parquet(entry)
    return version


def live_files(
    spark: SparkSession, base: str, name: str, version: int | None = None
) -> DataFrame:
    """``part, kind, version, file, live`` of the current run and of every ingest."""
    log = entries(spark, base, version).where(F.col("entity") == entity(name).name)
    versions = log.where(F.col("kind") == RUN).select("part", "version").distinct()
    runs = sorted((r["version"], r["part"]) for r in versions.collect())
    known = F.array(*[F.lit(v) for v, _ in runs]).cast("array<bigint>")
    current = F.array_max(F.filter(known, lambda v: v < F.col("i.version")))
    held = log.where(F.col("kind") == RUN).select("file", "version").distinct()
    by_run = (F.col("r.version") >= F.col("i.version")) | (F.col("r.version") == current)
    ingests = log.where(F.col("kind") == INGEST).alias("i")
    left = ingests.join(
        held.alias("r"), (F.col("r.file") == F.col("i.file")) & by_run, "left_anti"
    ).select("part", "version", "file")
    owner = left.groupBy("file").agg(F.min(F.struct("version", "part")).alias("owner"))
    owned = owner.select("file", F.col("owner.part").alias("part"), F.lit(True).alias("live"))
    ingested = ingests.join(owned, ["part", "file"], "left").select(
        "part", "kind", "version", "file", F.coalesce("live", F.col("file").isNull()).alias("live")
    )
    last = F.lit(runs[-1][1] if runs else None).cast("string")
    run = log.where(F.col("part") == last)
    return run.select("part", "kind", "version", "file", F.lit(True).alias("live")).unionByName(
        ingested
    )


def live_parts(
    spark: SparkSession, base: str, name: str, version: int | None = None
) -> list[LivePart]:
    """The parts that count now, or did as of ``version``; the run first.

    What comes to the driver grows with the parts and with the files of those partly replaced.
    """
    log = entries(spark, base, version).where(F.col("entity") == entity(name).name)
    parts = log.select("part", "kind", "version").distinct().collect()
    runs = sorted((r["version"], r["part"]) for r in parts if r["kind"] == RUN)
    if len(parts) == len(runs):
        return [LivePart(runs[-1][1], RUN)] if runs else []
    found = (
        live_files(spark, base, name, version)
        .groupBy("part", "kind", "version")
        .agg(
            F.count_if("live").alias("living"),
            F.collect_list(F.when(~F.col("live"), F.col("file"))).alias("dead"),
        )
        .where("living > 0")
        .withColumn("dead", F.sort_array("dead"))
        .orderBy(F.col("kind") != RUN, "version", "part")
    )
    return [LivePart(r["part"], r["kind"], tuple(r["dead"])) for r in found.collect()]


def taken_files(spark: SparkSession, base: str, name: str) -> set[str]:
    """The raw files whose rows are in the layer."""
    rows = live_files(spark, base, name).where("live AND file IS NOT NULL").select("file")
    return {r["file"] for r in rows.distinct().collect()}


def expire(spark: SparkSession, base: str, keep: int = 1) -> list[str]:
    """Remove the folders of parts that none of the last ``keep`` versions reads; returns them.

    Reads begun on an older version fail afterwards. Entries of the log stay: they are small, and
    say which files a run has replaced. Parts not published yet are left alone.
    """
    newest = current_version(spark, base)
    gone = []
    for r in entries(spark, base).select("entity").distinct().orderBy("entity").collect():
        name = r["entity"]
        published = entries(spark, base).where(F.col("entity") == name).select("part").distinct()
        used = {
            p.id
            for v in range(max(1, newest - keep + 1), newest + 1)
            for p in live_parts(spark, base, name, v)
        }
        gone += [part_path(base, name, p["part"]) for p in published.collect() if p["part"] not in used]
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    removed = []
    for folder in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(configuration).delete(path, True):
            removed.append(folder)
    return removed
