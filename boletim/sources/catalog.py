"""Registering raw and processed folders as catalog tables.

A folder of like files is one external table. Where one dataset is more than that, it is a view over
external tables beside it: raw CSV files whose headers differ have a table per header, and the
processed layer has one over all its parts, of which the view picks those that count.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Literal
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from boletim.schemas import ENTITIES, entity, processed_schema, raw_schema
from boletim.sources.layer import FILE_COLUMN, PART_COLUMN, live_parts, processed_path
from boletim.sources.processed import BLANK, parts_schema
from boletim.sources.raw import header_groups, list_files, raw_path

log = logging.getLogger(__name__)

READ_OPTIONS = {
    "csv": {"header": "true", "enforceSchema": "false"},
    "parquet": {"mergeSchema": "true"},
}
# Names beside a table's own: a definition under trial, and the one it is to replace.
TRIAL, ASIDE = "__trial", "__aside"
#: Names of files that a table's definition lists at most, in characters.
LISTED = 3_500


@dataclass(frozen=True)
class Registration:
    """What registering found: columns added to, gone from or retyped against the table."""

    table: str
    created: bool
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    retyped: list[str] = field(default_factory=list)


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _found_schema(
    spark: SparkSession, path: str, fmt: str, options: dict[str, str] | None = None
) -> T.StructType:
    """Schema over all files of the folder; compatible schemas are combined."""
    reader = spark.read.format(fmt).options(**READ_OPTIONS.get(fmt, {})).options(**options or {})
    if fmt == "csv":
        reader = reader.option("inferSchema", True)
    return reader.load(path).schema


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    columns = spark.catalog.listColumns(table)
    return [c.name for c in columns if c.isPartition]


def _kind(spark: SparkSession, table: str) -> str | None:
    """EXTERNAL, MANAGED or VIEW; None if there is no such table."""
    return spark.catalog.getTable(table).tableType if spark.catalog.tableExists(table) else None


def _own_external(spark: SparkSession, table: str, path: str) -> None:
    """Raise unless the table is external and lies over ``path``."""
    wanted = {"Type", "Location"}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name").isin(*wanted))
    about = {r["col_name"]: r["data_type"] for r in rows.collect()}
    if about.get("Type") != "EXTERNAL":
        raise ValueError(f"{table} is {about.get('Type')}, not an external table")
    here, there = (re.sub("^file:/*", "/", p.rstrip("/")) for p in (path, about["Location"]))
    if here != there:
        raise ValueError(f"{table} lies over {about['Location']}, not {path}")


def _recover(spark: SparkSession, table: str) -> None:
    """Put right what a swap that was cut short has left: the name answers, or has its old table."""
    for left in (table + TRIAL, table + ASIDE):
        if _kind(spark, left) == "EXTERNAL":
            if left == table + ASIDE and not spark.catalog.tableExists(table):
                spark.sql(f"ALTER TABLE {left} RENAME TO {table}")
            else:
                spark.sql(f"DROP TABLE {left}")


def _swap(spark: SparkSession, table: str, put: Callable[[], None], undo: str) -> None:
    """Take an external table's name for what ``put`` makes; the table is kept until that answers.

    After a failure at any step the name has the old table again. ``undo`` removes what ``put`` made.
    """
    aside = table + ASIDE
    spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    try:
        put()
        spark.table(table).limit(1).collect()
    except Exception:
        spark.sql(undo)
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        raise
    try:
        spark.sql(f"DROP TABLE {aside}")
    except Exception as error:  # the new definition stands; the next registration drops the rest
        log.warning("%s: %s could not be dropped: %s", table, aside, error)


def _redefine(
    spark, table: str, path: str, fmt: str, schema, partition_by, options=None, on_delete="log"
) -> None:
    """Give an external table another definition, which is made and read under another name first."""
    trial = table + TRIAL
    try:
        _create(spark, trial, path, fmt, schema, partition_by, options)
        _sync_partitions(spark, trial, on_delete)
        spark.table(trial).limit(1).collect()
        _swap(
            spark,
            table,
            lambda: spark.sql(f"ALTER TABLE {trial} RENAME TO {table}"),
            f"DROP TABLE IF EXISTS {table}",
        )
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {trial}")
        raise


def _create(
    spark, table: str, path: str, fmt: str, schema, partition_by, options: dict | None = None
) -> None:
    given = {"path": path, **READ_OPTIONS.get(fmt, {}), **(options or {})}
    texts = ", ".join(f"{_name(k)} {_text(v)}" for k, v in given.items())
    columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema)
    partitions = ", ".join(map(_name, partition_by))
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING {fmt} OPTIONS ({texts}) "
        + (f"PARTITIONED BY ({partitions})" if partitions else "")
    )


def _sync_partitions(spark, table: str, on_delete: str) -> None:
    if not _partition_columns(spark, table):
        return
    if on_delete == "delete":
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    else:
        spark.catalog.recoverPartitions(table)


def _compared(
    table: str, current: dict, offered: dict, partitions: Iterable[str] = ()
) -> Registration:
    """What has changed, which is also logged."""
    found = Registration(
        table,
        False,
        [c for c in offered if c not in current],
        [c for c in current if c not in offered],
        [
            c
            for c in offered
            if c in current and c not in partitions and offered[c] != current[c]
        ],
    )
    changes = (("new", found.added), ("gone", found.removed), ("retyped", found.retyped))
    for change, columns in changes:
        if columns:
            log.info("%s: %s columns %s", table, change, ", ".join(columns))
    return found


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema}


def register_dataset(
    spark: SparkSession,
    db: str,
    name: str,
    path: str,
    fmt: str,
    schema: T.StructType | None = None,
    partition_by: Iterable[str] = (),
    on_change: Literal["update", "log"] = "update",
    on_delete: Literal["log", "delete"] = "log",
) -> Registration:
    """Create or refresh a table over ``path``; no data is moved or removed.

    A table of that name that is managed, or lies elsewhere, is refused.
    Without ``schema`` it is read from the files. New columns are added to an existing table, and
    a changed type redefines it, unless ``on_change`` is "log". Columns that are gone stay and are
    logged. New partitions are always added; ``on_delete="delete"`` also drops missing ones.

    CSV files may have different headers: see :func:`register_csv`.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    table = f"{db}.{name}"
    _recover(spark, table)
    if fmt == "csv" and not list(partition_by):
        groups = header_groups(spark, list_files(spark, path))
        if len(groups) > 1 or _kind(spark, table) == "VIEW":
            return register_csv(spark, db, name, path, groups, schema, on_change)
        if schema is not None and groups:
            schema = _in_order(schema, next(iter(groups)))
    found = schema or _found_schema(spark, path, fmt)
    if not spark.catalog.tableExists(table):
        _create(spark, table, path, fmt, found, list(partition_by))
        _sync_partitions(spark, table, on_delete)
        return Registration(table, created=True)

    _own_external(spark, table, path)
    current, offered = _types(spark.table(table).schema), _types(found)
    partitions = _partition_columns(spark, table)
    done = _compared(table, current, offered, partitions)
    if on_change == "update" and done.retyped:
        # A partition column keeps the type it was registered with.
        merged = {c: current[c] if c in partitions else offered.get(c, current[c]) for c in current}
        merged |= {c: offered[c] for c in done.added}
        fields = [T.StructField(c, t) for c, t in merged.items()]
        _redefine(spark, table, path, fmt, T.StructType(fields), partitions, on_delete=on_delete)
    elif on_change == "update" and done.added:
        columns = ", ".join(f"{_name(c)} {offered[c].simpleString()}" for c in done.added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    _sync_partitions(spark, table, on_delete)
    spark.catalog.refreshTable(table)
    return done


def _in_order(schema: T.StructType, header: Iterable[str]) -> T.StructType:
    """The header's columns, with the declared types where they have one."""
    declared = {f.name.lower(): f for f in schema}
    return T.StructType([declared.get(c.lower(), T.StructField(c, T.StringType())) for c in header])


def _wider(types: list[T.DataType]) -> T.DataType:
    """One type for what a column has in several groups of files."""
    if all(t == types[0] for t in types):
        return types[0]
    if all(isinstance(t, T.NumericType) for t in types):
        whole = all(isinstance(t, T.IntegralType) for t in types)
        return T.LongType() if whole else T.DoubleType()
    return T.StringType()


def _only(files: list[str]) -> str:
    """A pattern for the names of these files and no others."""
    names = [re.sub(r"([{}\[\]*?\\,])", r"\\\1", f.rsplit("/", 1)[-1]) for f in files]
    return "{" + ",".join(names) + "}"


def _batches(files: list[str]) -> list[list[str]]:
    """Files in groups whose names fit a table's definition."""
    groups: list[list[str]] = []
    for f in sorted(files):
        if groups and len(_only([*groups[-1], f])) <= LISTED:
            groups[-1].append(f)
        else:
            groups.append([f])
    return groups


def _view(spark, view: str, selects: list[str]) -> None:
    """Put a view in place of what has its name: another view, or an external table."""
    text = f"VIEW {view} AS " + " UNION ALL ".join(selects)
    if _kind(spark, view) == "EXTERNAL":
        _swap(spark, view, lambda: spark.sql(f"CREATE {text}"), f"DROP VIEW IF EXISTS {view}")
    else:
        spark.sql(f"CREATE OR REPLACE {text}")


def register_csv(
    spark: SparkSession,
    db: str,
    name: str,
    path: str,
    groups: dict[tuple[str, ...], list[str]],
    schema: T.StructType | None = None,
    on_change: Literal["update", "log"] = "update",
) -> Registration:
    """Register CSV files of several headers (``groups``: header to files) as one view.

    Each header has an external table that takes its files by name, and the view unites them by
    column: in any order, with a typed NULL where a file lacks one. Types are those of ``schema`` or
    else inferred, each file being read once for that; a column that is text in one file and a number
    in another is text. Files that arrive later are seen when registered again. Two files of one name,
    in folders of their own, must have one header. Columns that no file has any more stay, as NULL.
    """
    view = f"{db}.{name}"
    existing = _kind(spark, view)
    if existing == "EXTERNAL":
        _own_external(spark, view, path)
    elif existing not in (None, "VIEW"):
        raise ValueError(f"{view} is {existing}, not an external table")
    names = [f.rsplit("/", 1)[-1] for files in groups.values() for f in files]
    if len(set(names)) < len(names) and len(groups) > 1:
        raise ValueError(f"{path}: files of one name have different headers")
    tables: dict[str, T.StructType] = {}
    for header, files in sorted(groups.items()):
        for some in _batches(files):
            only = {"pathGlobFilter": _only(some), "recursiveFileLookup": "true"}
            found = _in_order(schema, header) if schema else _found_schema(spark, path, "csv", only)
            key = f"{','.join(header)}/{some[0]}"
            table = f"{view}__{crc32(key.encode()):08x}"
            _recover(spark, table)
            if _kind(spark, table) is None:
                _create(spark, table, path, "csv", found, [], only)
            else:
                _own_external(spark, table, path)
                _redefine(spark, table, path, "csv", found, [], only)
            tables[table] = found
    current = _types(spark.table(view).schema) if existing else {}
    # A column keeps the spelling it was first seen with.
    spelt = {c.lower(): c for c in current}
    offered: dict[str, list[T.DataType]] = {}
    for found in tables.values():
        for f in found:
            offered.setdefault(spelt.setdefault(f.name.lower(), f.name), []).append(f.dataType)
    wide = {c: _wider(types) for c, types in offered.items()}
    done = _compared(view, current, wide)
    columns = {**current, **wide} if on_change == "update" else dict(current or wide)
    selects = []
    for table, found in tables.items():
        held = {f.name.lower() for f in found}
        cells = [
            f"CAST({_name(c) if c.lower() in held else 'NULL'} AS {t.simpleString()}) AS {_name(c)}"
            for c, t in columns.items()
        ]
        selects.append(f"SELECT {', '.join(cells)} FROM {table}")
    _view(spark, view, selects)
    for t in spark.catalog.listTables(db):
        old = f"{db}.{t.name}"
        if re.fullmatch(re.escape(name) + "__[0-9a-f]{8}", t.name) and old not in tables:
            if t.tableType == "EXTERNAL":
                spark.sql(f"DROP TABLE {old}")
    return done if existing else Registration(view, created=True)


def register_processed(
    spark: SparkSession,
    db: str,
    base: str,
    name: str,
    on_change: Literal["update", "log"] = "update",
    on_delete: Literal["log", "delete"] = "log",
) -> Registration:
    """Register a dataset of the processed layer, as it is now, under its name.

    It is a view of the rows that count, over an external table ``<name>_parts`` of all parts; what is
    published later shows when registered again. The view is replaced in one step, and the same rows
    are behind it as :func:`~boletim.sources.processed.read_processed` gives. A folder that no entry of
    the layer's log speaks of is registered as a plain external table.
    """
    e = entity(name)
    parts = live_parts(spark, base, name)
    partition_by = [e.partition_by] if e.partition_by else []
    if not parts:
        path = processed_path(base, name)
        return register_dataset(
            spark, db, e.name, path, "parquet", processed_schema(name), partition_by,
            on_change, on_delete,
        )
    view = f"{db}.{e.name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    _recover(spark, view)
    existing = _kind(spark, view)
    if existing == "EXTERNAL":
        _own_external(spark, view, processed_path(base, name))
    elif existing not in (None, "VIEW"):
        raise ValueError(f"{view} is {existing}, not an external table")
    done = register_dataset(
        spark, db, f"{e.name}_parts", processed_path(base, name), "parquet", parts_schema(name),
        [PART_COLUMN, *partition_by], on_change, on_delete,
    )
    held = set(spark.table(done.table).columns)
    blank = f"CASE WHEN {{0}} = {_text(BLANK)} THEN '' ELSE {{0}} END AS {{0}}"
    cells = ", ".join(
        blank.format(_name(c)) if c in partition_by else _name(c)
        for c in processed_schema(name).names
        if c in held
    )
    whole = ", ".join(_text(p.id) for p in parts if not p.dead)
    rules = [f"{PART_COLUMN} IN ({whole})"] if whole else []
    for p in parts:
        if p.dead:
            dead = ", ".join(map(_text, p.dead))
            rules.append(f"{PART_COLUMN} = {_text(p.id)} AND {FILE_COLUMN} NOT IN ({dead})")
    _view(spark, view, [f"SELECT {cells} FROM {done.table} WHERE {r}" for r in rules])
    return Registration(view, existing is None, done.added, done.removed, done.retyped)


def register_layers(
    spark: SparkSession,
    raw: str,
    processed: str,
    raw_db: str = "raw_data",
    processed_db: str = "processed_data",
) -> list[Registration]:
    """Register the raw and the processed data of every entity, with the declared types."""
    done = []
    for name, e in ENTITIES.items():
        path = raw_path(raw, name)
        try:
            list_files(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.info("no raw data of %s", name)
        else:
            done.append(register_dataset(spark, raw_db, e.raw_name, path, "csv", raw_schema(name)))
        done.append(register_processed(spark, processed_db, processed, name))
    return done


def list_tables(spark: SparkSession, db: str, names: Iterable[str] = tuple(ENTITIES)) -> DataFrame:
    """``table_name, table_type`` of the named tables that exist, by name; no session views."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(db) if not t.isTemporary]
    tables = spark.createDataFrame(rows, "table_name string, table_type string")
    return tables.where(F.col("table_name").isin(list(names))).orderBy("table_name")
