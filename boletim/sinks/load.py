"""Loading the warehouse: parents first, append only, with one status per table."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Literal, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boletim.operators.bloom import bloom_filter, might_hold
from boletim.operators.quality import check_fk, check_rows, check_unique, violation_counts
from boletim.schemas import AUDIT_COLUMNS, ENTITIES

log = logging.getLogger(__name__)

# Driver class and TLS settings of a PostgreSQL connection.
POSTGRES_PROPERTIES = {
    "driver": "org.postgresql.Driver",
    "ssl": "true",
    "sslmode": "require",
}

JDBC_PARTITIONS = 16
# Which runs have loaded which tables.
RUNS_TABLE = "boletim_loads"


class ConstraintError(ValueError):
    """A batch breaks a table's constraints."""


@dataclass(frozen=True)
class LoadStatus:
    table: str
    status: Literal["loaded", "failed", "skipped"]
    message: str = ""


class Target(Protocol):
    """Somewhere to append warehouse rows."""

    def existing(self, name: str) -> DataFrame | None:
        """Rows already stored, or None if the target checks keys and references itself."""

    def append(self, df: DataFrame, name: str) -> str | None:
        """Add rows; returns what there is to say about it."""


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: Literal["append", "overwrite"] = "append",
) -> None:
    """Write over JDBC. ``numPartitions`` bounds the connections held at once.

    Rows are dealt to that many tasks first, so that it does not bound the scan behind them.
    """
    options = jdbc_options(url, properties)
    dealt = df.repartition(int(options["numPartitions"]))
    dealt.write.jdbc(url=url, table=table, mode=mode, properties=options)


def jdbc_options(url: str, properties: Mapping[str, str]) -> dict[str, str]:
    defaults = {"numPartitions": str(JDBC_PARTITIONS), "batchsize": "10000"}
    if url.startswith("jdbc:postgresql:"):
        defaults |= POSTGRES_PROPERTIES
    return {**defaults, **properties}


def run_statements(
    spark: SparkSession, url: str, properties: Mapping[str, str], statements: list[str]
) -> int:
    """Run statements over JDBC from the driver, in one transaction; returns the last one's rows."""
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for key, value in jdbc_options(url, properties).items():
        login.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        connection.setAutoCommit(False)
        statement, rows = connection.createStatement(), 0
        for text in statements:
            rows = statement.executeUpdate(text)
        connection.commit()
        return rows
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def publishing(url: str, stage: str, table: str, columns: list[str], run_id: str) -> list[str]:
    """SQL that moves a stage into its table, once per run however often it is run.

    The run is noted with the rows, so both are there or neither. Rows are made distinct because a
    task that was repeated may have written its part of the stage twice; keys being unique in a
    batch, nothing else is. PostgreSQL does it in one statement, others in one transaction.
    """
    run, name, names = _text(run_id), _text(table), ", ".join(columns)
    move = f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {stage}"
    if url.startswith("jdbc:postgresql:"):
        return [
            f"WITH claimed AS (INSERT INTO {RUNS_TABLE} (run_id, table_name) VALUES ({run}, {name}) "
            f"ON CONFLICT DO NOTHING RETURNING run_id) {move} WHERE EXISTS (SELECT 1 FROM claimed)"
        ]
    known = f"SELECT 1 FROM {RUNS_TABLE} WHERE run_id = {run} AND table_name = {name}"
    note = f"INSERT INTO {RUNS_TABLE} (run_id, table_name) SELECT DISTINCT {run}, {name} FROM {stage}"
    # The rows first: of two at once, the note's key then stops the second with its rows.
    return [f"{move} WHERE NOT EXISTS ({known})", f"{note} WHERE NOT EXISTS ({known})"]


@dataclass(frozen=True)
class JdbcTarget:
    """A relational database, which enforces its own constraints.

    Tasks write to a stage, a table of its own that may be written again; one statement then moves
    its rows. So a load that failed half-way has left nothing in the table, and one that is tried
    again under its ``run_id`` adds nothing that is there already. Without an id every append is a
    run of its own. ``execute`` runs statements in the database.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    run_id: str | None = None
    execute: Callable[[SparkSession, str, Mapping[str, str], list[str]], int] = run_statements

    def existing(self, name: str) -> DataFrame | None:
        return None

    def append(self, df: DataFrame, name: str) -> str | None:
        run_id = self.run_id or uuid.uuid4().hex
        stage = f"{name}_stage_{re.sub('[^0-9a-z]', '', run_id.lower())}"

        def execute(*statements: str) -> int:
            return self.execute(df.sparkSession, self.url, self.properties, list(statements))

        # Through this the driver class is known to the process before it is asked for below.
        load_jdbc(df, self.url, stage, self.properties, "overwrite")
        execute(
            f"CREATE TABLE IF NOT EXISTS {RUNS_TABLE} (run_id VARCHAR(100) NOT NULL, "
            "table_name VARCHAR(50) NOT NULL, PRIMARY KEY (run_id, table_name))"
        )
        moved = execute(*publishing(self.url, stage, name, df.columns, run_id))
        execute(f"DROP TABLE {stage}")
        return None if moved else f"nothing to add for run {run_id}"


@dataclass(frozen=True)
class CatalogTarget:
    """Tables made by :func:`boletim.sinks.tables.create_warehouse`."""

    spark: SparkSession
    db: str

    def existing(self, name: str) -> DataFrame | None:
        return self.spark.table(f"{self.db}.{name}")

    def append(self, df: DataFrame, name: str) -> None:
        """Insert by name, so columns that are left out take the table's defaults."""
        table = f"{self.db}.{name}"
        self.spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{batch}}", batch=df)


def batch_violations(tables: Mapping[str, DataFrame], name: str, target: Target) -> DataFrame:
    """Constraint violations of one table's batch, seen together with the rows already stored.

    Stored rows are cut to the batch's own keys before anything is grouped: first, where they are
    scanned, by a Bloom filter of these, then by a join. A target that checks keys itself is left the
    references, whose rows it may hold; keys within the batch are checked.
    """
    e = ENTITIES[name]
    batch = tables[name]
    stored = target.existing(name)
    keys = batch.select(*e.key)
    if stored is not None:
        again = _among(stored.select(*e.key), keys.distinct())
        keys = keys.unionByName(again)
    checks = [check_rows(batch, e), check_unique(keys, e.name, e.key)]
    known = target.existing(e.reference.parent) if e.reference else None
    if known is not None:
        r = e.reference
        wanted = batch.select(F.col(r.column).alias(r.parent_column)).distinct()
        held = _among(known.select(r.parent_column), wanted)
        parents = tables[r.parent].select(r.parent_column).unionByName(held)
        checks.append(check_fk(batch, e.name, r.column, parents, r.parent_column))
    return reduce(DataFrame.unionByName, checks)


def _among(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """The stored keys that are among ``keys``, which have the same columns and no repeats."""
    columns = stored.columns
    likely = stored.where(might_hold(bloom_filter(keys, columns), columns))
    return likely.join(keys, columns, "left_semi")


def _require_valid(tables: Mapping[str, DataFrame], name: str, target: Target) -> None:
    counts = violation_counts(batch_violations(tables, name, target)).orderBy("rule").collect()
    if counts:
        broken = ", ".join(f"{r['rule']}={r['violations']}" for r in counts)
        raise ConstraintError(f"{name}: {broken}")


def load_warehouse(
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
    target: Target,
    on_error: Literal["raise", "log"] = "raise",
    check: bool = True,
) -> list[LoadStatus]:
    """Append the three tables in reference order.

    A table, or the function that makes it, is written only if its whole batch passes the checks.
    With ``on_error="log"`` a failure is logged, later tables are skipped and the
    caller goes on.
    """
    done: list[LoadStatus] = []
    made: dict[str, DataFrame] = {}
    for name in ENTITIES:
        if any(s.status == "failed" for s in done):
            done.append(LoadStatus(name, "skipped"))
            continue
        try:
            table = tables[name]
            made[name] = table() if callable(table) else table
            if check:
                _require_valid(made, name, target)
            said = target.append(made[name].drop(*AUDIT_COLUMNS), name)
            done.append(LoadStatus(name, "loaded", said or ""))
        except Exception as error:
            if on_error == "raise":
                raise
            log.error("load of %s failed: %s", name, error)
            done.append(LoadStatus(name, "failed", str(error)))
    return done
