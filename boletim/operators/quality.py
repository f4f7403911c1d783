"""Table constraints as Spark jobs.

Each check returns the offending rows as ``table, rule, key, detail`` and is empty when the rule
holds. Row rules of one table share a single scan; uniqueness and reference checks aggregate by
key before they shuffle, so one frequent key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boletim.schemas import ENTITIES, GRADE_RANGE, INGESTION_COLUMN, Entity
from boletim.warehouse import Warehouse


@dataclass(frozen=True)
class RowRule:
    name: str
    broken: Column
    detail: Column


def _key(columns: Iterable[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]
    return F.concat_ws("|", *parts)


def _row_violations(df: DataFrame, table: str, key: Iterable[str], rules: list[RowRule]):
    # Most rows pass, and this filter lets them go before anything is built for them.
    suspect = df.where(reduce(lambda a, b: a | b, [r.broken for r in rules]))
    found = F.array_compact(
        F.array(
            *[
                F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), r.detail.alias("detail")))
                for r in rules
            ]
        )
    )
    hits = suspect.select(_key(key).alias("key"), F.explode(found).alias("hit"))
    return hits.select(F.lit(table).alias("table"), "hit.rule", "key", "hit.detail")


def _not_null_rules(columns: Iterable[str]) -> list[RowRule]:
    return [RowRule("not_null", F.col(c).isNull(), F.lit(c)) for c in columns]


def _value(column: str, value: Column) -> Column:
    return F.concat(F.lit(f"{column}="), value.cast("string"))


def _length_rules(lengths: dict[str, int]) -> list[RowRule]:
    return [
        RowRule("length", F.char_length(c) > n, _value(c, F.char_length(c)))
        for c, n in lengths.items()
    ]


def _range_rule(column: str, low: float, high: float) -> RowRule:
    c = F.col(column)
    return RowRule("range", ~c.between(low, high), _value(column, c))


def _decimal_rule(column: str, precision: int, scale: int) -> RowRule:
    c = F.col(column)
    lost = c.isNotNull() & c.try_cast(f"decimal({precision},{scale})").isNull()
    return RowRule("decimal", lost, _value(column, c))


def check_not_null(df: DataFrame, table: str, key: Iterable[str], columns: Iterable[str]):
    return _row_violations(df, table, key, _not_null_rules(columns))


def check_length(df: DataFrame, table: str, key: Iterable[str], lengths: dict[str, int]):
    return _row_violations(df, table, key, _length_rules(lengths))


def check_range(df: DataFrame, table: str, key: Iterable[str], column: str, low, high):
    """NULL passes, as in a SQL CHECK."""
    return _row_violations(df, table, key, [_range_rule(column, low, high)])


def check_decimal(df: DataFrame, table: str, key: Iterable[str], column: str, precision, scale):
    return _row_violations(df, table, key, [_decimal_rule(column, precision, scale)])


def _counted(df: DataFrame, columns: Iterable[str], rows: Column | None = None) -> DataFrame:
    total = F.count(F.lit(1)) if rows is None else F.sum(rows)
    return df.groupBy(*columns).agg(total.alias("rows"))


def _counted_value(column: str) -> Column:
    """A value that has rows, as all have. Seen with its count, a condition on it stays above the
    grouping, which can then be the same exchange for every check."""
    return F.when(F.col("rows") > 0, F.col(column))


def _repeated(groups: DataFrame, table: str, key: list[str]) -> DataFrame:
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return groups.where(missing | (F.col("rows") > 1)).select(
        F.lit(table).alias("table"),
        F.lit("unique").alias("rule"),
        _key(key).alias("key"),
        F.col("rows").cast("string").alias("detail"),
    )


def _orphans(values: DataFrame, table: str, column: str, known: DataFrame) -> DataFrame:
    """``values`` are counted by ``column``, ``known`` holds a ``value`` each once."""
    held = values.where(_counted_value(column).isNotNull())
    return held.join(known, held[column] == known["value"], "left_anti").select(
        F.lit(table).alias("table"),
        F.lit("foreign_key").alias("rule"),
        F.col(column).alias("key"),
        F.col("rows").cast("string").alias("detail"),
    )


def check_unique(df: DataFrame, table: str, key: Iterable[str]) -> DataFrame:
    """Repeated keys, and keys with a NULL part; ``detail`` is the number of rows."""
    key = list(key)
    return _repeated(_counted(df, key), table, key)


def check_fk(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str):
    """Values of ``column`` without a parent row; ``detail`` is the number of rows.

    Both sides are reduced to one row per key first, and that exchange also serves the join.
    """
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    values = _counted(child.where(F.col(column).isNotNull()), [column])
    return _orphans(values, table, column, known)


def check_rows(df: DataFrame, e: Entity) -> DataFrame:
    """Every row rule of a table in one scan. A table without ingestion time is not held to it."""
    stamp = [INGESTION_COLUMN] if INGESTION_COLUMN in df.columns else []
    rules = _not_null_rules([*e.column_names, *stamp]) + _length_rules(e.lengths)
    if e.name == "nota":
        rules += [_range_rule("nota", *GRADE_RANGE), _decimal_rule("nota", 4, 1)]
    return _row_violations(df, e.name, e.key, rules)


def _key_groups(df: DataFrame, e: Entity) -> DataFrame:
    """Rows per key and reference, from which both are checked: one scan and one exchange."""
    reference = [e.reference.column] if e.reference else []
    return _counted(df, dict.fromkeys([*e.key, *reference]))


def check_table(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """All constraints of one table; ``tables`` must hold its parent too.

    Keys and references are counted from the same groups, and a parent's known keys come from its
    own, so a table is scanned twice: for its rows and for its groups.
    """
    e = ENTITIES[name]
    df = tables[name]
    groups = _key_groups(df, e)
    per_key = _counted(groups, e.key, F.col("rows"))
    found = check_rows(df, e).unionByName(_repeated(per_key, e.name, list(e.key)))
    if e.reference:
        r = e.reference
        values = _counted(groups, [r.column], F.col("rows"))
        parents = _key_groups(tables[r.parent], ENTITIES[r.parent])
        held = _counted(parents, [r.parent_column], F.col("rows"))
        known = held.select(_counted_value(r.parent_column).alias("value"))
        found = found.unionByName(_orphans(values, e.name, r.column, known))
    return found


def check_warehouse(w: Warehouse) -> DataFrame:
    checks = [check_table(w.tables(), name) for name in ENTITIES]
    return reduce(DataFrame.unionByName, checks)


def violation_counts(found: DataFrame) -> DataFrame:
    """One row per table and rule: small enough for a log line."""
    return found.groupBy("table", "rule").agg(F.count(F.lit(1)).alias("violations"))
