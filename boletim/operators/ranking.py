"""Competition rank within a group, without sorting a whole group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slices per unit of value: at most 10,000 times the range of grades per group.
SLICES_PER_UNIT = 10_000
_TOP = -(2**62)


def _slice(value: str) -> Column:
    """Where a value falls, the highest first; NULL ranks above all."""
    return F.coalesce(-F.floor(F.col(value) * SLICES_PER_UNIT).cast("bigint"), F.lit(_TOP))


def with_rank(
    df: DataFrame, keys: list[str], value: str, rank: str, group_mean: str | None = None
) -> DataFrame:
    """Add ``RANK() OVER (PARTITION BY keys ORDER BY value DESC)``, NULL first.

    ``group_mean`` names a column for the mean of ``value`` in the group. ``value`` is a mean of
    grades, ``decimal(22,19)``; ``keys`` may be empty.

    A group may hold most of the rows, and most rows the same value. So a group is reduced to a
    histogram: its rows per value, by a map-side step, kept in narrow slices of value, each one row
    with the few values in it. Running totals over a group's slices, of which there is a bounded
    number, then give the rows above a slice. Each row of ``df`` meets the histogram once, at its own
    slice, and adds the rows of higher values there.
    """
    place = "_slice"
    values = df.groupBy(*keys, _slice(value).alias(place), value).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    slices = _above(_histogram(values, [*keys, place], value), keys, group_mean)
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    same.append(F.col(f"l.{place}") == F.col(f"r.{place}"))
    met = df.withColumn(place, _slice(value)).alias("l").join(
        slices.alias("r"), reduce(lambda a, b: a & b, same)
    )
    higher = F.filter("_values", lambda x: x[value] > F.col(f"l.{value}"))
    within = F.aggregate(higher, F.lit(0).cast("bigint"), lambda n, x: n + x["rows"])
    # Values of the NULL slice compare as NULL, and none of them is higher.
    above = (F.lit(1) + F.col("_above") + within).alias(rank)
    return met.select(*[f"l.{c}" for c in df.columns], above, *([group_mean] if group_mean else []))


def _histogram(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per slice: its values with their rows, how many rows, and the sum and number of values."""
    # 22 + 15 digits and one more: the product keeps all 19 decimals of the value.
    counted = F.when(F.col(value).isNotNull(), F.col("_rows")).cast("decimal(15,0)")
    return values.groupBy(*keys).agg(
        F.collect_list(F.struct(value, F.col("_rows").alias("rows"))).alias("_values"),
        F.sum("_rows").alias("_slice_rows"),
        F.sum(F.col(value) * counted).alias("_total"),
        F.sum(counted).alias("_counted"),
    )


def _above(slices: DataFrame, keys: list[str], group_mean: str | None) -> DataFrame:
    """Per slice: rows of the group in higher slices, and the group's mean."""
    group = Window.partitionBy(*keys)
    higher = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    columns = [
        *keys,
        "_slice",
        "_values",
        F.coalesce(F.sum("_slice_rows").over(higher), F.lit(0)).alias("_above"),
    ]
    if group_mean:
        size = F.sum("_counted").over(group).cast("decimal(15,0)")
        columns.append(F.try_divide(F.sum("_total").over(group), size).alias(group_mean))
    return slices.select(*columns)
