"""Exact decimal statistics.

Grades are ``decimal(4,1)``. Sums are taken over whole tenths as ``bigint``: additive, so every
aggregate below is combined on the map side, and exact at any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns of a moments record.
MOMENTS = ("n", "soma", "quadrados", "menor", "maior")


def tenths(value: str) -> Column:
    return (F.col(value).cast("decimal(4,1)") * 10).cast("bigint")


def moments(value: str = "nota", weight: str | None = None) -> list[Column]:
    """Count, sum, sum of squares, minimum and maximum of a grade column.

    With ``weight`` each row stands for that many equal grades.
    """
    t = tenths(value)
    if weight is None:
        sums = [F.count(value), F.sum(t), F.sum(t * t)]
    else:
        w = F.when(F.col(value).isNotNull(), F.col(weight))
        sums = [F.coalesce(F.sum(w), F.lit(0)), F.sum(w * t), F.sum(w * t * t)]
    return [c.alias(name) for c, name in zip([*sums, F.min(value), F.max(value)], MOMENTS)]


def combine_moments(weight: str | None = None) -> list[Column]:
    """Roll moments records up to a coarser group; ``weight`` repeats a record."""
    w = F.col(weight) if weight else F.lit(1)
    totals = [F.sum(w * F.col(c)) for c in MOMENTS[:3]]
    totals[0] = F.coalesce(totals[0], F.lit(0))
    ends = [F.min("menor"), F.max("maior")]
    return [c.alias(name) for c, name in zip([*totals, *ends], MOMENTS)]


def mean() -> Column:
    """Exact mean, NULL for an empty group. 19 digits keep distinct means apart for ranking."""
    total = F.col("soma").cast("decimal(18,0)")
    return F.try_divide(total, (F.col("n") * 10).cast("decimal(18,0)")).cast("decimal(22,19)")


def stddev_samp() -> Column:
    """Sample standard deviation from the moments; NULL below two values.

    The numerator is an exact integer, so nothing cancels before the square root.
    """
    n, s, q = (F.col(c).cast("decimal(19,0)") for c in MOMENTS[:3])
    spread = (n * q - s * s).cast("double")
    pairs = F.col("n").cast("double") * (F.col("n") - 1).cast("double")
    return F.when(F.col("n") > 1, F.sqrt(spread / pairs) / 10)


def round2(value: Column) -> Column:
    """Round a decimal to two places, half away from zero."""
    return F.round(value, 2).cast("double")


def round2_double(value: Column) -> Column:
    """As :func:`round2` for a double, whose binary noise is dropped first."""
    return round2(value.cast("decimal(18,10)"))


def percentile_cont(p: float, value: str = "nota", weight: str | None = None) -> Column:
    """Exact interpolated percentile. Its buffer holds one entry per distinct grade."""
    x = F.col(value).cast("double")
    return F.percentile(x, F.lit(p), F.col(weight)) if weight else F.percentile(x, F.lit(p))


def descriptive(names: dict[str, str]) -> list[Column]:
    """Rounded output columns from a moments record, as ``{statistic: output name}``."""
    exprs = {
        "media": lambda: round2(mean()),
        "desvio": lambda: round2_double(stddev_samp()),
        "minimo": lambda: round2(F.col("menor")),
        "maximo": lambda: round2(F.col("maior")),
    }
    return [exprs[stat]().alias(out) for stat, out in names.items()]
