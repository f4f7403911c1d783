"""Statistics from weighted counts, at the sizes they are meant for."""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from boletim.functions.exact import (
    combine_moments,
    descriptive,
    mean,
    moments,
    percentile_cont,
    round2_double,
)

SCHEMA = "g string, nota decimal(4,1), peso bigint"
NAMES = {"media": "media", "desvio": "desvio", "minimo": "minimo", "maximo": "maximo"}


def _frame(spark, groups):
    rows = [(g, Decimal(str(v)), w) for g, pairs in groups.items() for v, w in pairs]
    return spark.createDataFrame(rows, SCHEMA)


GROUPS = {
    "unused": [(6.6, 65 * 10**11), (6.7, 35 * 10**11), (6.9, 0), (7.3, 0)],
    # Ten trillion grades: a mean of exactly 6.665, and one a single grade below that.
    "even": [(6.6, 35 * 10**11), (6.7, 65 * 10**11)],
    "below": [(6.6, 35 * 10**11 + 1), (6.7, 65 * 10**11 - 1)],
    "wide": [(0.0, 5 * 10**12), (10.0, 5 * 10**12)],
    "one": [(7.5, 1)],
    "two": [(7.5, 1), (8.0, 1)],
    "same": [(9.9, 10**13)],
}


def _exact(pairs):
    pairs = [(Fraction(str(v)), w) for v, w in pairs if w]
    n = sum(w for _, w in pairs)
    m = sum(v * w for v, w in pairs) / n
    var = sum((v - m) ** 2 * w for v, w in pairs) / (n - 1) if n > 1 else None
    return n, m, None if var is None else math.sqrt(var)


@pytest.mark.parametrize("two_step", [False, True])
def test_weighted_statistics_of_many_rows(spark, two_step):
    df = _frame(spark, GROUPS)
    if two_step:
        parts = df.groupBy("g", "nota").agg(*moments("nota", "peso"))
        stats = parts.groupBy("g").agg(*combine_moments())
    else:
        stats = df.groupBy("g").agg(*moments("nota", "peso"))
    stats = stats.select("g", "n", mean().alias("m"), *descriptive(NAMES))
    out = {r["g"]: r for r in stats.collect()}
    for g, pairs in GROUPS.items():
        n, m, sd = _exact(pairs)
        assert out[g]["n"] == n
        assert abs(Fraction(out[g]["m"]) - m) < Fraction(1, 10**18)
        assert out[g]["media"] == math.floor(m * 100 + Fraction(1, 2)) / 100
        assert out[g]["desvio"] == (None if sd is None else pytest.approx(sd, abs=0.005))
    assert (out["even"]["media"], out["below"]["media"]) == (6.67, 6.66)
    assert out["same"]["desvio"] == 0.0


def test_percentiles_count_weights(spark):
    df = _frame(spark, {"g": [(1.0, 10**12), (2.0, 1), (3.0, 10**12)], "h": [(5.0, 1), (6.0, 3)]})
    found = df.groupBy("g").agg(
        *[percentile_cont(p, "nota", "peso").alias(f"p{p}") for p in (0.25, 0.5, 0.75)]
    )
    values = {r["g"]: tuple(r)[1:] for r in found.collect()}
    assert values == {"g": (1.0, 2.0, 3.0), "h": (5.75, 6.0, 6.0)}


def test_rounding_is_away_from_zero(spark):
    values = [0.125, -0.125, 2.675, 1.005, 5.0049999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round2_double(F.col("v"))).collect()]
    assert got == [0.13, -0.13, 2.68, 1.01, 5.0]


def test_no_rows(spark):
    df = _frame(spark, {"x": [(1.0, 1)]}).where("false")
    stats = df.agg(*moments("nota", "peso")).select("n", *descriptive(NAMES))
    assert tuple(stats.first()) == (0, None, None, None, None)
