"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target and a repetition rate, and every document
is taken floor(rate) times plus once more with the probability of the rate's fraction. The coin is
a hash of the seed and the document's id and text, so that reruns agree and no state is kept.

Rows of a source are only ever summed with a map-side step, so a source with a third of all rows is
no heavier for one task than another. What is ordered in one place is the table of sources, one row
each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boletim.llm.common import WORD, whole_text

# Weights of the sources in code point order, repeating; their share of all words; most repeats.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0


def words(text: str = "text") -> Column:
    """Words of a text, a null text having none."""
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``source, source_size, target, rate`` of each source in ``sizes`` (``source, size``).

    The weights go to the sources in code point order, null last. Targets are in proportion to them
    until one reaches ``most`` times its source; the excess is shared among the others by weight.
    The level at which this settles is found in one pass, the sources being ordered by the level
    that fills them. A source without words has the target 0 and the rate 1.
    """
    one = Window.partitionBy(F.lit(0))
    by_name = one.orderBy(F.col(source).isNull(), F.col(source))
    by_level = one.orderBy("full_at", F.col(source).isNull(), F.col(source))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.array(*(F.lit(float(w)) for w in weights))
    level = (F.lit(share) * F.sum("source_size").over(one) - F.col("filled")) / F.col("left")
    fits = F.col("level") <= F.col("full_at")
    # The first source that the level does not fill sets the level of all.
    settled = F.min(F.when(fits, F.struct("full_at", "level"))).over(one)["level"]
    rate = F.when(F.col("source_size") == 0, 1.0).otherwise(F.col("target") / F.col("source_size"))
    return (
        sizes.groupBy(source)
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight[(F.row_number().over(by_name) - 1) % len(weights)])
        .withColumn("most", most * F.col("source_size"))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("filled", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(onward))
        .withColumn("level", level)
        .withColumn("settled", settled)
        .withColumn(
            "target",
            F.when(
                F.col("settled").isNotNull(), F.least("most", F.col("settled") * F.col("weight"))
            ).otherwise(F.col("most")),
        )
        .select(source, "source_size", "target", rate.alias("rate"))
    )


def coin(key: Column, body: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) from the hash of a key and a text; a null counts as empty."""
    empty = F.lit("")
    text = F.concat(
        F.lit(f"{seed}:"), F.coalesce(key.cast("string"), empty), F.lit(":"), F.coalesce(body, empty)
    )
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """``doc`` (the whole row), ``size, source_size, target, copies`` of every row of ``docs``.

    Null texts have size 0. Rows equal in key and text fall alike; rows of one key, or without one,
    that differ in text fall apart. An empty table gives no rows. The row's columns stay inside ``doc``, so their names can't clash.
    """
    sized = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col(source).alias("mix_source"),
        words(text).alias("size"),
    )
    targets = source_targets(
        docs.select(F.col(source).alias("mix_source"), words(text).alias("size")),
        "mix_source", weights, share, most,
    ).withColumnRenamed("mix_source", "target_source")
    whole = F.floor("rate")
    extra = (coin(F.col("doc")[key], F.col("doc")[text], seed) < F.col("rate") - whole).cast("bigint")
    same = F.col("mix_source").eqNullSafe(F.col("target_source"))
    return sized.join(targets, same).select(
        "doc", "size", "source_size", "target", (whole + extra).alias("copies")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The rows of the mix, each as often as it is taken."""
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.select("doc", F.explode(times)).select("doc.*")
