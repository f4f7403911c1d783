"""Places of the rows of a sorted result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boletim.storage import shared_folder

_ROW = "_row"


def with_position(df: DataFrame, name: str = "posicao", folder: str | None = None) -> DataFrame:
    """Add the place of every row of a sorted frame, from 1.

    The frame is sorted and written once, to ``folder`` in the shared space, each row with its
    partition and its number there. What is summed up in one task has a row per partition.
    """
    spark = df.sparkSession
    folder = folder or shared_folder(spark, "sorted")
    df.withColumn(_ROW, F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder).withColumns(
        {"_part": F.shiftright(_ROW, 33), "_number": F.col(_ROW).bitwiseAND((1 << 33) - 1)}
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    bases = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    place = (F.col("_base") + F.col("_number") + 1).alias(name)
    return rows.join(bases, "_part").select(place, *df.columns)
