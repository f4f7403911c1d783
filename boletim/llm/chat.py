"""Chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant
and the others as users with their names; the mask marks what the assistant says. A conversation is
rendered in parts of ``TURNS`` turn numbers, and a part in pieces of as many messages, so that no
row grows with a conversation, whatever its turn numbers are; a piece's place in the whole rendering
is the sum of the pieces before it. Messages find their piece by position: ranges of the ordered
messages are counted, and the place within a range is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boletim.llm.common import whole_text
from boletim.storage import shared_folder

#: Turn numbers that a part of a rendering spans, and messages that a piece of a part holds.
TURNS = 64
#: Role that is no participant: its text is shown to all as it is.
SYSTEM = "system"
NOBODY = "unknown"

# What stands around a message.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _head(speaker: Column, view: Column, system: str) -> Column:
    """How a message begins in the view of a participant."""
    return F.when(speaker == view, OPEN + "assistant\n").when(
        speaker == system, OPEN + "system\n"
    ).otherwise(F.concat(F.lit(OPEN + "user name="), speaker, F.lit("\n")))


def _placed(said: DataFrame, folder: str) -> DataFrame:
    """Adds ``place``, the messages of a part before a row of ``said``, without a task per part.

    Ranges are those of one sort, written with the rows, since they differ from run to run.
    """
    spark = said.sparkSession
    order = ["t", "s", "x"]
    said.repartitionByRange("c", "part", *order).withColumn(
        "range", F.spark_partition_id()
    ).write.parquet(folder)
    dealt = spark.read.parquet(folder)
    within = Window.partitionBy("c", "part", "range").orderBy(*order)
    earlier = Window.partitionBy("c", "part").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = dealt.groupBy("c", "part", "range").agg(F.sum("copies").alias("n")).select(
        F.col("c").alias("c_"), F.col("part").alias("part_"), F.col("range").alias("range_"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
    )
    local = dealt.withColumn(
        "local", F.sum("copies").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    )
    same = local["c"].eqNullSafe(base["c_"]) & (local["part"] == base["part_"]) & (
        local["range"] == base["range_"]
    )
    return local.join(base, same).select(
        *said.columns, (F.col("base") + F.col("local")).alias("place")
    )


def perspectives(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    turns: int = TURNS,
    system: str = SYSTEM,
    folder: str | None = None,
) -> DataFrame:
    """One row per conversation, participant and piece of a part.

    Returns ``conversation``, ``perspective`` (whose view), ``part``, ``piece`` (0 unless a part has
    more than ``turns`` messages), ``n_turns``, ``text`` (the piece's rendering), ``mask`` (pairs
    ``begin, end`` of code points in it that the participant says, with the closing mark) and
    ``begin`` (the piece's place in the whole rendering).

    Turns follow their number, null ones first; equal ones follow the speaker and the text. A null
    or empty speaker is ``unknown``, a null text empty. A row that repeats another in these four
    columns is one message, delivered twice; without a turn, it is another message. A conversation
    of the system alone has no rows. Null conversations are one conversation. Other columns are not
    read. The ordered messages go to ``folder`` in the shared space.
    """
    name = F.when(F.coalesce(F.col(speaker), F.lit("")) == "", NOBODY).otherwise(F.col(speaker))
    said = messages.select(
        F.col(conversation).alias("c"),
        F.col(turn).alias("t"),
        name.alias("s"),
        whole_text(text).alias("x"),
    ).groupBy("c", "t", "s", "x").agg(F.count("*").alias("copies"))
    part = F.coalesce(F.floor(F.col("t") / turns), F.lit(-1)).alias("part")
    said = said.withColumn("copies", F.when(F.col("t").isNull(), F.col("copies")).otherwise(1))
    people = said.where(F.col("s") != system).groupBy("c").agg(F.collect_set("s").alias("views"))
    spark = messages.sparkSession
    placed = _placed(said.withColumn("part", part), folder or shared_folder(spark, "messages"))
    end, piece = F.col("place") + F.col("copies"), F.col("piece")
    cut = placed.withColumn("piece", F.explode(F.sequence(
        F.floor(F.col("place") / turns), F.floor((end - 1) / turns)
    ))).withColumn(
        "here", F.least(end, (piece + 1) * turns) - F.greatest(F.col("place"), piece * turns)
    )
    # Messages of a piece come together once, whoever looks at them.
    order = F.struct(F.col("t").isNotNull().alias("known"), "t", "s", "x", F.col("here").cast("int").alias("here"))
    parts = cut.groupBy("c", "part", "piece").agg(
        F.flatten(F.transform(
            F.array_sort(F.collect_list(order)), lambda m: F.array_repeat(m, m["here"])
        )).alias("messages")
    )
    seen = parts.join(people, parts["c"].eqNullSafe(people["c"])).select(
        parts["c"].alias("c"), "part", "piece", "messages", F.explode("views").alias("view")
    )

    def shown(m: Column) -> Column:
        head, tail = _head(m["s"], F.col("view"), system), F.lit(CLOSE)
        return F.struct(
            F.concat(head, m["x"], tail).alias("piece"),
            F.length(head).alias("head"),
            (m["s"] == F.col("view")).alias("own"),
        )

    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("mask")
    )

    def marked(state: Column, p: Column) -> Column:
        end = (state["at"] + F.length(p["piece"])).cast("int")
        span = F.struct((state["at"] + p["head"]).cast("int").alias("begin"), end.alias("end"))
        mask = F.when(p["own"], F.concat(state["mask"], F.array(span))).otherwise(state["mask"])
        return F.struct(end.alias("at"), mask.alias("mask"))

    rendered = seen.withColumn("pieces", F.transform("messages", shown)).select(
        "c", "view", "part", "piece",
        F.size("pieces").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"),
        F.aggregate("pieces", start, marked)["mask"].alias("mask"),
    )
    before = Window.partitionBy("c", "view").orderBy("part", "piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begin = F.coalesce(F.sum(F.length("text").cast("bigint")).over(before), F.lit(0))
    return rendered.select(
        F.col("c").alias(conversation),
        F.col("view").alias("perspective"),
        F.col("part").cast("bigint").alias("part"),
        F.col("piece").cast("bigint").alias("piece"),
        "n_turns", "text", "mask",
        begin.alias("begin"),
    )
