"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

One edit changes a word's letter counts by little: a replaced letter leaves the length and puts the
squared distance of the counts at 2, an inserted or deleted one changes the length by 1 and puts it
at 1. For blocks of words ``X`` and ``Y`` (one row of counts per word) all squared distances are
``|x|**2 + |y|**2 - 2 X Y'``, one matrix product in NumPy; the few pairs at the right distance are then
compared letter by letter.

Blocks keep the products few. A block holds words of one length and of equal counts over groups of
letters, dealt by hash into parts of bounded size where these are many. An edit moves at most one
letter out of a group and one into a group, so a block meets only blocks whose group counts differ by
that; every such pair of blocks is a row of a table, which any task can work on. Per pair and word
only the number of near words and the best of them leave the task, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boletim.llm.common import let_workers_import, whole_text
from boletim.storage import shared_folder

# The letters, and the rule by which a run loses one.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
RUN = "[a-zÀ-ÿ]+"
DAMAGED = 199

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A form is at least this many times as frequent as its variant.
TIMES = 5
#: Letters of a block, about: its words times their length, counted as 16 at least.
BLOCK_LETTERS = 16_384
#: Words per group of letters that the number of groups is chosen for; it changes the work only.
FEW_WORDS, GROWTH = 2_000, 6
#: Letters of the pairs that are compared at a time.
AT_ONCE = 1 << 22

_ALPHABET = [*LOWER, *map(chr, range(0xC0, 0x100))]


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word, n`` of the runs of letters of all texts, some damaged by the rule above."""
    low = F.translate(whole_text(text), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"),
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    # A damaged run is one letter shorter: shorter ones than this can't be words.
    runs = runs.where(F.char_length("run") >= least_letters).withColumn("h", h)
    at = (F.col("h") % F.char_length("run")).cast("int")
    run = F.col("run")
    rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    word = F.when(F.col("h") % DAMAGED == 0, rest).otherwise(run)
    words = runs.select(word.alias("word")).where(F.char_length("word") >= least_letters)
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


def groups_for(words: int) -> int:
    """Groups of letters: more of them make more and smaller blocks."""
    return max(2, math.ceil(math.log(max(words, 1) / FEW_WORDS, GROWTH)))


def _group_counts(word: Column, groups: int) -> Column:
    """How many letters of a word are of each group; every ``groups``-th letter is of one."""
    kept = [F.translate(word, "".join(_ALPHABET[g::groups]), "") for g in range(groups)]
    return F.array(*[F.char_length(word) - F.char_length(k) for k in kept])


def _shifts(groups: int) -> list[list[int]]:
    """What one edit can add to the counts of the groups, each unordered pair once."""

    def unit(up: int, down: int | None = None) -> list[int]:
        return [(g == up) - (g == down) for g in range(groups)]

    same = [unit(i, j) for i in range(groups) for j in range(i)]
    return [[0] * groups, *same, *[unit(i) for i in range(groups)]]


class Block:
    """Words of one length, the most frequent first, with their letters and letter counts."""

    def __init__(self, words: list[str], counts: list[int]):
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.n = [int(counts[i]) for i in order]
        letters = np.frombuffer("".join(self.words).encode("utf-32-le"), "<u4")
        self.letters = letters.reshape(len(words), -1)
        place = np.where(letters < 0xC0, letters - 97, letters - (0xC0 - 26))
        row = np.repeat(np.arange(len(words)), self.letters.shape[1])
        size = len(_ALPHABET)
        found = np.bincount(row * size + place, minlength=len(words) * size)
        # Exact in either type: no product exceeds the square of the length.
        kind = np.float32 if self.letters.shape[1] < 4096 else np.float64
        self.counts = found.reshape(-1, size).astype(kind)
        self.squares = (self.counts * self.counts).sum(axis=1)


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether ``long`` without one letter is ``short``: what differs first is left out."""
    same, shifted = short == long[:, :-1], short == long[:, 1:]
    begins = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    ends = np.logical_and.accumulate(shifted[:, ::-1], axis=1).sum(axis=1)
    return begins + ends >= short.shape[1]


def near_pairs(x: Block, y: Block) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` and of ``y`` that are one edit apart; ``y`` is as long or one letter longer."""
    longer = y.letters.shape[1] - x.letters.shape[1]
    distance = x.squares[:, None] + y.squares[None, :] - 2 * (x.counts @ y.counts.T)
    close = distance == 2 - longer
    if x is y:
        close = np.triu(close)
    i, j = np.nonzero(close)
    check, step = (_one_inserted if longer else _one_replaced), max(1, AT_ONCE // y.letters.shape[1])
    kept = [
        check(x.letters[i[at : at + step]], y.letters[j[at : at + step]])
        for at in range(0, len(i), step)
    ]
    kept = np.concatenate(kept) if kept else np.zeros(0, bool)
    return i[kept], j[kept]


def _best(mine: Block, other: Block, i: np.ndarray, j: np.ndarray) -> Iterator[tuple]:
    """Per row of ``mine``: its near rows of ``other``, and the first of these."""
    order = np.lexsort((j, i))
    rows, first, count = np.unique(i[order], return_index=True, return_counts=True)
    for row, best, near in zip(rows, j[order][first], count):
        yield mine.words[row], int(near), other.n[best], other.words[best]


def _blocks(words: DataFrame, groups: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Blocks (``block, words, counts``) and the pairs of them that may hold near words."""
    spark = words.sparkSession
    placed = words.withColumn("cell", _group_counts(F.col("word"), groups))
    length = F.aggregate("cell", F.lit(0), lambda a, b: a + b)
    letters = F.col("words") * F.greatest(length, F.lit(16))
    cells = (
        placed.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("words"))
        .select("cell", F.ceil(letters / BLOCK_LETTERS).cast("int").alias("parts"))
    )
    cells.write.parquet(f"{folder}/cells")
    cells = spark.read.parquet(f"{folder}/cells")

    def name(cell: str, part: Column) -> Column:
        return F.concat(F.concat_ws(",", F.col(cell).cast("array<string>")), F.lit("/"), part)

    dealt = placed.join(cells, "cell")
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("string")
    dealt.groupBy(name("cell", part).alias("block")).agg(
        F.collect_list("word").alias("words"), F.collect_list("n").alias("counts")
    ).write.parquet(f"{folder}/blocks")
    shift = F.explode(F.array(*[F.array(*map(F.lit, s)) for s in _shifts(groups)]))
    shifted = cells.select("cell", "parts", shift.alias("shift")).select(
        F.col("cell").alias("from"),
        F.col("parts").alias("from_parts"),
        F.zip_with("cell", "shift", lambda a, b: a + b).alias("cell"),
    )
    one = F.explode(F.sequence(F.lit(0), F.col("from_parts") - 1)).alias("i")
    met = shifted.join(cells, "cell").select("*", one)
    # Parts of one cell meet once.
    begin = F.when(F.expr("from = cell"), F.col("i")).otherwise(0)
    pairs = met.select("*", F.explode(F.sequence(begin, F.col("parts") - 1)).alias("j")).select(
        name("from", F.col("i").cast("string")).alias("left"),
        name("cell", F.col("j").cast("string")).alias("right"),
    )
    return spark.read.parquet(f"{folder}/blocks"), pairs


def near_words(words: DataFrame, folder: str, groups: int | None = None) -> DataFrame:
    """``word, n_near, best_n, best`` of every word that has near ones; best: most frequent, first.

    ``words`` (``word, n``) holds each word once. Cells, blocks and pairs are written to ``folder``.
    """
    spark = words.sparkSession
    let_workers_import(spark)
    blocks, pairs = _blocks(words, groups or groups_for(words.count()), folder)
    pairs.write.parquet(f"{folder}/pairs")
    pairs = spark.read.parquet(f"{folder}/pairs")
    sides = [
        blocks.select(*[F.col(c).alias(f"{side}{to}") for c, to in (("block", ""), ("words", "_words"), ("counts", "_counts"))])
        for side in ("left", "right")
    ]
    met = pairs.join(sides[0], "left").join(sides[1], "right")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for left, a, m, right, b, n in zip(*[batch[c] for c in columns]):
                x = Block(list(a), list(m))
                y = x if left == right else Block(list(b), list(n))
                i, j = near_pairs(x, y)
                rows += _best(x, y, i, j)
                rows += _best(y, x, j, i)
                if len(rows) > 100_000:
                    yield pd.DataFrame(rows, columns=out)
                    rows = []
            yield pd.DataFrame(rows, columns=out)

    columns = ["left", "left_words", "left_counts", "right", "right_words", "right_counts"]
    out = ["word", "near", "best_n", "best"]
    # A product is much work for few bytes, so the pairs are dealt by number, not by size.
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(pairs.count() / 64))
    found = met.select(*columns).repartition(tasks).mapInPandas(
        compare, "word string, near bigint, best_n bigint, best string"
    )
    first = F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), first).select(
        "word", "n_near", (-F.col("first.rank")).alias("best_n"), F.col("first.best").alias("best")
    )


def _roots(forms: DataFrame, most: int, folder: str, times: int, least: int) -> DataFrame:
    """``word, root`` of every word with a form.

    A form has ``times`` its variant's count, so a chain has a bounded number of steps, and every
    round doubles how many have been taken.
    """
    spark = forms.sparkSession
    steps = 0
    while least * times ** (steps + 1) <= most:
        steps += 1
    links = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for k in range(max(steps, 1).bit_length()):
        links.write.parquet(f"{folder}/roots-{k}")
        links = spark.read.parquet(f"{folder}/roots-{k}")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
    return links


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    folder: str | None = None,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents.

    A word's form is its near word of largest count (ties: the first in code-point order), if that
    count is ``times`` its own at least. A null text has no words, a null key counts as empty text
    in the rule of damage, repeated rows count each, and an empty table gives no rows. Other columns
    are not read. Intermediate tables are written once, to ``folder`` in the shared space.
    """
    if times < 2:
        raise ValueError("times must be 2 or more, or chains of forms need not end")
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "spelling")
    word_counts(docs, key, text, least_letters, least_count).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    near = near_words(words, folder)
    has = F.col("best_n") >= times * F.col("n")
    words.join(near, "word", "left").select(
        "word",
        F.when(has, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n"),
    ).write.parquet(f"{folder}/forms")
    forms = spark.read.parquet(f"{folder}/forms")
    most = forms.agg(F.max("n")).first()[0] or 0
    roots = _roots(forms, most, folder, times, least_count)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
