"""Best-fit packing by minimum bin slack.

A bin's contents depend only on the lengths that are left, so the plan is made from the histogram of
lengths (as many entries as a sequence has tokens, whatever the corpus). Each bin takes the longest
length left and then, by subset sums in a bitset, the fullest combination of the others; it is made
as often as the counts allow, and removed. The pieces then find their places by their rank among
the pieces of their length, which Spark numbers in salted groups.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from boletim.llm.common import let_workers_import, tokenizer_file, whole_text
from boletim.storage import shared_folder

CAPACITY = 2048
END = 0
#: Words whose ids a worker remembers at most; beyond it, it starts again.
REMEMBERED = 800_000
#: Groups that the pieces of a length are numbered in.
SALTS = 256

# Letters, numbers and word pattern of the vocabulary, within the characters below
# U+0250 that have no normal form but themselves. They are held against texts in lower case.
_LETTER = "a-zªµºß-öø-ɏ"
_NUMBER = "0-9²³¹¼½¾"
_WORD = re.compile(
    f"[{_LETTER}]+|[{_NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{_LETTER}{_NUMBER}]+"
)
_OTHER = re.compile("[^\t-\r -~¡-ɏ]")
# What begins a special string; separators that Python takes for white space.
_WHOLE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")


class _Ids(dict):
    """Ids of what stands between white space, as little-endian bytes, made when first asked for."""

    def __init__(self, library: Tokenizer):
        self.model = library.model
        self.ids = [np.array([i], "<u4").tobytes() for i in range(library.get_vocab_size())]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = (b for b in range(256) if b not in plain)
        self.stand_in = {b: 256 + i for i, b in enumerate(rest)}

    def __missing__(self, chunk: str) -> bytes:
        words = [chunk] if chunk.isalpha() else _WORD.findall(chunk)
        if len(words) > 1:
            found = b"".join([self[w] for w in words])
        else:
            letters = chunk.encode().decode("latin-1").translate(self.stand_in)
            found = b"".join([self.ids[t.id] for t in self.model.tokenize(letters)])
        if len(self) >= REMEMBERED:
            self.clear()
        self[chunk] = found
        return found


class WordEncoder:
    """Ids of texts as little-endian bytes, the same as the library's, word by word.

    No word holds white space, so each distinct stretch between white space is encoded once, by the
    library's merges. A text with other characters, or with what may be a special string, goes to
    the library whole.
    """

    def __init__(self, file: str):
        self.library = Tokenizer.from_file(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.known = _Ids(self.library)

    def _ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        found = []
        for text in texts:
            low = text.lower()
            if any(c in low for c in _WHOLE) or not low.isascii() and _OTHER.search(low):
                found.append(self._ids(text))
            else:
                found.append(b"".join(map(self.known.__getitem__, low.split())))
        return found


@cache
def word_encoder(file: str) -> WordEncoder:
    return WordEncoder(file)


def cut(
    docs: DataFrame,
    file: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32``: each document's ids and ``end``, cut if too long.

    A null text is empty and has the end alone. Repeated rows are pieces of their own.
    """
    let_workers_import(docs.sparkSession)
    file = file or tokenizer_file("word_bpe_49k.json")
    last = np.array([end], "<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(file)
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["key"], encoder.encode(list(batch["text"]))):
                ids += last
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids_crc32"])

    # Keys travel as text, so that a null key or one of any type comes back as it was.
    kind = docs.schema[key].dataType.simpleString()
    out = "key string, piece int, start bigint, length bigint, ids_crc32 bigint"
    cells = docs.select(F.col(key).cast("string").alias("key"), whole_text(text).alias("text"))
    return cells.mapInPandas(pieces, out).select(
        F.col("key").cast(kind).alias(key), "piece", "start", "length", "ids_crc32"
    )


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of at most ``counts`` of each length with the largest sum up to ``room``.

    Bit ``s`` of the bitset says that the sum ``s`` can be reached; what it was before each length
    leads back to the combination.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        steps.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:
            take = min(step, left)
            reach |= (reach << (length * take)) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    rest, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> rest & 1:
            rest -= length
            chosen[length] = chosen.get(length, 0) + 1
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how often each is made, until no length is left."""
    left = {x: n for x, n in histogram.items() if n > 0}
    made = []
    while left:
        longest = max(left)
        others = {**left, longest: left[longest] - 1}
        combination = fullest({x: n for x, n in others.items() if n}, capacity - longest)
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[x] // n for x, n in combination.items())
        for x, n in combination.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        made.append((combination, times))
    return made


def places(made: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """Runs of ranks of a length: where each begins, and the sequence and offset it leads to.

    Rank ``r`` of a run of ``times`` sequences is slot ``r // times`` of sequence ``r % times``.
    """
    runs, used, first = [], {}, 0
    for combination, times in made:
        offset = 0
        for length, n in sorted(combination.items(), reverse=True):
            begin = used.get(length, 0)
            runs.append((length, begin, first, times, offset))
            used[length] = begin + n * times
            offset += n * length
        first += times
    return pd.DataFrame(
        sorted(runs), columns=["length", "begin", "sequence", "times", "offset"], dtype="int64"
    )


def _numbered(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0, among the pieces of a length.

    A length may hold any share of the rows: they are numbered within salted groups, and the groups'
    sizes are added up.
    """
    salted = pieces.withColumn(
        "salt", F.pmod(F.xxhash64(*pieces.columns), F.lit(SALTS)).cast("int")
    )
    group = Window.partitionBy("length", "salt").orderBy(*pieces.columns)
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = salted.groupBy("length", "salt").count()
    bases = sizes.select(
        "length", "salt", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base")
    )
    ranked = salted.withColumn("within", F.row_number().over(group) - 1)
    return (
        ranked.join(bases, ["length", "salt"])
        .withColumn("rank", F.col("base") + F.col("within"))
        .select(*pieces.columns, "rank")
    )


def _placed(runs: pd.DataFrame, length: Column, rank: Column) -> Column:
    """The sequence and offset of a piece. ``runs`` has at most a few entries per length."""

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def find(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        begins = runs["length"].to_numpy() << 42 | runs["begin"].to_numpy()
        at = np.searchsorted(begins, lengths.to_numpy() << 42 | ranks.to_numpy(), "right") - 1
        run = runs.iloc[at]
        within = ranks.to_numpy() - run["begin"].to_numpy()
        times = run["times"].to_numpy()
        return pd.DataFrame(
            {
                "sequence_id": run["sequence"].to_numpy() + within % times,
                "offset": run["offset"].to_numpy()
                + within // times * lengths.to_numpy(),
            }
        )

    return find(length, rank)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces``, which have a ``length`` up to ``capacity``.

    The pieces are read twice: give a written table. Repeated rows get places of their own, and an
    empty table stays empty. The histogram that comes to the driver has ``capacity`` rows at most.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = places(plan(counts, capacity))
    place = _placed(runs, F.col("length"), F.col("rank"))
    return (
        _numbered(pieces)
        .withColumn("place", place)
        .select(*pieces.columns, "place.sequence_id", "place.offset")
    )


def pack_documents(
    docs: DataFrame,
    file: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    folder: str | None = None,
) -> DataFrame:
    """Documents cut and packed; the pieces are written once, to ``folder`` in the shared space."""
    folder = folder or shared_folder(docs.sparkSession, "pieces")
    cut(docs, file, key, text, capacity).write.parquet(folder)
    return pack(docs.sparkSession.read.parquet(folder), capacity)
