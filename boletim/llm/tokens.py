"""Token counts with a whole-token shortcut, for a BPE vocabulary of sentencepiece.

Which vocabulary strings encode alone as one token is proved beforehand, once per worker, by
encoding each. A text falls into pre-tokens, each a run of spaces and what follows up to the next
space; no vocabulary string holds a space after another character (checked), so no merge crosses
these borders and their counts add up. A pre-token that is a proven string counts as one; only the
rest are merged, by the library, and remembered within a bound.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from boletim.llm.common import let_workers_import, tokenizer_file, whole_text

SPACE = "▁"
#: Merged pre-tokens that a worker remembers at most; beyond it, it starts again.
REMEMBERED = 300_000
_RUNS = re.compile(" *[^ ]+| +")


class PieceCounter:
    """Counts the tokens that the library gives for a text, without making them."""

    def __init__(self, model: str):
        self.library = SentencePieceProcessor(model_file=model)
        size = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(size)]
        self.splits = self._splits_at_spaces(pieces)
        self.alone = self._proven(pieces)
        self.known = dict(self.alone)

    def _splits_at_spaces(self, pieces: Iterable[str]) -> bool:
        """Whether merges stay within a pre-token and white space is kept as it is."""
        inner = any(SPACE in p.lstrip(SPACE) for p in pieces)
        kept = self.library.decode(self.library.encode(" a  b ")) == " a  b "
        return not inner and kept and len(self.library.encode(SPACE + "a")) == len(
            self.library.encode(" a")
        )

    def _proven(self, pieces: Iterable[str]) -> dict[str, int]:
        """The strings that, after one space, encode alone as one token."""
        words = [p[1:] for p in pieces if p[:1] == SPACE and len(p) > 1 and SPACE not in p[1:]]
        ids = self.library.encode(words, num_threads=1)
        return {w: 1 for w, found in zip(words, ids) if len(found) == 1}

    def _merge(self, words: set[str]) -> None:
        """Remember the counts of pre-tokens that are no proven string."""
        rest = list(words.difference(self.known))
        if len(self.known) + len(rest) > REMEMBERED + len(self.alone):
            self.known, rest = dict(self.alone), list(words.difference(self.alone))
        self.known.update(zip(rest, map(len, self.library.encode(rest, num_threads=1))))

    def _pre_tokens(self, text: str) -> list[str]:
        """What follows the one space that begins each pre-token."""
        words = text.replace(SPACE, " ").split(" ")
        if "" in words:
            words = [run[1:] for run in _RUNS.findall(" " + " ".join(words))]
        return words

    def count(self, texts: Iterable[str]) -> list[int]:
        if not self.splits:
            return [len(ids) for ids in self.library.encode(list(texts), num_threads=1)]
        split = [self._pre_tokens(text) if text else [] for text in texts]
        self._merge(set().union(*split) - {""})
        # A single space at the end is a pre-token of its own, and one token.
        self.known[""] = 1
        return [sum(map(self.known.__getitem__, words)) for words in split]


@cache
def piece_counter(model: str) -> PieceCounter:
    return PieceCounter(model)


def token_counter(model: str) -> Callable[[Column], Column]:
    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = piece_counter(model)
        for texts in batches:
            yield pd.Series(counter.count(texts), dtype="int64")

    return count


def token_counts(
    docs: DataFrame,
    model: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row; a null text is empty and has none.

    Repeated rows are counted each; an empty table gives no rows; other columns are not read.
    """
    let_workers_import(docs.sparkSession)
    count = token_counter(model or tokenizer_file("piece_bpe_32k.model"))
    whole = whole_text(text)
    return docs.select(
        key,
        F.octet_length(whole).cast("bigint").alias("n_bytes"),
        count(whole).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
