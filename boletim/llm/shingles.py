"""Shingle sets of texts as 64-bit hashes, for whole batches at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
#: Bytes of text that are hashed at once, to bound memory; a longer text is hashed alone.
BATCH_BYTES = 2_000_000

_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_WORD_KEYS = np.random.Generator(np.random.PCG64(5)).integers(0, 2**64, 64, "uint64") | np.uint64(1)
_GRAM_KEYS = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 16, "uint64") | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(count: int) -> np.ndarray:
    """One odd number per place in a word; places beyond the table get made ones."""
    more = np.arange(len(_WORD_KEYS), max(count, len(_WORD_KEYS)), dtype="uint64")
    return np.concatenate([_WORD_KEYS, mixed(more * _WORD_KEYS[1]) | np.uint64(1)])


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, A-Z in lower case, and how many words each text has."""
    data = _LOWER[np.frombuffer(b" ".join([*texts, b""]), "uint8")]
    inside = ~_SPACE[data]
    places = np.flatnonzero(inside)
    ends = np.cumsum([len(t) + 1 for t in texts])
    if not len(places):
        return np.zeros(0, "uint64"), np.zeros(len(texts), "int64")
    first = np.empty(len(places), bool)
    first[0] = True
    first[1:] = np.diff(places) > 1
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(places)))
    place = np.arange(len(places)) - np.repeat(starts, lengths)
    keys = _keys(int(lengths.max()))
    value = (data[places].astype("uint64") + np.uint64(1)) * keys[place]
    hashes = mixed(np.add.reduceat(value, starts) + lengths.astype("uint64"))
    counts = np.diff(np.searchsorted(places[starts], np.append(0, ends)))
    return hashes, counts


def _hash_batch(texts: list[bytes], width: int) -> list[np.ndarray]:
    words, counts = _word_hashes(texts)
    grams = np.zeros(max(len(words) - width + 1, 0), "uint64")
    for k in range(width):
        grams += words[k : k + len(grams)] * _GRAM_KEYS[k]
    grams = mixed(grams)
    sets, begin = [], 0
    for count in counts.tolist():
        if count >= width:
            found = grams[begin : begin + count - width + 1]
        elif count:
            few = words[begin : begin + count] * _GRAM_KEYS[:count]
            found = mixed(np.append(few, _GRAM_KEYS[-count]).sum(dtype="uint64", keepdims=True))
        else:
            found = grams[:0]
        sets.append(np.unique(found))
        begin += count
    return sets


def shingle_sets(texts: list[str], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted set of hashed ``width``-word shingles of each text.

    A text with fewer words has its whole sequence as one shingle, a text without words none.
    """
    batch, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        if batch and size + len(data) > BATCH_BYTES:
            yield from _hash_batch(batch, width)
            batch, size = [], 0
        batch.append(data)
        size += len(data)
    if batch:
        yield from _hash_batch(batch, width)
