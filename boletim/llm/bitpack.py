"""Token ids in files of fixed-width bits.

An id takes the fewest bits that the vocabulary's largest id needs. A file holds blocks of equally
many ids (the last may hold fewer), each begun on a byte; the offset of every block, so that any
stretch of ids is one ranged read and one vectorised unpacking; and an index of its documents.
Numbers are little-endian:

    header    magic (8 bytes), bits of an id (u4), ids of a block (u4)
    blocks    id i of a block in bits i * bits .. (i + 1) * bits, lowest bit first
    offsets   u8 of every block and of the end of the last
    index     Arrow stream: key string, start int64 (ids of the file before the document)
    trailer   ids (u8), place of the offsets (u8), place of the index (u8), magic

Spark deals the documents out by ranges of their key and sorts each range; a task writes one file
under a name of its own, and the manifest, written by Spark after the tasks, names the files that
count. A file left by a lost or repeated task is in no manifest and is never read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from boletim.llm.common import let_workers_import, tokenizer_file, whole_text

END = 2
#: Ids of a block.
BLOCK = 1 << 16
#: Ids that a reader unpacks at a time, if no document is longer.
AT_ONCE = 1 << 20
#: Bytes of the texts that a worker encodes at a time.
AT_A_TIME = 3_000_000
#: Bytes of the stretches of text that a worker remembers; beyond it, it starts again.
REMEMBERED = 8_000_000

MAGIC = b"BITIDS01"
_HEADER = struct.Struct("<8sII")
_TRAILER = struct.Struct("<QQQ8s")
#: Widths of whole bytes, where the packed bits are plain numbers.
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}
MANIFEST = "part int, file string, ids bigint, documents bigint"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that tell ``vocabulary`` ids apart, one at least."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, up to 32; the last byte is filled with zeros."""
    if bits in _WHOLE:
        return ids.astype(_WHOLE[bits]).tobytes()
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(
        np.unpackbits(octets, axis=1, bitorder="little")[:, :bits], bitorder="little"
    ).tobytes()


def unpack(packed: bytes, first: int, count: int, bits: int) -> np.ndarray:
    """``count`` ids from the one at ``first``: eight bytes from where each begins, shifted."""
    if not count:
        return np.zeros(0, "<u4")
    if bits in _WHOLE:
        width = bits // 8
        return np.frombuffer(packed, _WHOLE[bits], count, first * width).astype("<u4")
    padded = packed + bytes(8)
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    at = np.arange(first, first + count, dtype=np.int64) * bits
    return (eights[at >> 3] >> (at & 7).astype(np.uint64) & ((1 << bits) - 1)).astype("<u4")


class Writer:
    """Writes one file to a stream, front to back; what it holds is less than a block and the index."""

    def __init__(self, out: BinaryIO, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = out, bits, block
        self.offsets, self.keys, self.starts = [_HEADER.size], [], []
        self.ids, self.rest = 0, np.zeros(0, "<u4")
        out.write(_HEADER.pack(MAGIC, bits, block))

    def add(self, keys: list[str | None], ids: list[np.ndarray]) -> None:
        """Documents with their ids, in the order of the file."""
        for key, found in zip(keys, ids):
            self.keys.append(key)
            self.starts.append(self.ids)
            self.ids += len(found)
        held = np.concatenate([self.rest, *ids])
        if len(held) and int(held.max()) >> self.bits:
            raise ValueError(f"an id needs more than {self.bits} bits")
        whole = len(held) // self.block * self.block
        for at in range(0, whole, self.block):
            self._put(held[at : at + self.block])
        self.rest = held[whole:]

    def _put(self, ids: np.ndarray) -> None:
        packed = pack(ids, self.bits)
        self.out.write(packed)
        self.offsets.append(self.offsets[-1] + len(packed))

    def close(self) -> None:
        if len(self.rest):
            self._put(self.rest)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        index = pa.table({"key": pa.array(self.keys, pa.string()), "start": pa.array(self.starts, pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_table(index)
        self.out.write(sink.getvalue())
        offsets = self.offsets[-1]
        self.out.write(_TRAILER.pack(self.ids, offsets, offsets + 8 * len(self.offsets), MAGIC))


class Reader:
    """Any stretch of the ids of a file that can be read by position."""

    def __init__(self, file: BinaryIO):
        self.file = file
        size = file.seek(0, 2)
        self.n_ids, offsets, index, magic = _TRAILER.unpack(
            self._bytes(size - _TRAILER.size, size)
        )
        begins, self.bits, self.block = _HEADER.unpack(self._bytes(0, _HEADER.size))
        if magic != MAGIC or begins != MAGIC:
            raise ValueError("not a whole file of packed ids")
        self.offsets = np.frombuffer(self._bytes(offsets, index), "<u8").astype(np.int64)
        table = pa.ipc.open_stream(self._bytes(index, size - _TRAILER.size)).read_all()
        self.keys = table["key"].to_pylist()
        self.starts = np.append(table["start"].to_numpy(), self.n_ids)

    def _bytes(self, begin: int, end: int) -> bytes:
        self.file.seek(begin)
        return self.file.read(end - begin)

    def ids(self, first: int, count: int) -> np.ndarray:
        """``count`` ids of the file from the one at ``first``."""
        if first < 0 or count < 0 or first + count > self.n_ids:
            raise IndexError(f"ids {first} to {first + count} of {self.n_ids}")
        if not count:
            return np.zeros(0, "<u4")
        begin, end = first // self.block, (first + count - 1) // self.block + 1
        data = self._bytes(self.offsets[begin], self.offsets[end])
        parts = []
        for k in range(begin, end):
            low = max(first, k * self.block)
            high = min(first + count, (k + 1) * self.block)
            at = self.offsets[k : k + 2] - self.offsets[begin]
            parts.append(unpack(data[at[0] : at[1]], low - k * self.block, high - low, self.bits))
        return np.concatenate(parts)

    def documents(self, at_once: int = AT_ONCE) -> Iterator[tuple[str | None, int, np.ndarray]]:
        """Key, start and ids of every document; about ``at_once`` ids are unpacked at a time."""
        doc = 0
        while doc < len(self.keys):
            begin = self.starts[doc]
            end = max(doc + 1, int(np.searchsorted(self.starts, begin + at_once, "right")) - 1)
            ids = self.ids(int(begin), int(self.starts[end] - begin))
            for k in range(doc, end):
                low, high = self.starts[k : k + 2] - begin
                yield self.keys[k], int(self.starts[k]), ids[low:high]
            doc = end


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file named as Spark names it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    uri = re.sub("^file:/+", "file:///", re.sub("^s3[an]://", "s3://", uri))
    return fs.FileSystem.from_uri(uri)


# What Python or the vocabulary's pattern takes for white space.
_SPACE = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


class ByteEncoder:
    """Ids of texts, the same as the library's, each distinct stretch between spaces encoded once.

    In the vocabulary's pattern a space or a line break only begins a pre-token or stands in a run of
    white space, so a text may be cut before either where no white space precedes it. Texts with
    spaces elsewhere, or with what may be a special string, go to the library whole. The stretches
    are told apart, looked up and strung together by Arrow and NumPy; Python sees only new ones.
    """

    CUT = "\0"
    _whole = f"{_SPACE} | \n|<\\||{CUT}"
    _lines = f"{_SPACE}\n"
    _line = re.compile(f"(?<!{_SPACE})\n")

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(file)
        self.library.no_truncation()
        self.library.no_padding()
        self._forget()

    def _forget(self) -> None:
        """No stretch is known: their text, their ids one after another, where each one's begin."""
        self.known = pa.array([], pa.large_string())
        self.held = 0
        self.ids = np.zeros(0, "<u4")
        self.begins, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: pa.Array) -> None:
        parts, counts = [self.ids], [self.counts]
        for at in range(0, len(new), 10_000):
            found = self._encode(new.slice(at, 10_000).to_pylist())
            parts.append(np.fromiter(chain.from_iterable(found), "<u4"))
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
        self.ids, self.counts = np.concatenate(parts), np.concatenate(counts)
        self.begins = np.cumsum(self.counts) - self.counts
        self.known = pa.concat_arrays([self.known, new])
        self.held = pc.sum(pc.binary_length(self.known)).as_py() or 0

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Which known stretch each of ``distinct`` is; those not known yet are learnt."""
        if self.held > REMEMBERED:
            self._forget()
        found = pc.index_in(distinct, value_set=self.known)
        first = len(self.known)
        if found.null_count:
            self._learn(distinct.filter(found.is_null()))
        places = found.fill_null(-1).to_numpy().astype(np.int64)
        new = places < 0
        places[new] = first + np.arange(new.sum())
        return places

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        given = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        given = given.cast(pa.large_string())
        whole = pc.match_substring_regex(given, self._whole).to_numpy(zero_copy_only=False)
        lines = pc.match_substring_regex(given, self._lines).to_numpy(zero_copy_only=False)
        cut = pc.replace_substring(given.filter(pa.array(~whole & ~lines)), "\n", self.CUT + "\n")
        others = np.flatnonzero(~whole & lines)
        some = [self._line.sub(self.CUT + "\n", given[i].as_py()) for i in others]
        parts = pa.concat_arrays([cut, pa.array(some, pa.large_string())])
        found = self._strung(pc.replace_substring(parts, " ", self.CUT + " "))
        ids: dict[int, np.ndarray] = dict(zip([*np.flatnonzero(~whole & ~lines), *others], found))
        for i in np.flatnonzero(whole):
            ids[i] = np.array(self._encode([given[i].as_py()])[0], "<u4")
        return [ids[i] for i in range(len(given))]

    def _strung(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts from those of their stretches, which end at cuts."""
        if not len(texts):
            return []
        split = pc.split_pattern(texts, self.CUT)
        ends = split.offsets.to_numpy().astype(np.int64)
        words = split.flatten().dictionary_encode()
        places = self._places(words.dictionary)[words.indices.to_numpy()]
        taken = self.counts[places]
        total = np.concatenate([[0], np.cumsum(taken)])
        at = np.repeat(self.begins[places] - total[:-1], taken) + np.arange(total[-1])
        return np.split(self.ids[at], total[ends[1:-1]])


@cache
def byte_encoder(file: str) -> ByteEncoder:
    return ByteEncoder(file)


def _spans(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about so many bytes that a text can still be any length."""
    at = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)) // AT_A_TIME
    cuts = [0, *np.flatnonzero(np.diff(at)) + 1, len(batch)] if len(batch) else []
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))


def write(
    docs: DataFrame,
    folder: str,
    file: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    end: int = END,
    block: int = BLOCK,
) -> DataFrame:
    """Encode every text, append ``end`` and write the ids to ``folder`` in the order of ``key``.

    Returns the manifest, a row per file: ``part, file, ids, documents``; it is also written, below
    ``folder``. A null text is empty and has the end alone. Null keys come first; rows of one key go
    by the hash of their text, so that they may be dealt over many files and still come out alike on
    every run. An empty table gives an empty manifest and no file. Other columns are not read.
    ``folder`` must be one that all executors share, on a file system that Arrow can write to.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    file = file or tokenizer_file("byte_bpe_50k.json")
    vocabulary = Tokenizer.from_file(file).get_vocab_size()
    bits = bits_for(max(vocabulary, end + 1))
    last = np.array([end], "<u4")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = byte_encoder(file), None
        part = TaskContext.get().partitionId()
        system, path = _place(folder)
        system.create_dir(path, recursive=True)
        name = f"ids-{part:07d}-{uuid.uuid4().hex}.bin"
        for batch in batches:
            for some in _spans(batch):
                if writer is None:
                    writer = Writer(system.open_output_stream(f"{path}/{name}"), bits, block)
                ids = [np.append(x, last) for x in encoder.encode(some.column("text"))]
                writer.add(some.column("key").to_pylist(), ids)
        if writer is not None:
            writer.close()
            writer.out.close()
            pa.default_memory_pool().release_unused()
            row = {
                "part": pa.array([part], pa.int32()),
                "file": [f"{folder}/{name}"],
                "ids": [writer.ids],
                "documents": [len(writer.keys)],
            }
            yield pa.RecordBatch.from_pydict(row)

    kept = docs.select(
        F.col(key).alias("order"),
        F.col(key).cast("string").alias("key"),
        whole_text(text).alias("text"),
        F.xxhash64(whole_text(text)).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.asc_nulls_first("order"), F.asc("hash"), F.asc("row")]
    dealt = kept.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    dealt.mapInArrow(put, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read(
    spark: SparkSession,
    folder: str,
    key: str = "doc_id",
    kind: str = "bigint",
    with_ids: bool = False,
) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document that the manifest's files hold.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is of its ids as unsigned
    little-endian 32-bit integers; ``with_ids`` adds them as ``ids array<bigint>``.
    """
    let_workers_import(spark)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per file: far fewer than documents, whatever the corpus.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(
        "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")
    )
    columns = ["key", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, base in zip(batch["file"], batch["base"]):
                system, path = _place(name)
                rows, held = [], 0
                with system.open_input_file(path) as file:
                    for doc, start, ids in Reader(file).documents():
                        row = (doc, base + start, len(ids), zlib.crc32(ids.tobytes()))
                        rows.append((*row, ids.astype("int64")) if with_ids else row)
                        held += len(ids)
                        if len(rows) >= 10_000 or with_ids and held >= AT_ONCE:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)

    out = "key string, start bigint, n_tokens bigint, ids_crc32 bigint"
    tasks = max(1, manifest.count())
    found = files.repartition(tasks).mapInPandas(get, out + (", ids array<bigint>" if with_ids else ""))
    return found.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
