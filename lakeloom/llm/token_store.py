"""Token-id store: one concatenated id array with Elias-Fano document boundaries.

Format: a folder of Parquet files whose rows are blocks. A block holds the ids of
consecutive documents as little-endian integers of ``width`` bytes (2 where the
vocabulary fits, else 4), the Elias-Fano code of the documents' ends in the block and that
of their ids (less ``first_id``; ``null_ids`` documents without an id come first). Blocks
are ordered by (``shard``, ``block``); ``before`` counts the ids of the shard before the
block. A document's start is the ids of all shards before its own, plus ``before``, plus
the end of the document before it, which ``select`` returns without decoding the block.

Documents are dealt out by ranges of their id and sorted, so the shards are in ascending
order of ids. Spark's writer commits whole tasks: a lost executor leaves no half block.
A block closes at ``BLOCK_IDS`` ids or ``BLOCK_DOCS`` documents; one document is never
cut, so a longer one is a block by itself.

Defined results: a null or empty text has the end id alone; null ids come first; rows
with equal ids are each written, ordered by their text; an empty table makes an empty
store; other columns are not read.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import elias_fano
from .common import ship_package

BLOCK_IDS = 1 << 17
BLOCK_DOCS = 1 << 14
CACHE_WORDS = 1 << 20
_CACHED_CHARS = 40
_SLICE_CHARS = 1 << 21

_SCHEMA = ("shard int, block int, n_docs int, n_tokens long, before long, width int, null_ids int, first_id long, "
           "doc_ids binary, ends binary, ids binary")


#: Words of letters that normalisation only lower-cases, with the punctuation after them.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([.,;:!?]*)")


def _byte_alphabet() -> dict[int, str]:
    """Byte-level tokenizers write a byte as itself where it is a visible Latin-1 character, else
    as the next character from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder(dict):
    """A ``tokenizers`` tokenizer that meets each distinct word once.

    Only for byte-level tokenizers that lower-case, split letters from punctuation and never
    look across a space or a line feed: no token spans white space, so a text's ids are
    those of its words, one after the other. A plain word's letters and punctuation are
    single pre-tokens and go to the tokenizer's model as such; any other word goes through
    the whole tokenizer. The dictionary holds ``CACHE_WORDS`` words at most and starts
    afresh beyond; long words are not kept.
    """

    def __init__(self, path: str):
        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.bytes_of = _byte_alphabet()
        self.parts: dict[str, bytes] = {"": b""}

    def _pack(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _part(self, text: str) -> bytes:
        got = self.parts.get(text)
        if got is None:
            symbols = text if text.isascii() else text.encode().decode("latin-1").translate(self.bytes_of)
            got = self.parts[text] = self._pack([t.id for t in self.model.tokenize(symbols)])
        return got

    def __missing__(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain:
            got = self._part(plain[1].lower()) + self._part(plain[2])
        else:
            got = self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= _CACHED_CHARS:
            self[word] = got
        return got

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if len(self) > CACHE_WORDS or len(self.parts) > CACHE_WORDS:
            self.clear()
            self.parts.clear()
            self[""] = self.parts[""] = b""
        return [b"".join(map(self.__getitem__, (t or "").replace("\n", " ").split(" "))) for t in texts]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a worker's tasks: each distinct word is coded once for all of them."""
    return WordEncoder(path)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """(ids, texts) of a batch, cut so that the texts of a slice stay short together."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1)
    start, size = 0, 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
    for i, n in enumerate(lengths):
        size += n
        if size >= _SLICE_CHARS or i + 1 == len(ids):
            yield ids[start:i + 1], texts.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0


def _block(shard: int, number: int, before: int, width: int, ids: list, parts: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([len(p) // width for p in parts])
    known = np.array([i for i in ids if i is not None], np.int64)
    first = int(known[0]) if len(known) else 0
    row = [shard, number, len(ids), int(ends[-1]), before, width, len(ids) - len(known), first,
           elias_fano.encode(known - first), elias_fano.encode(ends), b"".join(parts)]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(),
             pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                      [c.split()[0] for c in _SCHEMA.split(", ")])


def write_store(docs: DataFrame, path: str, make_encoder: Callable, end_id: int, doc_id: str = "doc_id",
                text: str = "text") -> None:
    """Encode ``docs`` and write the store to ``path``. ``make_encoder()`` runs once a task
    and returns a function from texts to little-endian ids of ``width`` bytes."""
    spark = docs.sparkSession
    ship_package(spark)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = slim.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        encoder = make_encoder()
        end = int(end_id).to_bytes(encoder.width, "little")
        ids, parts, size = [], [], 0
        for batch in batches:
            for some, texts in _slices(batch):
                for i, coded in zip(some, encoder(texts)):
                    ids.append(i)
                    parts.append(coded + end)
                    size += len(coded) // encoder.width + 1
                    if size >= BLOCK_IDS or len(ids) >= BLOCK_DOCS:
                        yield _block(shard, number, before, encoder.width, ids, parts)
                        number, before, ids, parts, size = number + 1, before + size, [], [], 0
        if ids:
            yield _block(shard, number, before, encoder.width, ids, parts)

    ordered.mapInArrow(blocks, _SCHEMA).write.option("parquet.block.size", 16 << 20).parquet(path)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``base``, the ids of all blocks before: one row a shard is broadcast
    (as many as the writer had partitions), the blocks themselves are not shuffled."""
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("shard_base"))
    return blocks.join(F.broadcast(bases), "shard").withColumn("base", F.col("shard_base") + F.col("before"))


def block_documents(width: int, null_ids: int, first_id: int, base: int, doc_ids: bytes, ends: bytes,
                    ids: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start, ids) of the documents of a block."""
    stops = elias_fano.EliasFano(ends).values()
    names = [None] * null_ids + (elias_fano.EliasFano(doc_ids).values() + first_id).tolist()
    array = np.frombuffer(ids, f"<u{width}")
    begin = 0
    for name, stop in zip(names, stops.tolist()):
        yield name, base + begin, array[begin:stop]
        begin = stop


_PARTS = ("width", "null_ids", "first_id", "base", "doc_ids", "ends", "ids")


def _scan(blocks: DataFrame, last: str, kind: pa.DataType, sql: str, value: Callable) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                got = [(d, s, len(a), value(a)) for d, s, a in
                       block_documents(*[batch.column(c)[i].as_py() for c in range(len(_PARTS))])]
                cols = list(zip(*got))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), kind))],
                    ["doc_id", "start", "n_tokens", last])

    ship_package(blocks.sparkSession)
    return blocks.select(*_PARTS).mapInArrow(rows, f"doc_id long, start long, n_tokens long, {last} {sql}")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document of the store."""
    return _scan(open_store(spark, path), "ids", pa.list_(pa.int32()), "array<int>", lambda a: a.astype(np.int32))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_store``, with the CRC-32 of the ids (as unsigned 32-bit little-endian) in place of them."""
    return _scan(open_store(spark, path), "ids_crc32", pa.int64(), "long",
                 lambda a: zlib.crc32(a.astype("<u4").tobytes()))
