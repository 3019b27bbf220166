"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint: 64 bits; a bit is set if it is set in over half of the XXH64 hashes (seed 42)
of the text's word shingles. Two texts link at ``max_bits`` (4 at most) differing bits.

Candidates: the fingerprint is cut into four segments of 16 bits. Each is read as a word
of the 23-bit space of the perfect binary Golay code and decoded to the index (12 bits) of
its nearest codeword. Words one bit apart may decode differently, so a segment also gets
the indices that its 16 one-bit neighbours decode to: its fuzzy keys. If two segments
differ in one bit or none, the own index of one is among the fuzzy keys of the other.

Pigeonhole of at most 4 errors over 4 segments:

- some segment ``i`` is equal. The errors of the other three sum to 4 at most, so either
  another segment is equal too, or at most one of the three has two errors. Hence one of
  the pairs (i, i + 1), (i, i + 2) of some equal segment ``i`` holds a segment with one
  error or none. Key: the 16 bits of ``i`` and the fuzzy index of the other, 28 bits;
- or all four have exactly one error. Key: the indices of segments 0, 1 and 2, 36 bits;
  one side brings the fuzzy keys of 0 and 1, the other those of 2.

So every linked pair meets under a key, and only verified pairs link. Work in a bucket
(the fingerprints of one key) is kept linear where it is large: each member is first
compared with the bucket's smallest fingerprint, components are formed, and only then
members whose component differs from that of the smallest are compared with all others.
Pairs inside one component are never listed, and none is lost.

Defined results: null, empty and blank texts have fingerprint zero and link like any
other; fewer words than a shingle form one shingle; equal fingerprints are one node, so
copies and repeated rows cost nothing; a null id is no candidate for ``component_id``
(null if a component has no other); an empty table gives an empty result; extra columns
pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, free_name, ship_package, working_tables, written
from .components import components

_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
_SEED = 42
MAX_BITS = 4


# ---------------------------------------------------------------- fingerprints
def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the 64-bit hashes, as an unsigned integer."""
    lanes, block = np.uint64(0x0001000100010001), 65_535
    counts = np.zeros((16, 4), np.int64)  # bit 16 * lane + row
    for s in range(0, len(hashes), block):
        part = (hashes[s:s + block][None, :] >> np.arange(16, dtype=np.uint64)[:, None]) & lanes
        counts += np.add.reduce(part, axis=1).view(np.uint16).reshape(16, 4)
    bits = (2 * counts > len(hashes)).T.reshape(64)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = 4) -> int:
    import xxhash

    words = (text or "").encode().translate(_UPPER).split()
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(join(words), _SEED)
    grams = zip(*[words[i:] for i in range(shingle)])
    return _majority(np.array([digest(join(g), _SEED) for g in grams], np.uint64))


def with_fingerprint(df: DataFrame, text: str, out: str, shingle: int = 4) -> DataFrame:
    """``df`` plus ``out``: the fingerprint as a signed 64-bit integer."""
    ship_package(df.sparkSession)

    @F.pandas_udf(T.LongType())
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], np.uint64).view(np.int64))

    return df.withColumn(out, prints(F.col(text)))


_SLICE = 256


def fingerprints(df: DataFrame, text: str, out: str, shingle: int = 4) -> DataFrame:
    """The same with ``out`` in the place of ``text``: texts go through the task in small slices, and
    neither side of it holds a batch of rows with their texts until the fingerprints are back."""
    ship_package(df.sparkSession)
    names = [c for c in df.columns if c != text]
    schema = T.StructType([*[df.schema[c] for c in names], T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, _SLICE):
                part = batch.slice(s, _SLICE)
                prints = np.array([fingerprint(t.as_py(), shingle) for t in part.column(len(names))], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], pa.array(prints)], [*names, out])

    return df.select(*names, text).mapInArrow(run, schema)


# ---------------------------------------------------------------- Golay keys
def nearest_codeword(words: np.ndarray) -> np.ndarray:
    """Index of the nearest codeword of 23-bit words: the code is perfect, so errors have weight 3 at most."""
    rest = words.astype(np.uint32)
    for b in range(22, 10, -1):
        rest = rest ^ np.where((rest >> b) & 1, np.uint32(_GENERATOR << (b - 11)), np.uint32(0))
    return ((words.astype(np.uint32) ^ _leaders()[rest]) >> 11).astype(np.uint16)


@cache
def _leaders() -> np.ndarray:
    """The error pattern of weight 3 at most for each of the 2048 syndromes."""
    leader = np.zeros(1 << 11, np.uint32)
    single = np.r_[0, 1 << np.arange(23)].astype(np.uint32)
    errors = np.unique(single[:, None, None] ^ single[None, :, None] ^ single[None, None, :])
    errors = errors[np.bitwise_count(errors) <= 3]
    rest = errors.copy()
    for b in range(22, 10, -1):
        rest ^= np.where((rest >> b) & 1, np.uint32(_GENERATOR << (b - 11)), np.uint32(0))
    leader[rest] = errors
    return leader


@cache
def segment_keys() -> tuple[np.ndarray, np.ndarray]:
    """For every 16-bit segment: its own index, and its fuzzy keys (padded with its own index)."""
    seg = np.arange(1 << 16, dtype=np.uint32)
    index = nearest_codeword(seg << 7)
    near = np.sort(np.stack([index, *[index[seg ^ (1 << b)] for b in range(16)]], axis=1), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = 0xFFFF  # repeats go last
    near = np.sort(near, axis=1)
    width = int((near != 0xFFFF).sum(axis=1).max())
    near = near[:, :width]
    return index, np.where(near == 0xFFFF, index[:, None], near)


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, sides) of all keys of unsigned fingerprints.

    Side 1 brings single indices, side 2 the fuzzy ones; a pair counts when one row has
    side 1 and the other side 2. The family of the key is in its top byte.
    """
    index, near = segment_keys()
    seg = [((prints >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    own = [index[s].astype(np.int64) for s in seg]
    fuzzy = [near[s].astype(np.int64) for s in seg]
    n, width = len(prints), near.shape[1]
    at = np.arange(n)
    rows, keys, sides = [], [], []

    def add(family: int, key: np.ndarray, side: np.ndarray) -> None:
        rows.append(np.broadcast_to(at.reshape((n,) + (1,) * (key.ndim - 1)), key.shape).ravel())
        keys.append((key + (family << 56)).ravel())
        sides.append(np.broadcast_to(side, key.shape).ravel())

    for i in range(4):
        for hop in (1, 2):
            j = (i + hop) % 4
            add(2 * i + hop - 1, (seg[i][:, None] << 12) | fuzzy[j],
                np.where(fuzzy[j] == own[j][:, None], 3, 2))
    add(8, (fuzzy[0][:, :, None] << 24) | (fuzzy[1][:, None, :] << 12) | own[2][:, None, None],
        np.broadcast_to(np.int64(1), (n, width, width)))
    add(8, (own[0][:, None] << 24) | (own[1][:, None] << 12) | fuzzy[2], np.broadcast_to(np.int64(2), (n, width)))
    row, key, side = np.concatenate(rows), np.concatenate(keys), np.concatenate(sides)
    order = np.lexsort((key, row))  # a key that occurs more than once for a row is one, with all its sides
    row, key, side = row[order], key[order], side[order]
    first = np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])] if len(row) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    return row[first], key[first], np.bitwise_or.reduceat(side, starts) if len(starts) else side


_KEY_ROWS = 2_000


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        for s in range(0, len(values), _KEY_ROWS):
            part = values[s:s + _KEY_ROWS]
            row, key, side = bucket_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(part[row]), pa.array(side.astype(np.int8))], ["bucket", "fp", "side"])


# ---------------------------------------------------------------- links
def _close(a, b, max_bits: int):
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


#: Fingerprints that one task turns into keys, at most: some 75 keys each.
KEY_TASK_PRINTS = 250_000


def fingerprint_labels(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(node, label)`` of the distinct fingerprints in ``prints(fp)``, a written table, that have a neighbour."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    spark = prints.sparkSession
    ship_package(spark)
    with working_tables() as used:
        both = _labels(prints, max_bits)
        out = written(both, "fingerprint-labels")
        used.pop()  # the result stays, all that it was made from goes
    discard(spark, used)
    return out


def _labels(prints: DataFrame, max_bits: int) -> DataFrame:
    spark = prints.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-prints.count() // KEY_TASK_PRINTS))
    spread = prints.repartition(tasks, "fp")  # keys are many times the fingerprints: as many tasks as they need
    keyed = written(spread.mapInArrow(_emit, "bucket long, fp long, side byte"), "golay-keys")
    stats = written(
        keyed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"),
                                    F.bit_or("side").alias("sides"))
        .where("n > 1 and sides = 3").drop("sides"), "buckets")
    couples = stats.where((F.col("n") == 2) & _close(F.col("low"), F.col("high"), max_bits)).select(
        F.col("high").alias("a"), F.col("low").alias("b"))
    members = written(keyed.join(stats.where("n > 2").select("bucket", F.col("low").alias("hub")), "bucket"), "members")
    hubs = members.where(_close(F.col("fp"), F.col("hub"), max_bits)).select(
        F.col("fp").alias("a"), F.col("hub").alias("b"))
    stars = written(components(couples.union(hubs)), "labels")

    # what the stars left apart: members of another component than their bucket's hub
    def lab(df: DataFrame, col: str, out: str) -> DataFrame:
        side = stars.select(F.col("node").alias(col), F.col("label").alias(out))
        return df.join(side, col, "left").withColumn(out, F.coalesce(out, col))

    known = lab(lab(members, "fp", "own"), "hub", "main")
    known = written(known.select("bucket", "fp", "side", "own", "main"), "known")
    stray = known.where("own <> main").select("bucket", F.col("fp").alias("fp2"), F.col("side").alias("side2"),
                                              F.col("own").alias("own2"))
    meet = known.join(stray, "bucket").where(
        (F.col("own") != F.col("own2")) & _close(F.col("fp"), F.col("fp2"), max_bits)
        & (F.col("side").bitwiseOR(F.col("side2")) == 3))
    late = written(components(meet.select(F.col("own").alias("a"), F.col("own2").alias("b"))), "late-labels")
    roots = late.select(F.col("node").alias("label"), F.col("label").alias("root"))
    moved = stars.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    apart = late.join(stars.select("node"), "node", "left_anti").select("node", "label")  # no star held them
    return moved.union(apart)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", fp: str = "fp", max_bits: int = MAX_BITS,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp, component_id, component)`` and the columns ``keep`` per row of ``docs``
    (id and fingerprint columns).

    ``component_id`` is the smallest id of the component, ``component`` its smallest
    fingerprint, which also tells components without any id apart.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"), *keep)
    nodes = written(slim.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "nodes")
    labels = fingerprint_labels(nodes.select("fp"), max_bits).select(F.col("node").alias("fp"), "label")
    placed = written(nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "placed")
    # written before the join, so that both of its sides come from a shuffle and a hot label can be split
    ids = written(placed.groupBy("label").agg(F.min("low_id").alias("component_id")), "component-ids")
    return slim.join(placed.select("fp", "label").join(ids, "label"), "fp").select(
        "doc_id", "fp", "component_id", F.col("label").alias("component"), *keep)


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """``near_duplicates`` of a table of texts; fingerprints are computed and written once."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = written(fingerprints(slim, "text", "fp", shingle), "prints")
    return near_duplicates(prints, max_bits=max_bits)


#: The place of a row of a table of files that is read as it is: its file and its number in it.
FILE_PLACE = ("_metadata.file_path", "_metadata.row_index")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                         max_bits: int = MAX_BITS, place: tuple[str, str] | None = None) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the row of the smallest id.

    Rows that repeat that id (in the component) count as copies; the first by the hash of
    all columns stays. A component without any id keeps one row as well.

    ``place`` names two columns that tell the rows apart and are the same at every read:
    ``FILE_PLACE`` where ``docs`` is a parquet table as read. Without it the rows are written
    to the shared folder first. Working tables hold places and fingerprints; texts are moved
    once, by the join that keeps one row a component.
    """
    names = docs.columns
    if place is None:
        wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
        docs, place = written(wrapped, "rows"), FILE_PLACE
        col, kept_columns = (lambda c: F.col("row")[c]), ["row.*"]
    else:
        col, kept_columns = (lambda c: F.col(f"`{c}`")), [F.col(f"`{c}`") for c in names]
    everything = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    file, number = F.xxhash64(F.col(place[0])), F.col(place[1])
    held = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"), F.xxhash64(everything).alias("hash"),
                       file.alias("file"), number.alias("number"))
    prints = written(fingerprints(held, "text", "fp", shingle), "prints")
    groups = near_duplicates(prints, max_bits=max_bits, keep=("hash", "file", "number"))
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component").agg(
        F.min(F.struct("hash", "file", "number")).alias("first")).select("first.file", "first.number")
    # the list of kept rows grows with the input, so it is never broadcast: one kind of join at every size
    f, n = free_name(docs, "file"), free_name(docs, "number")
    kept = written(kept.select(F.col("file").alias(f), F.col("number").alias(n)), "kept")
    placed = docs.select("*", file.alias(f), number.alias(n))
    return placed.join(kept.hint("merge"), [f, n], "left_semi").select(*kept_columns)


def fingerprint_hex(fp):
    """16 lowercase hexadecimal digits of a signed 64-bit fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


__all__ = ["drop_near_duplicates", "fingerprint", "fingerprint_hex", "fingerprint_labels",
           "near_duplicates", "simhash_groups", "with_fingerprint"]
