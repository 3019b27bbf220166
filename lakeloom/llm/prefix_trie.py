"""Prefix trie of conversations by padded turn-id matrices.

1. ``numbered_turns``: turns are range-partitioned by conversation and turn, numbered within
   their partition, and shifted by what earlier partitions hold of the conversation, so that
   one conversation may span many tasks. From here on a turn is a hash of 128 bits and the
   bytes of its text; texts are not moved again.
2. ``prefix_trie``: a conversation becomes rows of at most ``block`` turns. The digest of a
   prefix is the exclusive or of the hashes of its turns, each hashed with its place; a
   later row carries the digest of the turns before it.
3. Rows are range-partitioned and sorted by digest, turns and conversation. Each Arrow batch
   is a shard: its turns form a padded matrix, ``lexsort`` orders the rows, change masks
   between neighbours, accumulated by OR along the columns, mark where the nodes of every
   depth start, and ``reduceat`` gives members, smallest member and sums for each depth.
4. Nodes that touch the first or last row of their shard, or hold a conversation that goes on
   in a further row, are open: another shard may know more of them. All others are finished
   where they stand. Open nodes (some two paths a shard) are added up by digest; their
   subtree sums go up the tree by pointer doubling, in as many rounds as the depth has bits.

A node with a third of all conversations is as many partial rows as shards hold it. The list
whose SHA-256 a node needs is split into pieces of ``PIECE`` ids; the hash itself can only be
taken in order, so the pieces of one node stream through one task, which holds one piece.

Defined results: rows without a conversation id belong to no conversation; null roles and
texts are empty; a null turn comes first; turns that tie are ordered by role, then by hash;
repeated rows are turns of their own; a conversation without turns is a member of the root;
very long texts are hashed whole; an empty table gives an empty result (no root either);
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, written

BLOCK = 64
PIECE = 256
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- turns in their places
def numbered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """``(conv_id, pos, a, b, size)``: each turn's place from 0, the two halves of the hash of its
    role and text, and the UTF-8 bytes of its text. Written to the shared folder."""
    ship_package(turns.sparkSession)
    named = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                         F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    slim = named.select("conv_id", "turn", "role", F.xxhash64("role", "text").alias("a"),
                        F.xxhash64(F.lit("b"), "role", "text").alias("b"), F.octet_length("text").cast("long").alias("size"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("a"), F.col("b")]
    ordered = slim.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            start = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            within = np.arange(len(ids)) - np.repeat(start, np.diff(np.r_[start, len(ids)]))
            if ids[0] == last:
                within[:start[1] if len(start) > 1 else None] += seen
            last, seen = ids[-1], int(within[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part, np.int32)), batch.column(0), pa.array(within), *batch.columns[1:]],
                ["part", "conv_id", "within", "a", "b", "size"])

    placed = written(ordered.select("conv_id", "a", "b", "size").mapInArrow(
        number, "part int, conv_id long, within long, a long, b long, size long"), "turn-parts")
    pieces = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    # a conversation has a piece a partition at most
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = pieces.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    moved = ahead.where("ahead > 0").select("conv_id", "part", "ahead")
    return written(placed.join(moved, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("within") + F.coalesce("ahead", F.lit(0))).alias("pos"), "a", "b", "size"), "turns")


def branched(numbered: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: conversation ``c`` takes the first ``h`` turns of ``c - c % group``
    (all if it has fewer, none if it is absent), then its own turns after its first ``h``;
    ``h`` is the unsigned CRC-32 of decimal ``c`` modulo ``most + 1``.

    Returns the turns and ``(conv_id, length)`` of every conversation, those without turns included.
    """
    own = numbered.groupBy("conv_id").agg(F.count("*").alias("own"))
    c = F.col("conv_id")
    convs = own.select(c, "own", (F.crc32(c.cast("string").cast("binary")) % (most + 1)).alias("h"),
                       F.try_subtract(c, F.pmod(c, F.lit(group).cast("long"))).alias("base"))
    lent = own.select(F.col("conv_id").alias("base"), F.col("own").alias("lent"))
    m = F.least("h", F.coalesce("lent", F.lit(0)))
    convs = written(convs.join(lent, "base", "left").select(
        "conv_id", "base", "h", m.alias("m"), (m + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "convs")
    heads = numbered.where(F.col("pos") < most).withColumnRenamed("conv_id", "base").join(convs, "base").where("pos < h")
    tails = numbered.join(convs, "conv_id").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("m"))
    names = ["conv_id", "pos", "a", "b", "size"]
    return heads.select(*names).union(tails.select(*names)), convs.select("conv_id", "length")


# ---------------------------------------------------------------- one shard
_COLUMNS = ("open boolean, depth long, k1 long, k2 long, q1 long, q2 long, conv_id long, n long, size long, "
            "children long, leaves long, saved long, parent_conv long, ends string, piece_from long, piece string")
_NAMES = [c.split()[0] for c in _COLUMNS.split(", ")]


def _sums(parent: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of ``values`` per parent; ``parent`` ascends."""
    out = np.zeros(size, np.int64)
    if len(parent):
        start = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        out[parent[start]] = np.add.reduceat(values, start)
    return out


def _differs(column: np.ndarray) -> np.ndarray:
    return np.r_[True, column[1:] != column[:-1]]


def shard_nodes(conv: np.ndarray, block: np.ndarray, p1: np.ndarray, p2: np.ndarray, more: np.ndarray,
                sizes: np.ndarray, k1: np.ndarray, k2: np.ndarray, size: np.ndarray, width: int) -> dict[str, list]:
    """The nodes of one shard. ``sizes`` counts the turns of the rows, ``k1 k2 size`` hold them one row
    after the other; ``more`` marks rows that go on in a further one; ``width`` is the turns of a full row."""
    n, w = len(conv), int(sizes.max())
    filled = np.arange(w)[None, :] < sizes[:, None]
    m1, m2, ms = (np.zeros((n, w), np.int64) for _ in range(3))
    m1[filled], m2[filled], ms[filled] = k1, k2, size
    keys = [conv]
    for j in range(w - 1, -1, -1):
        keys += [m2[:, j], m1[:, j], filled[:, j]]
    order = np.lexsort([*keys, p2, p1, block])
    conv, block, p1, p2, more, sizes = (x[order] for x in (conv, block, p1, p2, more, sizes))
    filled, m1, m2, ms = (x[order] for x in (filled, m1, m2, ms))
    changes = [_differs(block) | _differs(p1) | _differs(p2)]
    changes += [_differs(filled[:, j]) | _differs(m1[:, j]) | _differs(m2[:, j]) for j in range(w)]
    mask = np.logical_or.accumulate(np.stack(changes, axis=1), axis=1)
    d1 = np.bitwise_xor.accumulate(np.column_stack([p1, m1]), axis=1)
    d2 = np.bitwise_xor.accumulate(np.column_stack([p2, m2]), axis=1)
    rim = (order == 0) | (order == n - 1)

    levels, group = [], np.zeros(n, np.int64)
    for c in range(w + 1):
        rows = np.flatnonzero(sizes >= c)
        start = np.flatnonzero(mask[rows, c])
        head = rows[start]
        parent = group[head]
        group = group.copy()
        group[rows] = np.cumsum(mask[rows, c]) - 1
        opened = np.logical_or.reduceat(rim[rows] | more[rows], start) if c else np.ones(len(start), bool)
        levels.append({"head": head, "parent": parent, "open": opened, "n": np.diff(np.r_[start, len(rows)]),
                       "low": np.minimum.reduceat(conv[rows], start)})
    ends: dict[tuple[int, int], list[int]] = {}
    for r in np.flatnonzero(~more):  # rows of one sequence stand together, by conversation
        c = int(sizes[r])
        ends.setdefault((c, int(np.searchsorted(levels[c]["head"], r, "right")) - 1), []).append(int(conv[r]))

    out: dict[str, list] = {name: [] for name in _NAMES}
    below = None
    for c in range(w, -1, -1):
        x = levels[c]
        count, head, closed = len(x["head"]), x["head"], ~x["open"]
        done = below["parent"][~below["open"]] if below else np.zeros(0, np.int64)
        of = lambda name: _sums(done, below[name][~below["open"]], count) if below else np.zeros(count, np.int64)
        x["children"] = _sums(done, np.ones(len(done), np.int64), count)
        last = ms[head, c - 1] if c else np.zeros(count, np.int64)
        x["leaves"] = of("leaves") + (closed & (x["children"] == 0))
        x["saved"] = of("saved") + np.where(closed, (x["n"] - 1) * last, 0)
        below = x
        root = (block[head] == 0) if not c else np.ones(count, bool)
        up = levels[c - 1] if c else None
        known = ~up["open"][x["parent"]] if c else np.zeros(count, bool)
        sha, pieces = [None] * count, []
        for g in range(count):
            ids = ends.get((c, g), [])
            if closed[g]:
                sha[g] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else EMPTY_SHA
            else:
                pieces += [(g, ids[s], ",".join(map(str, ids[s:s + PIECE]))) for s in range(0, len(ids), PIECE)]
        add = {"open": x["open"].tolist(), "depth": (block[head] * width + c).tolist(), "k1": d1[head, c].tolist(),
               "k2": d2[head, c].tolist(), "q1": d1[head, c - 1].tolist() if c else [None] * count,
               "q2": d2[head, c - 1].tolist() if c else [None] * count,
               "conv_id": [v if r else None for v, r in zip(x["low"].tolist(), root)],
               "n": np.where(root, x["n"], 0).tolist(), "size": last.tolist(), "children": x["children"].tolist(),
               "leaves": x["leaves"].tolist(), "saved": x["saved"].tolist(),
               "parent_conv": [v if k else None for v, k in zip(up["low"][x["parent"]].tolist(), known)] if c else [None] * count,
               "ends": sha, "piece_from": [None] * count, "piece": [None] * count}
        for name, values in add.items():
            out[name] += values
        for g, first, ids in pieces:  # a part that adds nothing but the piece
            row = {"open": True, "depth": add["depth"][g], "k1": add["k1"][g], "k2": add["k2"][g], "n": 0, "size": 0,
                   "children": 0, "leaves": 0, "saved": 0, "piece_from": first, "piece": ids}
            for name in _NAMES:
                out[name].append(row.get(name))
    return out


def _shards(width: int):
    kinds = {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in _COLUMNS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, block, p1, p2, more = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            turns = batch.column(5)
            flat = turns.flatten()
            out = shard_nodes(conv, block, p1, p2, more, np.diff(turns.offsets.to_numpy()),
                              *[flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)], width)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(_NAMES, types)], _NAMES)

    return rows


# ---------------------------------------------------------------- the trie
def _lines(turns: DataFrame, lengths: DataFrame, block: int) -> DataFrame:
    """``(conv_id, block, p1, p2, more, turns)``: rows of at most ``block`` turns, and one without turns a
    conversation that has none."""
    tagged = turns.select("conv_id", "pos", "size", F.xxhash64("pos", "a", "b").alias("k1"),
                          F.xxhash64(F.lit("k"), "pos", "a", "b").alias("k2"))
    rows = written(
        tagged.groupBy("conv_id", F.floor(F.col("pos") / block).cast("long").alias("block")).agg(
            F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"),
            F.array_sort(F.collect_list(F.struct("pos", "k1", "k2", "size"))).alias("t"))  # at most ``block`` turns
        .withColumn("turns", F.transform("t", lambda s: F.struct(s["k1"].alias("k1"), s["k2"].alias("k2"), s["size"].alias("size"))))
        .drop("t"), "trie-rows")
    length = lengths.select("conv_id", "length")
    zero = F.lit(0).cast("long")
    short = length.where((F.col("length") > 0) & (F.col("length") <= block)).join(rows, "conv_id").select(
        "conv_id", "block", zero.alias("p1"), zero.alias("p2"), F.lit(False).alias("more"), "turns")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chain = length.where(F.col("length") > block).join(rows.drop("turns"), "conv_id").select(
        "conv_id", "block", F.coalesce(F.bit_xor("x1").over(before), zero).alias("p1"),
        F.coalesce(F.bit_xor("x2").over(before), zero).alias("p2"),
        (F.col("length") > (F.col("block") + 1) * block).alias("more"))
    long = chain.join(rows.select("conv_id", "block", "turns"), ["conv_id", "block"])
    none = length.where("length = 0").select(
        "conv_id", zero.alias("block"), zero.alias("p1"), zero.alias("p2"), F.lit(False).alias("more"),
        F.array().cast(rows.schema["turns"].dataType).alias("turns"))
    return written(short.unionByName(long).unionByName(none), "trie-lines")


def _hashed(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each open node: its pieces, in order, through one running hash."""
    key = ["depth", "k1", "k2"]
    ordered = pieces.repartition(*key).sortWithinPartitions(*key, "piece_from").select(*key, "piece")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None

        def finished():
            return pa.RecordBatch.from_arrays(
                [*[pa.array([v], pa.int64()) for v in at], pa.array([state.hexdigest()])], [*key, "ends"])

        for batch in batches:
            for d, a, b, piece in zip(*[c.to_pylist() for c in batch.columns]):
                if (d, a, b) != at:
                    if at is not None:
                        yield finished()
                    at, state = (d, a, b), hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
        if at is not None:
            yield finished()

    return ordered.mapInArrow(rows, "depth long, k1 long, k2 long, ends string")


def _open_nodes(parts: DataFrame) -> DataFrame:
    """The open nodes with the sums of their whole subtrees."""
    key = ["depth", "k1", "k2"]
    total = lambda c: F.sum(c).alias(c)
    nodes = written(parts.where("open").groupBy(*key).agg(
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.min("conv_id").alias("conv_id"), total("n"),
        F.max("size").alias("size"), total("children"), total("leaves"), total("saved")), "trie-open")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")]
    more = nodes.where("depth > 0").select(*parent).groupBy(*key).agg(F.count("*").alias("opened"))
    above = nodes.select(*key, F.col("conv_id").alias("parent_conv"))
    children = F.col("children") + F.coalesce("opened", F.lit(0))
    tree = nodes.join(more, key, "left").withColumn("children", children).withColumn(
        "leaves", F.col("leaves") + F.when(children == 0, 1).otherwise(0)).withColumn(
        "saved", F.col("saved") + (F.col("n") - 1) * F.col("size")).drop("opened")
    tree = tree.withColumns({"u0": F.col("depth") - 1, "u1": F.col("q1"), "u2": F.col("q2")})
    up = above.select(F.col("depth").alias("u0"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), "parent_conv")
    tree = written(tree.drop("q1", "q2").join(up, ["u0", "u1", "u2"], "left"), "trie-tree")
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):  # u: the node 1, 2, 4, ... above, null beyond the root
        gain = tree.where("u1 IS NOT NULL").groupBy(F.col("u0").alias("depth"), F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        step = tree.select(F.col("depth").alias("u0"), F.col("k1").alias("u1"), F.col("k2").alias("u2"),
                           F.col("u0").alias("v0"), F.col("u1").alias("v1"), F.col("u2").alias("v2"))
        tree = written(
            tree.join(gain, key, "left").join(step, ["u0", "u1", "u2"], "left").select(
                *key, "conv_id", "parent_conv", "n", "children",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                F.col("v0").alias("u0"), F.col("v1").alias("u1"), F.col("v2").alias("u2")), "trie-tree")
    ends = _hashed(parts.where("piece IS NOT NULL").select(*key, "piece_from", "piece"))
    return tree.join(ends, key, "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY_SHA)))


def prefix_trie(turns: DataFrame, lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``turns(conv_id, pos, a, b, size)`` as from ``numbered_turns``; ``lengths(conv_id, length)`` names every
    conversation with its number of turns.
    """
    ship_package(turns.sparkSession)
    lines = _lines(turns, lengths, block)
    lead = F.get("turns", 0)["k1"].bitwiseXOR(F.col("p1"))
    order = ["lead", "block", "p1", "p2", "turns", "conv_id"]
    sharded = lines.withColumn("lead", lead).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = written(sharded.select("conv_id", "block", "p1", "p2", "more", "turns").mapInArrow(_shards(block), _COLUMNS), "trie-parts")
    opened = written(_open_nodes(parts), "trie-nodes")
    closed = parts.where("NOT open")
    named = ["depth", "n", "conv_id", "children", "leaves", "saved", "ends"]
    root = opened.where("depth = 0").select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("up"))
    first = closed.where("parent_conv IS NULL AND depth = 1").join(F.broadcast(root), ["q1", "q2"])  # one row
    above = opened.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"),
                                            F.col("k2").alias("q2"), F.col("conv_id").alias("up"))
    deeper = closed.where("parent_conv IS NULL AND depth > 1").join(above, ["depth", "q1", "q2"])
    whole = [closed.where("parent_conv IS NOT NULL").select(*named, F.col("parent_conv").alias("up")),
             first.select(*named, "up"), deeper.select(*named, "up"),
             opened.select(*named, F.col("parent_conv").alias("up"))]
    rows = whole[0].union(whole[1]).union(whole[2]).union(whole[3])
    return rows.select("conv_id", "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                       F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                       F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
