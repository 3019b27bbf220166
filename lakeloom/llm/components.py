"""Connected components of an edge table: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, working_tables, written


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``; the label is the smallest node reached.

    Each round hangs every node on the smallest neighbour it knows, by one aggregate and
    one join per star; the number of rounds grows with the logarithm of the longest
    chain. A round's result is a table in the shared folder, so that a lost executor
    costs no earlier round; it is deleted when the next one is there. Ends when a round changes nothing. Null ends and loops are
    ignored; an empty table gives an empty result.
    """
    e = edges.select(F.col("a"), F.col("b")).where("a <> b")
    with working_tables() as old:
        e = written(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        with working_tables() as new:
            e = written(small, "stars")
        discard(edges.sparkSession, old)
        old = new
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
