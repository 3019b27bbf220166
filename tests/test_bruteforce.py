"""Queries without a SQL oracle, checked against a brute-force computation on the smallest tables."""

import math
import struct
from collections import Counter

import duckdb
import xxhash

from lakeloom.operators import layout as lo
from lakeloom.plans.index import QUERIES

SF = "/root/testdata/sf0.001"


def spark_xxhash64_long(v: int, seed: int = 42) -> int:
    """Spark's xxhash64 of a bigint: XXH64 over its 8 little-endian bytes, as a signed long."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=seed)
    return h - (1 << 64) if h >= (1 << 63) else h


def test_salt_buckets_against_brute_force(spark):
    """A salt from another column splits each key; its buckets are those of the hash, recomputed here."""
    rows = [(i % 3, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, v long")
    got = Counter((r["k"], r["salt"]) for r in lo.repartition_by_salt(df, "k", 8).collect())
    assert got == Counter((k, spark_xxhash64_long(v) % 8) for k, v in rows)
    assert len({s for k, s in got if k == 0}) == 8


def test_salt_layout_invariants(spark):
    con = duckdb.connect()
    supp = [r[0] for r in con.execute(f"SELECT l_suppkey FROM '{SF}/lineitem.parquet'").fetchall()]
    r = QUERIES["salt_layout"][0](spark, SF).first()
    assert (r["suppliers"], r["rows"], r["in_range"], r["hot_key_split"]) == (len(set(supp)), len(supp), True, True)


def test_partition_advice_formula(spark):
    con = duckdb.connect()
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    n = con.execute(f"SELECT count(*) FROM '{SF}/lineitem.parquet'").fetchone()[0]
    for mb in (1, 128):
        r = lo.partition_advice(df, mb).first()
        assert r["total_rows"] == n and r["avg_row_bytes"] > 0
        assert r["recommended_partitions"] == max(1, math.floor(n * r["avg_row_bytes"] / (mb * 1024 * 1024)))
    r = QUERIES["partition_advice"][0](spark, SF).first()
    assert r["measured"] and r["consistent"]
