import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeloom.llm import simhash as S
from lakeloom.llm.components import components


def brute_print(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(ids, prints, bits=4):
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                up[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(ids))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_golay_code_is_perfect():
    index = S.nearest_codeword(np.arange(1 << 23, dtype=np.uint32))
    assert np.array_equal(np.bincount(index, minlength=4096), np.full(4096, 2048))


@pytest.mark.parametrize("pattern", [(4, 0, 0, 0), (2, 2, 0, 0), (2, 0, 2, 0), (1, 1, 1, 1), (0, 1, 1, 2), (1, 0, 2, 1),
                                     (2, 1, 1, 0), (0, 2, 0, 2), (3, 1, 0, 0), (0, 0, 0, 0), (0, 3, 1, 0), (1, 2, 1, 0)])
def test_every_error_pattern_meets_under_a_key(pattern):
    rnd = random.Random(str(pattern))
    for _ in range(150):
        u = rnd.getrandbits(64)
        v = u
        for i, e in enumerate(pattern):
            for b in rnd.sample(range(16), e):
                v ^= 1 << (16 * i + b)
        row, key, side = S.bucket_keys(np.array([u, v], np.uint64))
        a = dict(zip(key[row == 0].tolist(), side[row == 0].tolist()))
        b = dict(zip(key[row == 1].tolist(), side[row == 1].tolist()))
        assert any(a[k] | b[k] == 3 for k in a.keys() & b.keys())
        assert len(a) == int((row == 0).sum())


def test_fingerprints(spark):
    rnd = random.Random(3)
    texts = [None, "", " \n\t", "One", "two Words", "three word text", "exactly four words here", "É É é A b\x0bc",
             "  x\u0085y z q w"] + [" ".join(rnd.choice("abC") for _ in range(n)) for n in (5, 50, 70_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r for r in S.with_fingerprint(df, "t", "fp").withColumn("hex", S.fingerprint_hex("fp")).collect()}
    for i, t in enumerate(texts):
        assert got[i].hex == "%016x" % brute_print(t), i


def test_groups_match_brute_force_with_chains_and_a_hot_bucket(spark):
    rnd = random.Random(11)
    prints = []
    for _ in range(25):  # chains whose ends are far apart, and stars
        p = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 8)):
            prints.append(p)
            for b in rnd.sample(range(64), rnd.randint(0, 6)):
                p ^= 1 << b
    base = rnd.getrandbits(64)
    for _ in range(150):  # many different ones in few bits: large buckets with several components
        p = base
        for b in rnd.sample(range(20), rnd.randint(0, 9)):
            p ^= 1 << (b * 3)
        prints.append(p)
    prints += prints[:20] + [0, 0]
    ids = rnd.sample(range(1000), len(prints) - 3) + [None, None, 5]
    df = spark.createDataFrame([(d, signed(p)) for d, p in zip(ids, prints)], "doc_id long, fp long")
    got = sorted((str(r.doc_id), r.fp, r.component_id) for r in S.near_duplicates(df).collect())
    want = sorted((str(d), signed(p), c) for d, p, c in zip(ids, prints, brute_groups(ids, prints)))
    assert got == want


def test_drop_keeps_one_row_each(spark):
    rows = [(3, "a b c d e f", "x"), (1, "A b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "y"),
            (9, None, "z"), (None, "", "z"), (None, "q w e r t y u", "n"), (None, "q w e r t y u", "n"), (7, "other words", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("row", F.lit(1))
    out = S.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "7", "9", "None"]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_groups(docs).collect() == []
    assert S.drop_near_duplicates(docs).collect() == []


def test_components_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
