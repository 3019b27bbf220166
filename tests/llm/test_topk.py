import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import topk as T


def brute(rows, k, every=100):
    ints = {(i, tuple(math.floor(1024 * float(np.float32(v))) for v in x)) for i, x in rows
            if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)}
    out = []
    for q in sorted({i for i, _ in ints if i % every == 0}):
        qv = min(x for i, x in ints if i == q)
        scored = sorted((-sum(a * b for a, b in zip(qv, x)), i) for i, x in ints if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def run(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vec", F.lit("clash"))
    got = T.top_k(T.integer_vectors(df), F.col("vec_id") % 100 == 0, k)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block,chunk", [(4096, 1024), (64, 2)])
def test_matches_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(T, "BLOCK_ROWS", block)
    monkeypatch.setattr(T, "CHUNK_QUERIES", chunk)
    rng = np.random.default_rng(block)
    base = rng.normal(0, 0.12, (620, 16))
    base[100:300] = base[7]  # a very common vector: many ties
    rows = [(i, x.tolist()) for i, x in enumerate(base)]
    rows += [(700, None), (701, [None] + [0.1] * 15), (702, [math.nan] * 16), (703, [math.inf] * 16), (None, [0.5] * 16),
             (800, []), (900, [0.25, -0.5]), (3, rows[3][1]), (600, [0.1] * 16), (600, [0.1] * 16), (5, [-0.3] * 16)]
    assert run(spark, rows) == brute(rows, 10)


def test_few_rows_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0, 2.0])]) == []
    assert run(spark, [(0, [1.0, 2.0]), (1, [-1.0, 0.0]), (2, [0.0, 0.0])]) == [(0, 1, 2, 0), (0, 2, 1, -1024 * 1024)]


def test_stops_early_and_stays_exact():
    rng = np.random.default_rng(9)
    x = (rng.normal(0, 40, (3000, 32)) * (rng.random((3000, 1)) ** 4 * 20)).astype(np.int64)
    index = T.ImpactIndex(np.arange(3000), x)
    for q in x[:40]:
        ids, scores = index.search(-1, q, 10)
        exact = x @ q
        want = np.lexsort((np.arange(3000), -exact))[:10]
        assert ids.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()
