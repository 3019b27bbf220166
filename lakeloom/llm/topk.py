"""Exact top-k inner-product search over an impact-ordered score-at-a-time index.

Vectors become integers, ``floor(scale * x)``. Candidates are dealt out in blocks of about
``BLOCK_ROWS`` and queries in chunks of about ``CHUNK_QUERIES``; every block meets every
chunk once, in a task of its own with bounded memory. A stated query set against all rows
costs that product; nothing else grows with both.

Within a block each dimension has postings of its rows, ordered by component and cut into
segments of equal quantised component. For a query the impact of a segment is the largest
product that its quantised bounds allow. Segments are processed by descending impact: each
adds its impact to the accumulators of its rows. A row's score is then at most its
accumulator plus, for each of its postings not yet seen, the impact of the next segment.
The rows that lead are scored exactly; their k-th score is a threshold that rows must
reach. Processing stops only when the rows whose bound still reaches it are few, or no
segment is left; all of those are rescored exactly, so the result is exact. The blocks'
lists are merged by a window with a limit per query.

Defined results: vectors that are null or hold a null or non-finite component take no
part, nor do rows without an id; vectors of different lengths are padded with zeros; equal
rows count once; rows that share an id but not the vector are candidates each, and the
smallest such vector is the query of that id; a query's own id is never its candidate; ties
go to the smaller id; an empty table gives an empty result; other columns are not read.
Scores are exact while they fit 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship_package, written

BLOCK_ROWS = 4096
CHUNK_QUERIES = 1024
LEVELS = 32
_STEPS = 8


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """Distinct ``(vec_id, vec)`` rows that take part, ``vec`` as an array of longs."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != float("inf")))
    return (df.where(F.col(vec_id).isNotNull() & x.isNotNull()).where(fine)
            .select(F.col(vec_id).cast("long").alias("vec_id"),
                    F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double"))).alias("vec")).distinct())


class ImpactIndex:
    """Impact-ordered postings of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, levels: int = LEVELS):
        self.ids, self.x = ids, x
        n, d = x.shape
        spread = int(np.abs(x).max(initial=0))
        shift = max(0, (2 * spread // levels).bit_length())
        order = np.argsort(x, axis=0, kind="stable").T  # dimension by dimension, ascending
        level = (np.take_along_axis(x.T, order, axis=1) >> shift)
        self.postings = order.ravel().astype(np.int32)
        flat = level.ravel()
        cut = np.flatnonzero(np.r_[True, (flat[1:] != flat[:-1])] | (np.arange(n * d) % max(n, 1) == 0)) if n * d else np.zeros(0, int)
        self.start, self.end = cut, np.r_[cut[1:], n * d] if len(cut) else cut
        self.dim = cut // max(n, 1)
        self.low = flat[cut] << shift
        self.high = self.low + (1 << shift) - 1

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the block's best ``k`` rows for the query, exact, best first."""
        n, d = self.x.shape
        q = query[self.dim]
        impact = np.maximum(q * self.low, q * self.high)
        order = np.argsort(-impact, kind="stable")
        sizes = np.cumsum((self.end - self.start)[order])
        total = np.zeros(n, np.float64)
        seen = np.zeros(n, np.int64)
        other = self.ids != own
        limit = max(4 * k, n // 32)
        done, rows = 0, np.flatnonzero(other)
        for step in range(1, _STEPS + 1):
            upto = int(np.searchsorted(sizes, n * d * step / _STEPS)) + 1 if step < _STEPS else len(order)
            part = order[done:upto]
            if len(part):
                hit = np.concatenate([self.postings[self.start[s]:self.end[s]] for s in part])
                length = (self.end - self.start)[part]
                total += np.bincount(hit, np.repeat(impact[part], length), n)
                seen += np.bincount(hit, minlength=n)
                done = max(done, upto)
            following = float(impact[order[done]]) if done < len(order) else 0.0
            bound = total + (d - seen) * following
            lead = rows[np.argpartition(-bound[rows], k)[:k]] if len(rows) > k else rows
            scores = self.x[lead] @ query
            threshold = scores.min() if len(lead) == k else -np.inf
            rows_left = np.flatnonzero(other & (bound >= threshold - _slack(bound)))
            if len(rows_left) <= limit or done >= len(order):
                break
        exact = self.x[rows_left] @ query
        best = np.lexsort((self.ids[rows_left], -exact))[:k]
        return self.ids[rows_left][best], exact[best]


def _slack(bound: np.ndarray) -> float:
    """What rounding of double sums may have taken off a bound; 0.5 for all ordinary vectors."""
    return 0.5 + float(np.abs(bound).max(initial=0)) * 2.0 ** -40


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows of ``integer_vectors`` where ``is_query`` holds."""
    ship_package(vectors.sparkSession)
    rows = written(vectors, "vectors")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    n_rows, n_asked = rows.count(), asked.count()
    blocks, chunks = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_asked // CHUNK_QUERIES))
    pick = lambda m, seed: F.pmod(F.xxhash64("vec_id", "vec", F.lit(seed)), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = rows.select(pick(blocks, 1).alias("block"), each(chunks).alias("chunk"), "vec_id", "vec")
    right = asked.select(each(blocks).alias("block"), pick(chunks, 2).alias("chunk"), "vec_id", "vec")

    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        got = []
        if len(candidates) and len(queries):
            width = max(max(map(len, candidates["vec"])), max(map(len, queries["vec"])))
            index = ImpactIndex(candidates["vec_id"].to_numpy(), _matrix(candidates["vec"], width))
            for own, q in zip(queries["vec_id"].tolist(), _matrix(queries["vec"], width)):
                ids, scores = index.search(own, q, k)
                got.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(got) if got else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    found = (left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
