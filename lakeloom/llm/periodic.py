"""Runs of periodic words in texts: recursive frequency splitting, then a scan of lags.

A run is a stretch of consecutive words with smallest period ``q`` and a length of at least
``max(min_length, min_repeats * q)`` that no neighbouring word extends with that period.

1. Splitting. Each word of a run occurs ``min_repeats`` times in it, so a word that occurs
   less often within its segment stands in no run: it splits the segment. Parts shorter
   than ``min_length`` hold no run either. What is left is counted and split again until
   nothing changes. A text whose segments shrink by few words a round ends after ``ROUNDS``:
   the scan is exact on any split, the splitting only saves it work.
2. Lag scan, per octave of periods. For ``q`` in ``(m / 2, m]`` the lag of a position is the
   distance to the next place with the same ``m`` words (places of a repetition numbered by
   doubling: ``2 m`` words are a pair of ``m`` words). Within a run of smallest period ``q <= m``
   that lag is ``q`` and nothing else, as a nearer equal place would give the run a shorter
   period; and a stretch of one lag ``q`` is all of its run. ``q + m < 3 q``, so every run shows
   such a position. Hence stretches of one lag are the runs, and the scan is ``O(n log n)`` a
   text, also where a text is one run of many thousand words.

A text is handled within its own row; nothing is shuffled or collected.

Defined results: null, empty and blank texts have no words, no run and the empty collapsed
text; a null id is allowed; repeated rows are handled row by row; very long texts are
scanned whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, free_name, ship_package

ROUNDS = 64
_SLICE = 256


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, from 0 without gaps."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def surviving_segments(ids: np.ndarray, min_length: int, min_repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, segment) of the words that the splitting leaves, in text order."""
    at = np.arange(len(ids))
    if len(ids) < min_length:
        return at[:0], at[:0]
    segment = np.zeros(len(ids), np.int64)
    width = int(ids.max()) + 1
    for _ in range(ROUNDS):
        key = segment * width + ids[at]
        if len(at) * 4 > (int(segment[-1]) + 1) * width:  # few possible keys: count without sorting
            often = np.bincount(key)[key] >= min_repeats
        else:
            _, place, count = np.unique(key, return_inverse=True, return_counts=True)
            often = count[place] >= min_repeats
        if often.all():
            break
        at = at[often]
        if not len(at):
            return at, at
        segment = np.r_[0, np.cumsum(np.diff(at) != 1)]
        at = at[np.bincount(segment)[segment] >= min_length]
        if not len(at):
            return at, at
        segment = np.r_[0, np.cumsum(np.diff(at) != 1)]
    return at, segment


def _doubled(ids: np.ndarray, m: int) -> np.ndarray:
    """Numbers of the stretches of ``2 m`` from those of the stretches of ``m``."""
    left, right = ids[:-m], ids[m:]
    return np.unique(left * (int(ids.max()) + 1) + right, return_inverse=True)[1]


def _next_lag(ids: np.ndarray) -> np.ndarray:
    """Distance to the next equal number, 0 if there is none."""
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    lag = np.zeros(len(ids), np.int64)
    lag[order[:-1][same]] = np.diff(order)[same]
    return lag


def find_runs(ids: np.ndarray, min_length: int = 24, min_repeats: int = 3) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs of a sequence of numbers, by start, then period."""
    at, segment = surviving_segments(ids, min_length, min_repeats)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    # the segments in one array, kept apart by numbers that occur once
    place = np.arange(len(at)) + segment
    line = np.arange(place[-1] + 1) + int(ids.max()) + 1
    line[place] = ids[at]
    home = np.zeros(len(line), np.int64)
    home[place] = at
    grams = np.unique(line, return_inverse=True)[1]
    longest = int(np.bincount(segment).max())
    m, first, found = 1, True, []
    while 4 * m <= min_length and 2 * m <= len(grams):
        grams, m = _doubled(grams, m), 2 * m
    while True:
        lag = _next_lag(grams)
        lag[(lag > m) | (lag <= (0 if first else m // 2))] = 0
        edge = np.flatnonzero(np.r_[True, lag[1:] != lag[:-1]])
        size = np.diff(np.r_[edge, len(lag)])
        q = lag[edge]
        length = size - 1 + q + m
        good = (q > 0) & (length >= np.maximum(min_length, min_repeats * q))
        found.append(np.stack([home[edge[good]], length[good], q[good]], axis=1))
        first = False
        if min_repeats * (m + 1) > longest or 2 * m > len(grams):
            break
        grams, m = _doubled(grams, m), 2 * m
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """False for the words of a run after its first period."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(cover[:n]) == 0


def _runs_of(text: str | None, min_length: int, min_repeats: int) -> tuple[int, np.ndarray, bytes]:
    words = (text or "").encode().split()
    none = np.zeros((0, 3), np.int64)
    runs = find_runs(word_numbers(words), min_length, min_repeats) if len(words) >= min_length else none
    kept = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))] if len(runs) else words
    return len(words), runs, b" ".join(kept)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 24,
                  min_repeats: int = 3) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every row: ``runs`` holds ``start, length, period``
    by start, then period; ``collapsed`` is the text without the repeats, its words joined by a space."""
    if min_repeats < 3 or min_length < 2:
        raise ValueError("min_repeats must be 3 and min_length 2 at least")
    ship_package(docs.sparkSession)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, _SLICE):
                part = batch.slice(s, _SLICE)
                got = [_runs_of(t.as_py(), min_length, min_repeats) for t in part.column(1)]
                runs = np.concatenate([r for _, r, _ in got])
                spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, c])) for c in range(3)],
                                                   ["start", "length", "period"])
                ends = pa.array(np.cumsum([0] + [len(r) for _, r, _ in got]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([n for n, _, _ in got], pa.int64()), pa.ListArray.from_arrays(ends, spans),
                     pa.array([c for _, _, c in got], pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return slim.mapInArrow(rows, schema)


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; of equals the first. Null if there is none."""
    return F.aggregate(runs, F.get(runs, 0), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def repeat_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repetitions made from their own words in a tenth of the texts.

    ``h`` is the CRC-32 of the decimal id and ``g = h div 10``. If ``h % 10 = 0``, word ``i >= a`` of ``n``
    becomes word ``a + (i - a) % p``, with ``a = g % n`` and ``p = 1 + floor((n - a) / (3 + g % 8))``; the words
    are then joined by a space. A null id and a text without words stay as they are.
    """
    names = docs.columns
    h, w, g, a, p = (free_name(docs, x) for x in ("_h", "_words", "_g", "_a", "_p"))
    col = lambda c: F.col(f"`{c}`")
    picked = docs.withColumn(h, F.crc32(col(doc_id).cast("string").cast("binary")))
    words = F.array_remove(F.split(F.coalesce(col(text), F.lit("")), ASCII_SPACE), "")
    picked = picked.withColumn(w, F.when(col(h) % 10 == 0, words)).withColumn(g, F.floor(col(h) / 10))
    n = F.size(col(w))
    picked = picked.withColumn(a, F.when(n > 0, col(g) % n)).withColumn(
        p, (1 + F.floor((n - col(a)) / (3 + col(g) % 8))).cast("long"))
    turned = F.transform(col(w), lambda x, i: F.when(i < col(a), x).otherwise(
        F.get(col(w), (col(a) + (i - col(a)) % col(p)).cast("int"))))
    new = F.when(n > 0, F.array_join(turned, " ")).otherwise(col(text))
    return picked.withColumn(text, new).select(*[col(c) for c in names])
