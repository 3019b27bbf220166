"""Soft-membership mixing: domain posteriors, then document rates that meet target totals.

1. A classifier is fitted on a bounded sample of labelled rows (``Mix.sample`` documents at most, by
   the hash of id and text; an id's equal texts count once): presence of the ``Mix.vocabulary`` words per domain that stand out most
   by chi-square, and six shape measures, into a softmax regression.
2. One pass over all documents gives token counts and posteriors ``p``; they are written
   once. Nothing later reads texts to fit rates.
3. Distributed projected gradient: minimise ``|sum_d n_d r_d p_d - T|^2`` over rates
   ``0 <= r_d <= max_rate`` (no upper bound if None), in the metric weighted by the token
   counts, with the rates nearest to 1 where many are equally good. The gradient of a
   document is its posterior times one number a domain, so the steps add up to one
   multiplier a domain and a rate is the projection ``clip(1 - p m, 0, max_rate)``: a
   document's rate depends on its posterior alone, tasks keep no state, a lost executor
   loses nothing, and no join brings rates to rows. A step is scaled by ``sum n p p'`` over
   the documents not held by a bound, so a domain with a thousandth of the tokens moves as
   fast as any other. An iteration is one aggregate that tries ``TRIALS`` step lengths at
   once. It ends when every domain's equation holds to ``tolerance`` of its own mass or
   target; a target that rates within their bounds do not reach is logged, with what is
   reached, and stands in ``Rates.unmet``. Iterations that run out are an error.
4. Copies: ``floor(rate + u)`` with ``u`` in [0, 1) from the hash of id and text, so expected
   totals equal the fitted ones and reruns agree.

Defined results: null and empty texts have no tokens, the posterior of an empty text, and
a rate like any other; a null id is allowed; repeated rows are rated alike; label rows with
null labels or without a document are ignored; with no labelled row at all, or for a domain
without one, see ``fit_classifier``; an empty table gives an empty result; extra columns pass
through ``mix_rows`` untouched.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, written

_TABLE = bytes(32 if b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else b + 32 if 65 <= b <= 90 else b
               for b in range(256))
_SLICE_CHARS = 1 << 21
SHAPES = 6
#: Standard deviations by which a word's count in a domain must exceed its share to be a feature.
STANDS_OUT = 4.0
#: Step lengths that one aggregate tries: 1, 1/3, 1/9 and so on.
TRIALS = 14
#: Pull of the rates towards 1 against the squared misses, both as shares of the tokens: the
#: first round's, by which it falls from round to round, and the least.
PULL, PULL_FALLS, LEAST_PULL = 1e-2, 1e-1, 1e-9

_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Mix:
    """``weights``: target share of the tokens per domain; ``total``: tokens wanted, None for as
    many as there are, a domain's name for as many as are expected of it; ``sample``: labelled
    rows that the classifier may use; ``vocabulary``: words per domain; ``max_rate``: None for
    no upper bound; ``tolerance``: of every domain's own mass or target, whichever is larger."""

    weights: dict[str, float] = field(default_factory=dict)
    total: float | str | None = None
    sample: int = 8192
    vocabulary: int = 192
    max_rate: float | None = None
    max_iterations: int = 400
    tolerance: float = 1e-4

    @property
    def domains(self) -> list[str]:
        return sorted(self.weights)


@dataclass
class Classifier:
    words: dict[bytes, int]
    weights: np.ndarray  # (words + shapes + 1) x domains
    scale: np.ndarray  # of the shapes

    def posterior(self, hits: list[int], shapes: np.ndarray) -> np.ndarray:
        n = len(self.words)
        z = self.weights[hits].sum(axis=0) + (shapes * self.scale) @ self.weights[n:n + SHAPES] + self.weights[-1]
        z = np.exp(z - z.max())
        return z / z.sum()


def tokens_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def shapes_of(text: str, tokens: list[bytes], distinct: int) -> tuple[int, np.ndarray]:
    """Token count, and shares of symbols, exclamation marks, bars, capitals, repeats, and length."""
    spaced = len(text.split())
    chars = max(1, len(text))
    raw = text.encode()
    capitals = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return spaced, np.array([sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"<", b">"))) / chars,
                             raw.count(b"!") / chars, raw.count(b"|") / chars, capitals / chars,
                             1 - distinct / max(1, len(tokens)), np.log1p(spaced) / 10])


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list]]:
    texts = batch.column(column)
    start, size = 0, 0
    for i, n in enumerate(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()):
        size += n
        if size >= _SLICE_CHARS or i + 1 == batch.num_rows:
            yield start, texts.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0


def fit_classifier(docs: DataFrame, labels: DataFrame, domain: Column, mix: Mix, doc_id: str = "doc_id",
                   text: str = "text") -> Classifier:
    """``domain`` names, over the columns of ``labels``, the domain of a labelled row.

    A domain without a labelled row gets no mass; without any labelled row all domains get
    equal mass.
    """
    domains = mix.domains
    k = len(domains)
    ship_package(docs.sparkSession)
    chosen = (labels.select(F.col(doc_id).alias("_id"), domain.alias("_domain")).distinct()
              .where(F.col("_id").isNotNull() & F.col("_domain").isin(domains))
              .orderBy(F.xxhash64("_id"), "_id", "_domain").limit(mix.sample))
    held = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")
    # an id may stand in many rows: each of its texts counts once, and the bound is one of rows
    once = held.groupBy("_id", "_domain", F.xxhash64("text").alias("_key")).agg(F.first("text").alias("text"))
    rows = written(once.orderBy(F.xxhash64("_id", "_key"), "_id", "_domain", "_key").limit(mix.sample)
                   .select("_domain", "text").repartition(docs.sparkSession.sparkContext.defaultParallelism), "labelled")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _slices(batch, 1):
                names = batch.column(0).slice(start, len(texts)).to_pylist()
                sets = [set(tokens_of(t or "")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, s in zip(names, sets) for _ in s], pa.string()),
                     pa.array([w for s in sets for w in s], pa.binary())], ["domain", "word"])

    size = {r["_domain"]: r["count"] for r in rows.groupBy("_domain").count().collect()}
    total = max(1, sum(size.values()))
    seen = rows.mapInArrow(words, "domain string, word binary").groupBy("word").agg(
        F.count("*").alias("df"), *[F.sum((F.col("domain") == d).cast("long")).alias(f"in{i}") for i, d in enumerate(domains)])
    seen = written(seen.where("df >= 5"), "words")
    words_at: dict[bytes, int] = {}
    for i, d in enumerate(domains):
        expect = F.col("df") * F.lit(size.get(d, 0) / total)
        lift = F.col(f"in{i}") - expect
        top = seen.where((lift > 0) & (lift * lift > STANDS_OUT ** 2 * expect)).orderBy((lift * lift / expect).desc(), "word").limit(mix.vocabulary)
        for r in top.select("word").collect():
            words_at.setdefault(bytes(r["word"]), len(words_at))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _slices(batch, 1):
                out = [features_of(t, words_at) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array([h for _, h, _ in out], pa.list_(pa.int32())),
                     pa.array([s.tolist() for *_, s in out], pa.list_(pa.float64()))], ["domain", "hits", "shapes"])

    data = rows.mapInArrow(features, "domain string, hits array<int>, shapes array<double>").collect()
    n = len(words_at)
    weights = np.zeros((n + SHAPES + 1, k))
    scale = np.ones(SHAPES)
    if data:
        x = np.zeros((len(data), n + SHAPES + 1), np.float32)
        y = np.zeros((len(data), k), np.float32)
        for i, r in enumerate(data):
            x[i, r["hits"]] = 1
            x[i, n:n + SHAPES] = r["shapes"]
            y[i, domains.index(r["domain"])] = 1
        spread = x[:, n:n + SHAPES].std(axis=0)
        scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)
        x[:, n:n + SHAPES] *= scale
        x[:, -1] = 1
        weights = _softmax_regression(x, y)
        weights[-1, y.sum(axis=0) == 0] = -60.0
    return Classifier(words_at, weights, scale)


def features_of(text: str | None, words_at: dict[bytes, int]) -> tuple[int, list[int], np.ndarray]:
    text = text or ""
    tokens = tokens_of(text)
    distinct = set(tokens)
    count, shapes = shapes_of(text, tokens, len(distinct))
    return count, [words_at[w] for w in distinct & words_at.keys()], shapes


def _softmax_regression(x: np.ndarray, y: np.ndarray, steps: int = 400, decay: float = 1e-4) -> np.ndarray:
    """Adam on the mean log loss with a small ridge; the data fit in memory by the sample's bound."""
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = x @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ (z / z.sum(axis=1, keepdims=True) - y) / len(x) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w.astype(np.float64)


def with_posteriors(docs: DataFrame, model: Classifier, mix: Mix, text: str, out: str) -> DataFrame:
    """``docs`` plus a struct column ``out``: ``n`` tokens and the posterior array ``p``."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("struct<n: long, p: array<double>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            got = [features_of(t, model.words) for t in s]
            yield pd.DataFrame({"n": [n for n, *_ in got], "p": [model.posterior(h, f).tolist() for _, h, f in got]})

    return docs.withColumn(out, score(F.col(text)))


# ---------------------------------------------------------------- rates
@dataclass
class Rates:
    """The sum of the gradient steps, one multiplier a domain: all that a task needs for its rates."""

    max_rate: float | None
    multipliers: np.ndarray
    #: Domain to (tokens wanted, tokens reached) where the two differ by more than the tolerance.
    unmet: dict[str, tuple[float, float]] = field(default_factory=dict)

    def replay(self, p: np.ndarray) -> np.ndarray:
        return np.clip(1 - p @ self.multipliers, 0, self.max_rate)


def _trial(n: np.ndarray, p: np.ndarray, m: np.ndarray, max_rate: float | None) -> np.ndarray:
    """Sums of a part at the multipliers ``m``: domain totals, Gram matrix of the free documents, dual value."""
    y = 1 - p @ m
    r = np.clip(y, 0, max_rate)
    free = np.where((y > 0) & (y < (np.inf if max_rate is None else max_rate)), n, 0.0)
    return np.concatenate([(n * r) @ p, ((p * free[:, None]).T @ p).ravel(),
                           [(n * (r * (y - 1) - (r - 1) ** 2 / 2)).sum()]])


def fit_rates(scored: DataFrame, mix: Mix) -> Rates:
    """``scored``: columns ``n`` and ``p``. One small aggregate an iteration."""
    k = len(mix.domains)
    width = k + k * k + 1

    def sums(trials: list[np.ndarray]) -> np.ndarray:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
                p = np.asarray(batch.column(1).flatten()).reshape(len(n), k)
                cells = np.concatenate([_trial(n, p, m, mix.max_rate) for m in trials])
                yield pa.RecordBatch.from_arrays([pa.array([cells.tolist()])], ["s"])
        cells = scored.select("n", "p").mapInArrow(part, "s array<double>").select(F.posexplode("s").alias("i", "v"))
        got = {r["i"]: r["v"] for r in cells.groupBy("i").agg(F.sum("v").alias("v")).collect()}
        return np.array([got.get(i, 0.0) for i in range(width * len(trials))]).reshape(len(trials), width)

    m = np.zeros(k)
    start = scored.select(F.posexplode(F.transform("p", lambda x: x * F.col("n"))).alias("i", "v"))
    found = {r["i"]: r["v"] for r in start.groupBy("i").agg(F.sum("v").alias("v")).collect()}
    mass = np.array([found.get(i, 0.0) for i in range(k)])
    total = float(mass.sum())
    rates = Rates(mix.max_rate, m)
    if total <= 0:
        return rates
    wanted = np.array([mix.weights[d] for d in mix.domains], float)
    size = mass[mix.domains.index(mix.total)] if isinstance(mix.total, str) else total if mix.total is None else mix.total
    asked = wanted / wanted.sum() * size / total
    # a domain is not asked for more than it has at the largest rate: the others would stand in for it
    target = asked if mix.max_rate is None else np.minimum(asked, mix.max_rate * mass / total)
    scale = np.maximum(mass / total, target)
    least = max(LEAST_PULL, 1e-7 * scale[scale > 0].min())
    pull, now, left = PULL, sums([m])[0] / total, mix.max_iterations

    def slope(at: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return pull * at - cells[:k] + target

    def value(at: np.ndarray, cells: np.ndarray) -> float:
        return pull / 2 * at @ at + target @ at + cells[-1]

    def error(at: np.ndarray, cells: np.ndarray) -> float:
        return float((np.abs(slope(at, cells)) / np.maximum(scale, LEAST_PULL)).max())

    while True:
        settled = pull <= least
        while error(m, now) > (mix.tolerance if settled else 1e-2):
            if left <= 0:
                raise RuntimeError(f"rates are not settled after {mix.max_iterations} iterations: a domain's "
                                   f"equation misses by {error(m, now):.2g} of its mass or target")
            step = np.linalg.solve(now[k:-1].reshape(k, k) + pull * np.eye(k), -slope(m, now))
            trials = [m + step / 3 ** i for i in range(TRIALS)]
            tried = sums(trials) / total
            left -= 1
            best = min(range(TRIALS), key=lambda i: value(trials[i], tried[i]))
            if not value(trials[best], tried[best]) < value(m, now):  # too close for the value to tell
                best = min(range(TRIALS), key=lambda i: error(trials[i], tried[i]))
                if not error(trials[best], tried[best]) < error(m, now):  # as exact as the sums are
                    if error(m, now) <= 1e-4 or not settled:
                        break
                    left = 0
                    continue
            m, now = trials[best], tried[best]
        if settled:
            break
        pull = max(least, pull * PULL_FALLS)
    rates.multipliers = m
    missed = np.abs(now[:k] - asked) > max(mix.tolerance, 1e-9) * np.maximum(scale, asked)
    rates.unmet = {d: (float(asked[i] * total), float(now[i] * total)) for i, d in enumerate(mix.domains) if missed[i]}
    for d, (want, reached) in rates.unmet.items():
        _log.warning("mixture: %s is to have %.1f tokens and gets %.1f within the rates' bounds", d, want, reached)
    return rates


def _rate(rates: Rates, p: Column) -> Column:
    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(rates.replay(np.stack(s.to_numpy())) if len(s) else [], dtype=float)
    return rate(p)


def _draw(docs: DataFrame, doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text), F.lit(17)).alias("draw")


def _copies(rate: Column, draw: Column) -> Column:
    u = F.shiftrightunsigned(draw, 11).cast("double") / float(1 << 53)
    return F.floor(rate + u).cast("int")


def mixture(docs: DataFrame, labels: DataFrame, domain: Column, mix: Mix, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, p_<domain>..., rate, copies)`` of every document."""
    model = fit_classifier(docs, labels, domain, mix, doc_id, text)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _draw(docs, doc_id, text))
    scored = written(with_posteriors(slim, model, mix, "text", "s").select("doc_id", "draw", "s.n", "s.p"), "scored")
    rated = scored.withColumn("rate", _rate(fit_rates(scored, mix), F.col("p")))
    return rated.select("doc_id", F.col("n").alias("n_tokens"),
                        *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(mix.domains)],
                        "rate", _copies(F.col("rate"), F.col("draw")).alias("copies"))


def mix_rows(docs: DataFrame, labels: DataFrame, domain: Column, mix: Mix, doc_id: str = "doc_id",
             text: str = "text", max_copies: int | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says. ``max_copies`` is a bound of the fit,
    like ``max_rate``: no rate is cut after it."""
    if max_copies is not None:
        mix = replace(mix, max_rate=min(max_copies, np.inf if mix.max_rate is None else mix.max_rate))
    names = docs.columns
    model = fit_classifier(docs, labels, domain, mix, doc_id, text)
    if not model.weights.any():  # no labelled row: nothing tells one document from another
        return docs
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text).alias("text"),
                       _draw(docs, doc_id, text))
    scored = written(with_posteriors(held, model, mix, "text", "s").select("row", "draw", "s.n", "s.p"), "scored")
    rate = _rate(fit_rates(scored, mix), F.col("p"))
    counted = scored.withColumn("copies", _copies(rate, F.col("draw"))).where("copies > 0")
    if mix.max_rate is not None and mix.max_rate <= 1:
        return counted.select("row.*")
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def quality_domain() -> Column:
    """Domains of the table ``labels``: toxic, else clean or junk by its quality."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "junk")
