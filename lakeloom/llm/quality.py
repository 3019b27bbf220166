"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Two layers decide on a document:

1. base rules: fewer than 10 words, or over 20 % of the words inside repeated 5-word windows;
2. calibrated rules: per stratum, a cutoff on each measure of ``GRIDS``. A labelled
   holdout gives, for every cutoff of the fixed grid, the number ``k`` of the ``n`` good
   documents that it would reject. The cutoff is certified when the exact binomial test
   ``P(Bin(n, alpha) <= k) <= delta / m`` holds, ``m`` being the number of all tests
   (strata x rules x cutoffs, Bonferroni). With probability ``1 - delta`` at least, every
   certified cutoff then rejects at most a share ``alpha`` of the good documents of its
   stratum. Of the certified cutoffs the one with the best gain is taken: bad documents
   rejected less ``clean_weight`` times the good ones. A rule without a certified cutoff
   of positive gain rejects nothing in that stratum.

The grids are constants, so nothing is fitted on the holdout but the choice that the
correction covers. Copies of one text count once in the holdout: they are no independent
draws.

Defined results: a null or empty text has no words, so ``base_failed`` is true; null
strata form a stratum of their own; documents without a label are judged by the cutoffs
of their stratum; a label row without a document, or with a null label, is ignored;
repeated rows and equal ids are judged row by row; an empty table gives an empty result;
extra columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, free_name, stable_key, written

#: Measures (higher is worse) and their candidate cutoffs: a document is rejected above the cutoff.
GRIDS = {
    "symbol_share": [0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.12, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5],
    "dup_line_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8],
    "repeat_share": [0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.08, 0.1, 0.12, 0.14, 0.16, 0.18],
    "mean_word_chars": [7.0, 8.0, 9.0, 10.0, 11.0, 12.0, 14.0, 16.0, 20.0, 30.0],
}

#: A cutoff table of at most so many strata (five numbers each) is broadcast.
BROADCAST_STRATA = 10_000

_SERIES_TERMS = 4096
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Risk:
    """``alpha``: largest share of good documents that one rule may reject in a stratum;
    ``delta``: probability that any certified cutoff breaks that; ``clean_weight``: bad
    documents that must fall for each good one."""

    alpha: float = 0.01
    delta: float = 0.05
    clean_weight: float = 20.0


def with_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus one struct column ``measures``: counts of words, symbols, lines and repeats.

    Staged projections: each array is built once per row and read by name afterwards.
    """
    m, w, h, ln = (free_name(df, x) for x in ("measures", "_words", "_windows", "_lines"))
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, ASCII_SPACE), "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df1 = df.withColumn(w, words).withColumn(ln, lines)
    wc = F.col(w)
    window = lambda i: F.xxhash64(*[F.get(wc, i + j) for j in range(5)])
    hashes = F.when(F.size(wc) >= 5, F.transform(F.sequence(F.lit(0), F.size(wc) - 5), window)).otherwise(
        F.array().cast("array<bigint>"))
    df2 = df1.withColumn(h, hashes)
    hc, lc = F.col(h), F.col(ln)
    long = lambda c: c.cast("bigint")
    out = df2.withColumn(m, F.struct(
        long(F.size(wc)).alias("n_words"),
        long(F.length(F.array_join(wc, ""))).alias("word_chars"),
        long(F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", ""))).alias("n_symbols"),
        long(F.size(lc)).alias("n_lines"),
        long(F.size(lc) - F.size(F.array_distinct(lc))).alias("n_dup_lines"),
        long(F.when(F.size(F.array_distinct(hc)) == F.size(hc), F.lit(0)).otherwise(_covered(hc)))
        .alias("n_repeat_words")))
    return out.drop(w, h, ln)


def _covered(hashes: Column) -> Column:
    """Words inside the 5-word windows whose hash occurs twice or more.

    Windows are sorted by (hash, position); those equal to a neighbour repeat. Their
    positions, sorted, each cover five words or as many as lie before the next one.
    """
    ordered = F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.aggregate(
        F.array(ordered), F.lit(0),
        lambda total, o: total + F.aggregate(
            F.array(F.array_sort(F.transform(
                F.filter(o, lambda s, j: (s["h"] == F.get(o, j - 1)["h"]) | (s["h"] == F.get(o, j + 1)["h"])),
                lambda s: s["i"]))),
            F.lit(0),
            lambda t, p: t + F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(p, j + 1) - x, F.lit(5)))),
                F.lit(0), lambda a, b: a + b)))


def _shares(m: Column) -> dict[str, Column]:
    over = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return {
        "symbol_share": over(m["n_symbols"], m["word_chars"]),
        "dup_line_share": over(m["n_dup_lines"], m["n_lines"]),
        "repeat_share": over(m["n_repeat_words"], m["n_words"]),
        "mean_word_chars": over(m["word_chars"], m["n_words"]),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (m["n_repeat_words"] * 100 > m["n_words"] * 20)


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 10, stepped down by ten."""
    y = x + 10.0
    series = ((y - 0.5) * F.log(y) - y + 0.9189385332046727
              + 1.0 / (12.0 * y) - 1.0 / (360.0 * y * y * y) + 1.0 / (1260.0 * F.pow(y, F.lit(5.0))))
    down = F.log(x)
    for j in range(1, 10):
        down = down + F.log(x + float(j))
    return series - down


def binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """An upper bound of P(Bin(n, p) <= k), exact up to rounding for k below 4096.

    Sums the terms from k downwards; they fall faster than a geometric series as long as
    k < n p, so what lies beyond the last term summed is bounded by that series. 1.0 where
    k >= n p: no certificate is possible there.
    """
    nd, kd = n.cast("double"), k.cast("double")
    log_top = (_log_gamma(nd + 1.0) - _log_gamma(kd + 1.0) - _log_gamma(nd - kd + 1.0)
               + kd * F.log(F.lit(p)) + (nd - kd) * F.log(F.lit(1.0 - p)))
    odds = (1.0 - p) / p
    fall = lambda j: j * odds / (nd - j + 1.0)  # noqa: E731  P(j - 1) / P(j)
    steps = F.sequence(F.lit(0), F.least(k.cast("int"), F.lit(_SERIES_TERMS)))
    acc = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda a, i: F.struct((a["t"] * fall(kd - i)).alias("t"), (a["s"] + a["t"]).alias("s")))
    last = F.greatest(kd - _SERIES_TERMS - 1.0, F.lit(0.0))
    bound = F.exp(log_top) * (acc["s"] + acc["t"] / (1.0 - F.least(fall(last), F.lit(0.999999))))
    return F.when(kd >= nd * p, F.lit(1.0)).otherwise(F.least(bound, F.lit(1.0)))


def _cutoffs_below(value: Column, rule: str) -> Column:
    return F.size(F.filter(F.array(*[F.lit(c) for c in GRIDS[rule]]), lambda c: value > c))


def fit_cutoffs(measured: DataFrame, labels: DataFrame, risk: Risk = Risk(), doc_id: str = "doc_id",
                stratum: str = "lang", good: str = "quality", text_key: str | None = None) -> DataFrame:
    """One row per stratum: ``stratum`` (key string) and a nullable cutoff column per rule.

    ``measured`` needs the id, the stratum, ``measures`` and optionally ``text_key``, a
    hash by which copies of one text count once. ``labels`` holds 1 for good, 0 for bad.
    """
    lab = labels.select(F.col(doc_id).alias("_id"), F.col(good).alias("_good")).where(
        F.col("_good").isNotNull() & F.col("_id").isNotNull())
    cols = [F.col(doc_id).alias("_id"), stable_key(F.col(stratum).alias("s")).alias("stratum"),
            F.col("measures").alias("m")]
    cols.append((F.col(text_key) if text_key else F.xxhash64("measures")).alias("_copy"))
    held = (measured.select(*cols).where(~base_failed(F.col("m"))).join(lab, "_id")
            .groupBy("stratum", "_copy", (F.col("_good") == 1).alias("good")).agg(F.first("m").alias("m")))
    shares = _shares(F.col("m"))
    levels = [F.struct(F.lit(r).alias("rule"), _cutoffs_below(shares[r], r).alias("level")) for r in GRIDS]
    tally = (held.select("stratum", "good", F.explode(F.array(*levels)).alias("x"))
             .groupBy("stratum", "x.rule", "x.level")
             .agg(F.sum(F.col("good").cast("bigint")).alias("g"), F.sum((~F.col("good")).cast("bigint")).alias("b")))
    n_strata = tally.select("stratum").distinct().count()
    tests = max(1, n_strata) * sum(len(v) for v in GRIDS.values())
    grid = F.create_map(*[x for r, v in GRIDS.items() for x in (F.lit(r), F.array(*[F.lit(c) for c in v]))])
    per_rule = tally.groupBy("stratum", "rule").agg(  # at most one entry per level of the grid
        F.collect_list(F.struct("level", "g", "b")).alias("t"), F.sum("g").alias("n"))

    def above(field: str) -> Column:  # rows over the j-th cutoff
        return F.aggregate(F.filter(F.col("t"), lambda x: x["level"] > F.col("j")), F.lit(0).cast("bigint"),
                           lambda a, x: a + x[field])

    cand = per_rule.select("stratum", "rule", "n", F.posexplode(F.element_at(grid, F.col("rule"))).alias("j", "cutoff"),
                           "t")
    cand = cand.withColumn("k", above("g")).withColumn("caught", above("b"))
    cand = cand.withColumn("gain", F.col("caught") - F.col("k") * F.lit(risk.clean_weight))
    sure = cand.where((F.col("gain") > 0) & (binomial_cdf(F.col("n"), F.col("k"), risk.alpha) <= risk.delta / tests))
    best = sure.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "cutoff")).alias("b"))
    out = best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("b.cutoff"))).alias(r) for r in GRIDS])
    return F.broadcast(out) if n_strata <= BROADCAST_STRATA else out


def apply_rules(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` plus ``base_failed``, ``failed_rules`` (comma-joined names) and ``kept``."""
    key, cut = free_name(measured, "_stratum"), free_name(measured, "_cutoffs")
    side = cutoffs.select(F.col("stratum").alias(key), F.struct(*GRIDS).alias(cut))
    both = measured.withColumn(key, stable_key(F.col(stratum).alias("s"))).join(side, key, "left")
    shares = _shares(F.col("measures"))
    over = [F.when(shares[r] > F.col(cut)[r], F.lit(r)) for r in GRIDS]
    out = both.withColumn("base_failed", base_failed(F.col("measures"))).withColumn(
        "failed_rules", F.concat_ws(",", *over))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")).drop(key, cut)


def quality_report(docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), doc_id: str = "doc_id",
                   text: str = "text", stratum: str = "lang") -> DataFrame:
    """Id, the measures, ``base_failed``, ``failed_rules`` and ``kept`` of every document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("lang"), F.col(text).alias("text"))
    measured = written(with_measures(slim).select(
        "doc_id", "lang", "measures", F.xxhash64("text").alias("copy")), "quality")
    ruled = apply_rules(measured, fit_cutoffs(measured, labels, risk, text_key="copy"))
    return ruled.select("doc_id", *[F.col("measures")[m].alias(m) for m in _MEASURES],
                        "base_failed", "failed_rules", "kept")


def quality_filter(docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), doc_id: str = "doc_id",
                   text: str = "text", stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they came.

    The measured rows are written once with their texts; the calibration then reads only
    the measures, the filter reads the whole rows.
    """
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(doc_id).alias("doc_id"),
                       F.col(stratum).alias("lang"), F.col(text).alias("text"))
    measured = written(with_measures(held).withColumn("copy", F.xxhash64("text")).drop("text"), "quality")
    ruled = apply_rules(measured, fit_cutoffs(measured, labels, risk, text_key="copy"))
    return ruled.where("kept").select("row.*")
