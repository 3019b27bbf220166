import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {p + j for v in seen.values() if len(v) > 1 for p in v for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines), len(lines) - len(set(lines)), len(covered))


def texts():
    rnd = random.Random(5)
    out = [None, "", " ", "\n\n", "a", "a b c d e a b c d e", "a a a a a a a", "x\x0by\x0cz\r\nq r\u0085s t",
           "#*$%&|<> ##", "é ü\né ü\n é ü\n\té ü", "\U0001f600 \U0001f600" * 9, "tail \n", "\n lead"]
    for _ in range(120):
        alphabet = ["a", "b", "c"][: rnd.randint(1, 3)] + ["|", "wörd"]
        out.append("".join(rnd.choice(alphabet) + rnd.choice([" ", "  ", "\n", "\t"]) for _ in range(rnd.randint(1, 80))))
    out.append(" ".join(str(i % 9000) for i in range(30_000)))
    return out


def test_measures_match_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("measures", F.lit("clash"))
    got = Q.with_measures(df)
    name = [c for c in got.columns if c.startswith("measures") and c != "measures"][0]
    got = {r["id"]: tuple(r[name]) for r in got.select("id", name).collect()}
    for i, t in rows:
        assert got[i] == brute(t), (i, t and t[:60])


def test_binomial_cdf(spark):
    cases = [(n, k, p) for n in (1, 5, 40, 400, 3000) for k in (0, 1, 2, 7, 25) for p in (0.01, 0.05, 0.3) if k <= n]
    for p in (0.01, 0.05, 0.3):
        mine = [c for c in cases if c[2] == p]
        df = spark.createDataFrame([(n, k) for n, k, _ in mine], "n long, k long")
        got = {(r.n, r.k): r.c for r in df.select("n", "k", Q.binomial_cdf(F.col("n"), F.col("k"), p).alias("c")).collect()}
        for n, k, _ in mine:
            want = sum(math.comb(n, j) * p**j * (1 - p)**(n - j) for j in range(k + 1))
            if k >= n * p:
                assert got[n, k] == 1.0
            else:
                assert want * (1 - 1e-6) <= got[n, k] <= want * 1.001 + 1e-12, (n, k, p)


def make(n, bad_every=5, lang="en", start=0):
    rnd = random.Random(n + start)
    rows = []
    for i in range(n):
        words = ["w%d" % rnd.randint(0, 10**6) for _ in range(30)]
        if i % bad_every == 0:
            words = [w + "***" for w in words]
        rows.append((start + i, " ".join(words), lang, "src", 1))
    return rows


def test_cutoffs_certify_only_with_enough_evidence(spark):
    rows = make(3000) + make(60, lang="fr", start=10_000) + make(30, lang=None, start=20_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(r[0], int("***" not in r[1]), 0) for r in rows], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in Q.quality_report(docs, labels).collect()}
    assert len(out) == len(rows)
    for i, t, lang, *_ in rows:  # only the large stratum has enough good rows for a certificate
        assert out[i].kept == (lang != "en" or "***" not in t), i
    kept = Q.quality_filter(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.kept}


def test_copies_count_once(spark):
    """A thousand copies of one good text are one draw, so they certify nothing."""
    rows = [(i, " ".join("w%d" % j for j in range(20)), "en") for i in range(2000)]
    rows += [(5000 + i, " ".join("%d***" % (i * 50 + j) for j in range(20)), "en") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 5000)) for r in rows], "doc_id long, quality int")
    assert all(r.kept for r in Q.quality_report(docs, labels).collect())


@pytest.mark.parametrize("empty", ["docs", "labels"])
def test_empty_and_null_rows(spark, empty):
    schema = "doc_id long, text string, lang string, measures int, kept int"
    rows = [] if empty == "docs" else [(None, None, None, 1, 2), (1, "", "en", None, None), (1, "", "en", None, None)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([] if empty == "labels" else [(1, None), (None, 1), (7, 1)], "doc_id long, quality int")
    out = Q.quality_report(docs, labels).collect()
    assert len(out) == len(rows) and all(r.base_failed and not r.kept for r in out)
    assert Q.quality_filter(docs, labels).columns == docs.columns
