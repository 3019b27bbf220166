import math
import random

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as P
from lakeloom.llm import mixing, quality
from lakeloom.llm.sentencepiece_codec import PieceModel
from tests.llm.test_quality import brute as measures
from tests.llm.test_sentencepiece import lattice
from tests.llm.test_simhash import brute_groups, brute_print

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, near copies, junk, toxic words, nulls and repeated rows, and their labels."""
    rnd = random.Random(21)
    words = ["w%d" % i for i in range(3000)]
    rows, labels = [], []
    for i in range(1500):
        kind = rnd.choices(["clean", "junk", "toxic"], [8, 1, 1])[0]
        body = [rnd.choice(words) for _ in range(rnd.randint(15, 120))]
        if kind == "toxic":
            for _ in range(3):
                body.insert(rnd.randrange(len(body)), rnd.choice(["vile", "nasty", "foul"]))
        if kind == "junk":
            body = [w + "$$$" for w in body]
        rows.append((i, " ".join(body), "en", "src%d" % (i % 3), len(" ".join(body))))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    for i in range(60):  # copies, and copies with one word more
        t = rows[i][1]
        rows.append((2000 + i, t if i % 2 else t + " end", "en", "hot", None))
    rows += [(None, None, None, None, None), (3000, "", "en", "s", 0), (3001, "too short", "en", "s", 9), rows[5], rows[5],
             (3002, " ".join(f"again{i % 7}" for i in range(200)), "en", "s", 1)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(path + "/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(path + "/labels.parquet")
    return path, rows, labels


def test_stages_match_brute_force(spark, folder):
    path, rows, labels = folder
    # 1: quality
    good = {i for i, q, _ in labels if q == 1}
    held = [(r, measures(r[1]), r[0] in good) for r in rows if r[0] is not None and r[0] < 1500]
    passes = lambda m: m[0] >= 10 and 100 * m[5] <= 20 * m[0]
    share = {"symbol_share": lambda m: m[2] / m[1] if m[1] else 0, "dup_line_share": lambda m: m[4] / m[3] if m[3] else 0,
             "repeat_share": lambda m: m[5] / m[0] if m[0] else 0, "mean_word_chars": lambda m: m[1] / m[0] if m[0] else 0}
    tests, risk = sum(map(len, quality.GRIDS.values())), quality.Risk()
    unique = {(r[1], g): m for r, m, g in held if passes(m)}
    cuts = {}
    for rule, grid in quality.GRIDS.items():
        best = None
        for c in grid:
            n = sum(g for _, g in unique)
            k = sum(share[rule](m) > c for (_, g), m in unique.items() if g)
            gain = sum(share[rule](m) > c for (_, g), m in unique.items() if not g) - risk.clean_weight * k
            tail = sum(math.comb(n, j) * risk.alpha**j * (1 - risk.alpha)**(n - j) for j in range(k + 1))
            if gain > 0 and tail <= risk.delta / tests and (best is None or (gain, c) > best):
                best = (gain, c)
        cuts[rule] = best[1] if best else math.inf
    want = [r for r in rows if passes(measures(r[1])) and all(
        r[2] is None or share[x](measures(r[1])) <= cuts[x] for x in cuts)]
    assert any(c < math.inf for c in cuts.values())
    docs = spark.read.parquet(path + "/documents.parquet")
    kept = P.quality_rules(spark, docs, path)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
    # 2: near duplicates
    groups = brute_groups([r[0] for r in want], [brute_print(r[1]) for r in want])
    left = sorted({r for r, g in zip(want, groups) if r[0] == g}, key=str)
    single = P.simhash_near_dedup(spark, spark.createDataFrame(want, SCHEMA), path)
    assert single.columns == docs.columns
    assert sorted(map(tuple, single.collect()), key=str) == left
    # 3: mixing: every clean document stays, toxic ones go, nothing is repeated
    mixed = P.source_mixing(spark, spark.createDataFrame(left, SCHEMA), path)
    assert mixed.columns == docs.columns
    ids = [r.doc_id for r in mixed.collect()]
    toxic = {i for i, _, t in labels if t}
    assert len(ids) == len(set(ids)) and not set(ids) & toxic
    assert {r[0] for r in left} - toxic - set(ids) <= {r[0] for r in left if r[0] >= 1500}
    # 4: ids, and the whole run
    final = {r.doc_id: r.ids for r in P.run(spark, path).collect()}
    assert set(final) == set(ids)
    model = PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r[0]: r[1] for r in left}
    for i in rnd_some(ids):
        assert final[i] == lattice(texts[i], model) and model.decode(final[i]) == texts[i]


def rnd_some(ids):
    return random.Random(1).sample(sorted(ids), 25)


def test_each_stage_takes_empty_and_extra(spark, folder):
    path, *_ = folder
    extra = spark.createDataFrame([], SCHEMA + ", row string, kept int, fp long, s string")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, extra, path)
        assert out.columns == extra.columns and out.collect() == []
    assert P.STAGES[-1][1](spark, extra, path).collect() == []
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "source_mixing", "sentencepiece_ids"]


def test_mixture_keeps_clean_documents_of_uncertain_posterior(spark):
    """A few per cent of junk in the posteriors of clean documents neither drops them nor repeats any."""
    rng = np.random.default_rng(8)
    n, kind = rng.integers(10, 500, 4000), rng.choice(3, 4000, p=[0.9, 0.08, 0.02])
    off, other = rng.beta(1, 30, 4000), rng.random(4000)
    p = np.empty((4000, 3))
    for i in range(3):
        at, (a, b) = kind == i, [j for j in range(3) if j != i]
        p[at, i], p[at, a], p[at, b] = 1 - off[at], (off * other)[at], (off * (1 - other))[at]
    scored = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n long, p array<double>")
    r = mixing.fit_rates(scored, P.MIX).replay(p)
    drawn = np.minimum(r, 1)
    assert r.max() <= 1 and drawn[kind == 0].mean() > 0.998 and drawn[kind > 0].max() < 0.01
    assert (n * drawn) @ p[:, 0] > 0.99 * (n @ p[:, 0])
