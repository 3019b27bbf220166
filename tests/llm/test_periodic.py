import hashlib
import zlib

import numpy as np
import pytest

from lakeloom.llm import periodic as P


def smallest_period(x):
    return next(q for q in range(1, len(x) + 1) if all(x[i] == x[i - q] for i in range(q, len(x))))


def brute(x, min_length, reps):
    """All runs by definition: every stretch that its lag allows and no neighbour extends."""
    n, out = len(x), []
    for q in range(1, n // reps + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, reps * q) and smallest_period(x[i:i + length]) == q:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in drop]


@pytest.mark.parametrize("min_length,reps", [(24, 3), (6, 3), (10, 4), (2, 3)])
def test_runs_match_the_definition(min_length, reps):
    rng = np.random.default_rng(min_length * 10 + reps)
    for case in range(250):
        parts = []
        for _ in range(rng.integers(1, 5)):
            unit = rng.integers(0, int(rng.integers(2, 30)), int(rng.integers(1, 30))).tolist()
            parts += unit * int(rng.integers(1, 7)) + unit[:int(rng.integers(0, len(unit) + 1))]
        x = parts[:220]
        runs = P.find_runs(np.unique(x, return_inverse=True)[1], min_length, reps)
        assert [tuple(r) for r in runs.tolist()] == brute(x, min_length, reps), x
        kept = P.kept_words(len(x), runs)
        assert [v for v, k in zip(x, kept) if k] == collapsed(x, brute(x, min_length, reps))


def test_splitting_keeps_every_run_and_drops_the_rest():
    rng = np.random.default_rng(1)
    plain = rng.integers(100, 10_000, 3000)
    x = np.r_[plain[:1500], np.tile(np.arange(10), 5), plain[1500:]]
    at, segment = P.surviving_segments(np.unique(x, return_inverse=True)[1], 24, 3)
    assert set(range(1500, 1550)) <= set(at.tolist()) and len(at) < 60 and segment.max() == 0
    # a word that is rare only within its part: the parts are counted again
    y = np.array([9, *range(20), 9, *range(100, 120), 9, *range(200, 220)] + [1, 2] * 15)
    at, _ = P.surviving_segments(np.unique(y, return_inverse=True)[1], 24, 3)
    assert at.tolist() == list(range(len(y) - 30, len(y)))


def test_long_text_of_one_run_and_slow_splits():
    unit = np.random.default_rng(2).integers(0, 50_000, 70_000)
    x = np.unique(np.tile(unit, 4), return_inverse=True)[1]
    assert P.find_runs(x).tolist() == [[0, 280_000, 70_000]]
    # every round splits one word off: the rounds end, the runs are found all the same
    chain = []
    for i in range(300):
        chain += [i] + [1000 + i, 1000 + i, i + 1]
    x = np.array(chain + [5000, 5001] * 20)
    ids = np.unique(x, return_inverse=True)[1]
    assert [tuple(r) for r in P.find_runs(ids).tolist()] == brute(ids.tolist(), 24, 3)


def rewritten(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = rewritten(doc_id, text)
    runs = brute(words, 24, 3)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(collapsed(words, runs))))


def test_query_matches_brute_force(spark, tmp_path):
    from lakeloom.llm.queries import op13_periodic_runs

    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}é" for i in range(400)] + ["#", "a b", " "]
    rows = []
    for i in range(160):
        n = int(rng.integers(0, 180))
        words = rng.choice(vocabulary, n).tolist()
        if i % 3 == 0:
            words += words[:5] * 6 + ["x"] * 30
        rows.append((i * 7, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(None, "a b " * 20), (1, None), (2, ""), (3, " \n\t "), (4, "only"), (5, "z " * 24), (6, "z " * 23),
             (8, "\x0b".join("abc" * 9)), (-10, "k l m " * 9), (rows[0][0], rows[0][1]), (9, "p q " * 12 + "r " * 24)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' as _h", "1 as runs").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert any(r[1] for r in got.collect())


def test_empty_table_and_parameters(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert P.periodic_runs(none).collect() == []
    with pytest.raises(ValueError):
        P.periodic_runs(none, min_repeats=2)
    got = P.periodic_runs(spark.createDataFrame([("k", "a b a b a b c")], "id string, body string"), "id", "body", 5).first()
    assert (got["doc_id"], got["collapsed"]) == ("k", "a b c") and [tuple(r) for r in got["runs"]] == [(0, 6, 2)]
