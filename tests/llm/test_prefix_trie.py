import hashlib
import random
import zlib

import pytest

from lakeloom.llm import prefix_trie as T
from lakeloom.llm.queries import op11_prefix_trie

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def original(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1] or 0, t[2]))] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
    return out


def brute(convs):
    if not convs:
        return []
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        cost = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = cost + sum(saved[k] for k in kids)
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def planted(seed, n, common=0.4):
    rnd = random.Random(seed)
    beginnings = [[("user", f"q{i}"), ("assistant", f"réponse {i} " * 3)] for i in range(3)]
    rows = []
    for c in range(n):
        own = list(rnd.choice(beginnings)) if rnd.random() < common else []
        own += [(rnd.choice(["user", "assistant", None]), rnd.choice([None, "", "a", "b", "long " * 400, f"t{rnd.randint(0, 30)}"]))
                for _ in range(rnd.choice([0, 1, 2, 3, 9, 12]))]
        if rnd.random() < 0.25:
            own = [("user", "same"), ("assistant", "same")]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(own)]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' as pos", "1 as a", "2 as size")


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, n)
    spark.conf.set(key, before)


@pytest.mark.parametrize("seed,batch,block", [(1, 10_000, 64), (2, 7, 64), (3, 5, 3), (4, 50, 1)])
def test_matches_brute_force(spark, small_batches, monkeypatch, seed, batch, block):
    monkeypatch.setattr(T, "PIECE", 3)
    small_batches(batch)
    rows = planted(seed, 130)
    rows += [(None, 0, "user", "lost"), (500, None, "user", "first"), (500, 0, "user", "second"), (500, 0, "user", "second"),
             (-3, 1, "user", "below zero"), (-5, 1, "x", "base below zero"), (501, 7, "user", "only")]
    got = T.prefix_trie(*T.branched(T.numbered_turns(frame(spark, rows))), block=block)
    assert got.columns == NAMES
    out = sorted((tuple(r) for r in got.collect()), key=str)
    assert out == brute(rebuilt(original(rows)))


def test_query(spark, tmp_path):
    rows = planted(9, 300)
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    out = sorted((tuple(r) for r in op11_prefix_trie(spark, str(tmp_path)).collect()), key=str)
    assert out == brute(rebuilt(original(rows))) and any(r[6] for r in out)


def test_one_conversation_over_many_tasks(spark, small_batches):
    small_batches(16)
    rows = [(7, i, "user", f"turn {i % 50}") for i in range(700)] + [(c, i, "user", f"turn {i % 50}") for c in (8, 9) for i in range(300)]
    numbered = T.numbered_turns(frame(spark, rows).repartition(6))
    assert sorted((r["conv_id"], r["pos"]) for r in numbered.collect()) == sorted((c, i) for c, i, _, _ in rows)
    lengths = numbered.groupBy("conv_id").count().withColumnRenamed("count", "length")
    out = sorted((tuple(r) for r in T.prefix_trie(numbered, lengths, block=16).collect()), key=str)
    assert out == brute({c: tuple(t) for c, t in original(rows).items()})


def test_copies_of_one_conversation_and_none(spark, small_batches):
    small_batches(20)
    rows = [(c, i, "user", "é" * (i + 1)) for c in range(300) for i in range(3)]
    numbered = T.numbered_turns(frame(spark, rows))
    lengths = numbered.groupBy("conv_id").count().withColumnRenamed("count", "length")
    out = sorted((tuple(r) for r in T.prefix_trie(numbered, lengths).collect()), key=str)
    assert out == brute({c: tuple(t) for c, t in original(rows).items()})
    assert T.prefix_trie(*T.branched(T.numbered_turns(frame(spark, [])))).collect() == []
    assert T.prefix_trie(*T.branched(T.numbered_turns(frame(spark, [(None, 1, "user", "x")])))).collect() == []
