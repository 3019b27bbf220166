import random
import re

from pyspark.sql import functions as F

from lakeloom.llm import chat as C

ATTR = re.compile(r"(?i)^\s*(on\b.{1,300}\bwrote|le\b.{1,300}\ba écrit|am\b.{1,300}\bschrieb|el\b.{1,300}\bescribió)\s*:\s*$")


def parse(text):
    lines = re.split(r"\r?\n", text) if text else []
    out = []
    for x in lines:
        m = re.match(r"^((?:[ \t]*>)+)", x)
        out.append([m[1].count(">") if m else 0, re.sub(r"[ \t\n\x0b\f\r]+", " ", x[m.end():] if m else x).strip(" ").lower(), x])
    for i, x in enumerate(out):
        if x[0] == 0 and ATTR.match(x[2]) and i + 1 < len(out) and out[i + 1][0] > 0:
            x[0] = -1
    runs = []
    for i, x in enumerate(out):
        if i == 0 or x[0] != out[i - 1][0]:
            runs.append((x[0], []))
        if x[1]:
            runs[-1][1].append(x[1])
    return "\n".join(x[2] for x in out if x[0] == 0).strip(" \t\r\n"), runs


def brute(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r)
    info = {r: parse(r[3]) for r in rows}
    scopes = {}
    for r in rows:
        scopes.setdefault(r[0], set()).add(r)
    res = {}
    for scope, msgs in scopes.items():
        parent = {}
        for r in msgs:
            quoted = [(lv, ls) for lv, ls in info[r][1] if lv > 0 and ls]
            outer = min((lv for lv, _ in quoted), default=0)
            weight, units, before = {}, 0, []
            for o in msgs:  # earlier by turn; ties are avoided in the data
                if o is not r and key(o)[:2] < key(r)[:2]:
                    own = [ls for lv, ls in info[o][1] if lv == 0 and ls]
                    have = {"\n".join(sum(own, []))} | {"\n".join(x) for x in own} | {x for ls in own for x in ls}
                    before.append((key(o)[:2], o, have if own else set()))
            before.sort(key=lambda b: b[0])
            for lv, ls in quoted:
                todo = [("\n".join(ls), 2 * len("\n".join(ls)) + 1)] if len(ls) > 1 else []
                for unit, w in todo + [(x, len(x)) for x in ls]:
                    latest = next((o for _, o, have in reversed(before) if unit in have), None)
                    if latest is not None:
                        units += 1
                        weight[latest] = weight.get(latest, 0) + (w if lv == outer else 0)
            best = max(weight, key=lambda o: (weight[o], key(o)[:2]), default=None)
            parent[r] = best if best is not None and weight[best] > 0 else None
            res[r] = [units, sum(len(ls) for _, ls in quoted)]
        for r in msgs:
            depth, at = 0, r
            while parent[at]:
                depth, at = depth + 1, parent[at]
            res[r] += [depth, at[1], parent[r][1] if parent[r] else None, info[r][0]]
    return res


def test_matches_brute_force(spark):
    rnd = random.Random(12)
    pool = [f"line {i} of text" for i in range(60)] + ["thanks"] * 30
    rows = []
    for conv in [*range(60), None]:  # enough for chains of answers under the latest-writer rule
        said = []
        for turn in range(rnd.randint(1, 9)):
            parts = []
            if said and rnd.random() < 0.8:
                src = rnd.choice(said).split("\n")
                if rnd.random() < 0.5:
                    a = rnd.randrange(len(src))
                    src = src[a:a + rnd.randint(1, 3)]
                rnd.random() < 0.4 and parts.append("On Monday, Bob wrote:")
                parts += [rnd.choice(["> ", ">", " > "]) + (x.upper() if rnd.random() < 0.3 else x) for x in src]
            parts += [rnd.choice(pool) for _ in range(rnd.randint(0, 4))]
            rnd.random() < 0.3 and said and parts.append("> " + rnd.choice(pool))
            text = rnd.choice(["\n", "\r\n"]).join(parts) if parts else rnd.choice([None, ""])
            said += [text] if text else []
            rows.append((conv, turn * 2, rnd.choice(["user", "assistant", None]), text))
    doubled = rows + rows[:5]
    df = spark.createDataFrame(doubled, "conv_id long, turn long, role string, text string").withColumn("scope", F.lit("x")).withColumn("body", F.lit(1))
    out = C.reply_order(df).collect()
    want = brute(rows)
    assert len(out) == len(doubled)
    got = {(r.conv_id, r.turn): r for r in out}
    for (conv, turn, role, text), (units, n_quoted, depth, root, parent, body) in want.items():
        r = got[conv, turn]
        assert (r.n_linked, r.n_quoted, r.depth, r.thread_turn, r.parent_turn, r.text) == (units, n_quoted, depth, root, parent, body), (conv, turn, text)
        assert r.formatted == f"<|{role or ''}|>\n{body}\n"
    assert any(r.depth > 2 for r in out)
    order = [((r.conv_id is not None, r.conv_id or 0), r.thread_turn, r.depth, r.turn) for r in out]
    assert order == sorted(order)


def test_a_recurring_line_is_linked_to_its_last_writer(spark):
    rows = [(1, i, "u", "thanks" if i % 3 else "other") for i in range(300)] + [(1, 300, "u", "> thanks\nwelcome"), (1, 2, "q", "> thanks"),
            (1, None, "q", "> thanks"), (None, 5, "u", "thanks"), (None, 6, "q", "> thanks"), (1, 301, "s", "thanks\n> thanks")]
    out = {(r.conv_id, r.turn, r.role): r.parent_turn for r in C.reply_order(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert out[1, 300, "u"] == 299 and out[1, None, "q"] is None and out[None, 6, "q"] == 5
    assert out[1, 2, "q"] in (1, 2) and out[1, 301, "s"] == 299


def test_nested_levels_and_edges(spark):
    rows = [(1, 0, "a", "first\nmessage"), (1, 1, "b", "> first\n> message\nsecond"),
            (1, 2, "a", ">> first\n>> message\n> second\nthird"), (1, None, "x", None), (1, 3, "c", "> nobody said this"),
            (2, 0, "a", "> first"), (None, 0, "a", ""), (1, 4, "z", "> " + "x " * 60_000 + "\n" + "y " * 60_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {(r.conv_id, r.turn): r for r in C.reply_order(df).collect()}
    assert (out[1, 2].parent_turn, out[1, 2].depth, out[1, 2].thread_turn, out[1, 2].text) == (1, 2, 0, "third")
    assert out[1, 3].parent_turn is None and out[1, 3].text == "" and out[1, 3].n_quoted == 1
    assert out[2, 0].n_linked == 0 and out[None, 0].text == "" and out[1, None].text == ""
    assert C.reply_order(df.limit(0)).collect() == []
