import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import licenses as L


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words_of(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(s))


def brute(text, templates, threshold):
    words = words_of(text or "")
    places, labels = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    blocks = []
    for n, line in enumerate((text or "").split("\n")):
        held = set(words_of(line))
        for t in templates:
            own = set(t.words)
            if len(held & own) >= math.ceil(threshold * len(own) - 1e-9):
                blocks.append((n, t.label, len(held & own) / len(own)))
    stretches = []
    for t in templates:
        own, size = set(t.words), math.ceil(1.5 * len(words_of(t.text)))
        held = [(len(own & set(words[i:i + size])), -i) for i in range(len(words)) if words[i] in own]
        if held and max(held)[0] >= math.ceil(threshold * len(own) - 1e-9):
            stretches.append((-max(held)[1], t.label, max(held)[0] / len(own)))
    met = blocks + stretches
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {b[1] for b in met})), max((b[2] for b in met), default=0.0), sorted(blocks), sorted(stretches))


def texts():
    rnd = random.Random(6)
    out = [None, "", "\n\n", "MIT License", "mit\nlicense mit license", "MİT License", "Apache-License apache  LICENSE",
           "GNU General Public License version", "general public\tlicense general public license", "mit licenses",
           "submit license", "Licensed under CC BY-NC 4.0.", "é\u212a wor\u212a mit \u212a", "under the MIT License, released"]
    pool = [w for t in L.TEMPLATES for w in t.text.split()] + ["filler", "Straße", "x_y"]
    for _ in range(150):
        t = rnd.choice(L.TEMPLATES).text.split()
        if rnd.random() < 0.7:
            for _ in range(rnd.randint(0, 3)):
                t.pop(rnd.randrange(len(t))) if rnd.random() < 0.5 and len(t) > 1 else t.insert(rnd.randint(0, len(t)), rnd.choice(pool))
        rnd.random() < 0.3 and rnd.shuffle(t)
        lines = [" ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 3))]
        lines.insert(rnd.randint(0, len(lines)), " ".join(t))
        out.append("\n".join(lines))
    out.append("filler " * 40_000 + "\nReleased under the MIT License.\n" + "filler " * 10)
    return out


@pytest.mark.parametrize("threshold", [0.9, 0.6])
def test_matches_brute_force(spark, threshold):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows + [(None, "mit license"), (1, "mit license"), (1, "mit license")],
                                 "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("low", F.lit("x"))
    out = L.scan(docs, threshold=threshold).collect()
    assert len(out) == len(rows) + 3
    got = {r.doc_id: r for r in out if r.doc_id not in (None, 1)}
    for i, t in rows:
        if i == 1:
            continue
        r = got[i]
        mine = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score,
                sorted((b.line, b.label, b.containment) for b in r.blocks),
                sorted((b.word, b.label, b.containment) for b in r.windows))
        assert mine == brute(t, L.TEMPLATES, threshold), (i, t[:200])


def test_wrapped_notices_are_found(spark):
    """Notices as they are published: broken into lines, behind comment marks."""
    import textwrap
    rows = []
    for i, t in enumerate(L.TEMPLATES):
        for j, width in enumerate((20, 40, 72)):
            lines = textwrap.wrap(t.text, width)
            rows.append((10 * i + j, "Some text before.\n\n" + "\n".join(f" * {x}" if j == 2 else x for x in lines) + "\nand after."))
    out = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in enumerate(L.TEMPLATES):
        for j in range(3):
            assert t.label in out[10 * i + j].labels.split(",") and out[10 * i + j].score == 1.0, (t.text, j)
    apart = "\n".join(w + " filler" * 12 for w in L.TEMPLATES[6].text.split())   # all of its words, far from each other
    assert L.scan(spark.createDataFrame([(1, apart)], "doc_id long, text string")).first().labels == ""


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.scan(empty).collect() == []
    one = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    assert [(r.labels, r.score) for r in L.scan(one, templates=[]).collect()] == [("mit", 0.0)]
    with pytest.raises(ValueError):
        L.scan(one, threshold=0)
