"""License scans: fixed phrases, and an exact set-similarity join with notice templates
(DataFrame functions only).

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Text
blocks are the lines, and for each template all stretches of consecutive words, over line ends,
of ``WINDOW`` times the template's length: a notice may be wrapped anywhere. A block meets a
template if it holds at least ``threshold`` of the template's distinct words (containment
``|B n T| / |T|``).

The join is exact and filters before it compares:

- tokens are ordered by their global frequency, rarest first: one aggregate over all
  documents counts the template words (words in no template cannot change an overlap);
- prefix filter: with ``need = ceil(threshold |T|)`` common words, a block must hold one of
  the first ``|T| - need + 1`` words of the template, so only those are indexed;
- length filter: the block must hold ``need`` template words at all;
- positional filter: from the first common word at place ``i`` of the template and ``j`` of
  the block, no more than ``1 + min(|T| - i - 1, |B| - j - 1)`` words can be common;
- what is left is compared in full;
- stretches pass the same prefix and length filters by their document first, and are compared
  where a template word begins them: any other stretch holds no more than the next such one.

The index holds the template words alone and comes as a parameter (``Template`` objects in
code, at most ``MAX_TEMPLATES``), so it travels as a literal of the plan: blocks are probed
where they are, nothing is shuffled but the word counts, and no block is in one group with
others. Documents without an indexed word leave after one look at their words.

Defined results: a null or empty text has no words, no place and score 0; very long texts are
searched whole; every row is
judged by itself, so ties and repeated rows have equal results; null ids pass; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TEMPLATES = 500
#: Words of a stretch for each word of the template: room for comment marks and a few words more.
WINDOW = 1.5
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN, _KAPPA = "\u212a", "κ" # the one other character whose lower case is an ASCII letter


@dataclass(frozen=True)
class Template:
    label: str
    text: str

    @property
    def words(self) -> list[str]:
        """Distinct words, in the order of the text."""
        return list(dict.fromkeys(self.sequence))

    @property
    def sequence(self) -> list[str]:
        return [w for w in re.split(_SEPARATORS, self.text.lower()) if w]

    @property
    def window(self) -> int:
        """Words of a stretch that is compared with this template."""
        return math.ceil(WINDOW * len(self.sequence))


# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Sentences by which works are placed under public licences.
TEMPLATES = [
    Template("mit", "Released under the MIT License."),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                    "and associated documentation files, to deal in the Software without restriction"),
    Template("apache", "Licensed under the Apache License, Version 2.0."),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                    "GNU General Public License as published by the Free Software Foundation"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the "
                     "GNU Lesser General Public License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                    "fee is hereby granted"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                    "rights to this work"),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
]


def _lowered(text: Column) -> Column:
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit(_KAPPA)))


def _words(low: Column) -> Column:
    return F.array_remove(F.split(low, _SEPARATORS), "")


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def word_ranks(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """Rank of every vocabulary word by the number of documents that hold it, rarest first."""
    held = F.array_intersect(_words(_lowered(F.col(text))), _literal(vocabulary))
    counts = dict(docs.select(F.explode(held).alias("w")).groupBy("w").count().collect())  # vocabulary rows at most
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    return {w: i for i, w in enumerate(order)}


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         threshold: float = 0.9, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, the phrase places (``n_base``, ``first_word``, ``last_word``,
    ``base_labels``), ``blocks`` (line, label, containment of every line and template that
    meet), ``windows`` (first word, label, containment of the best stretch for every template that
    one meets), ``labels`` of all kinds and ``score``, the largest containment found."""
    if not 0 < threshold <= 1 or len(templates) > MAX_TEMPLATES:
        raise ValueError(f"threshold must lie in (0, 1], templates be {MAX_TEMPLATES} at most")
    templates = [t for t in templates if t.words]
    ranks = word_ranks(docs, sorted({w for t in templates for w in t.words}), text)
    sets = [sorted(t.words, key=ranks.__getitem__) for t in templates]
    needs = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
    index: dict[str, list[tuple[int, int, int, int]]] = {}
    for t, (s, need) in enumerate(zip(sets, needs)):
        for i, w in enumerate(s[:len(s) - need + 1]):
            index.setdefault(w, []).append((t, i, len(s), need))

    out = docs.select(F.col(doc_id).alias("doc_id"), _lowered(F.col(text)).alias("low"))
    out = out.withColumn("words", _words(F.col("low")))
    out = out.withColumn("wanted", F.arrays_overlap("words", _literal(sorted(index)))) if index else (
        out.withColumn("wanted", F.lit(False)))
    out = out.select("doc_id", F.size("words").cast("long").alias("n_words"),
                     _places(phrases).alias("places"), _blocks(templates, sets, index, ranks).alias("blocks"),
                     _windows(templates, sets, needs).alias("windows"))
    starts = F.transform("places", lambda p: p["at"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    found = F.concat(F.transform("blocks", lambda b: b["label"]), F.transform("windows", lambda b: b["label"]))
    holds = F.concat(F.transform("blocks", lambda b: b["containment"]), F.transform("windows", lambda b: b["containment"]))
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, found)), ",").alias("labels"),
        F.coalesce(F.array_max(holds), F.lit(0.0)).alias("score"), "blocks", "windows")


def _places(phrases: dict[str, str]) -> Column:
    """Every (start, label) at which the words of a phrase stand one after the other."""
    words = F.col("words")
    found = []
    for phrase, label in phrases.items():
        parts = phrase.split()

        def stands(i: Column, parts: tuple = tuple(parts)) -> Column:
            same = F.lit(True)
            for j, part in enumerate(parts):
                same = same & (F.get(words, i + j) == part)
            return same

        last = F.size(words) - len(parts)
        at = F.filter(F.sequence(F.lit(0), last), _unary(stands))
        at = F.when((last >= 0) & F.array_contains(words, parts[-1]), at).otherwise(F.array().cast("array<int>"))
        found.append(F.transform(at, _labelled(label)))
    return F.concat(*found)


def _unary(f):
    return lambda i: f(i)


def _labelled(label: str):
    return lambda i: F.struct(i.alias("at"), F.lit(label).alias("label"))


def _blocks(templates: list[Template], sets: list[list[str]], index: dict, ranks: dict[str, int]) -> Column:
    """(line, label, containment) of every line and template that meet."""
    kind = "array<struct<line: int, label: string, containment: double>>"
    none = F.array().cast(kind)
    if not index:
        return none
    rank_of = F.create_map(*[x for w, r in ranks.items() for x in (F.lit(w), F.lit(r))])
    prefix = F.create_map(*[x for w, hits in index.items() for x in (F.lit(w), F.array(*[
        F.struct(*[F.lit(v).alias(n) for v, n in zip(h, ("t", "i", "size", "need"))]) for h in hits]))])
    own_words = F.array(*[_literal(s) for s in sets])
    own_label = F.array(*[F.lit(t.label) for t in templates])
    known = _literal(list(ranks))

    def ordered(line: Column) -> Column:  # the template words of a line, rarest first
        held = F.array_intersect(_words(line), known)
        return F.transform(F.array_sort(F.transform(held, lambda w: F.struct(F.element_at(rank_of, w).alias("r"),
                                                                            w.alias("w")))), lambda x: x["w"])

    def meets(block: Column, number: Column) -> Column:
        size = F.size(block)
        hits = F.flatten(F.transform(block, lambda w, j: F.transform(
            F.coalesce(F.try_element_at(prefix, w), F.array().cast(
                "array<struct<t: int, i: int, size: int, need: int>>")),
            lambda h: F.struct(h["t"].alias("t"), (F.lit(1) + F.least(h["size"] - h["i"], size - j) - 1).alias("most"),
                               h["need"].alias("need"), h["size"].alias("size")))))
        # a template's first hit bounds what can be common; later ones only bound the rest
        first = F.filter(hits, lambda h, k: ~F.exists(F.slice(hits, 1, k), lambda g: g["t"] == h["t"]))
        possible = F.filter(first, lambda h: (size >= h["need"]) & (h["most"] >= h["need"]))
        scored = F.transform(possible, lambda h: F.struct(
            number.cast("int").alias("line"), F.get(own_label, h["t"]).alias("label"),
            (F.size(F.array_intersect(block, F.get(own_words, h["t"]))) / h["size"]).alias("containment"),
            h["need"].alias("need"), h["size"].alias("size")))
        good = F.filter(scored, lambda s: s["containment"] * s["size"] > s["need"] - 0.5)
        return F.transform(good, lambda s: F.struct(s["line"].alias("line"), s["label"].alias("label"),
                                                    s["containment"].alias("containment")))

    lines = F.transform(F.split(F.col("low"), "\n"), ordered)
    return F.when(F.col("wanted"), F.flatten(F.transform(lines, meets)).cast(kind)).otherwise(none)


def _windows(templates: list[Template], sets: list[list[str]], needs: list[int]) -> Column:
    """(first word, label, containment) of the best stretch of words for every template that one meets."""
    kind = "array<struct<word: int, label: string, containment: double>>"
    none = F.array().cast(kind)
    if not templates:
        return none
    table = F.array(*[F.struct(F.lit(t.label).alias("label"), _literal(s).alias("words"), _literal(s[:len(s) - n + 1]).alias("prefix"),
                               F.lit(n).alias("need"), F.lit(t.window).alias("window"))
                      for t, s, n in zip(templates, sets, needs)])
    words = F.col("words")
    likely = F.filter(table, lambda t: F.arrays_overlap(words, t["prefix"]) & (
        F.size(F.array_intersect(words, t["words"])) >= t["need"]))

    def best(t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(t["words"], F.get(words, i)))
        return F.array_max(F.transform(starts, lambda i: F.struct(
            F.size(F.array_intersect(F.slice(words, i + 1, t["window"]), t["words"])).alias("n"), (-i).alias("at"))))

    scored = F.transform(likely, lambda t: F.struct(t["label"].alias("label"), F.size(t["words"]).alias("size"),
                                                    t["need"].alias("need"), best(t).alias("b")))
    good = F.filter(scored, lambda s: s["b"]["n"] >= s["need"])
    return F.when(F.col("wanted"), F.transform(good, lambda s: F.struct(
        (-s["b"]["at"]).alias("word"), s["label"].alias("label"), (s["b"]["n"] / s["size"]).alias("containment")))
        .cast(kind)).otherwise(none)
