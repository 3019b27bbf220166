"""Chat formatting by quotation linking (DataFrame functions only).

A message's lines have a quote level, the number of ``>`` marks that lead them. Lines of
level 0 are its own; runs of equal level above are quoted passages. Lines are normalised
(marks off, white space folded, lower case). Units of linking are whole passages and single
lines; units of a message that can be quoted are its whole own text, its runs of own lines
and each of them. Units are hashed, and each quoted one is linked to the latest message of the
conversation that wrote it before: an as-of join by turn. Writers and quotes of a unit are put
in one order and every quote takes the last writer ahead of it, so a line that everybody
writes or quotes multiplies nothing. The order is kept within ranges of turns, whose last
writers are handed on from range to range: a unit that a third of all messages hold is split.

A message answers the earlier message from which most of its outermost quoted characters
come; a whole passage counts for more than all of its lines. Ties go to the later message.
Answers lead to earlier messages only, so they form trees; pointer doubling finds each
message's root and depth in as many rounds as the depth has binary digits. Result rows are
the messages without quotes and attribution lines, in order of reply: conversation, thread
root, depth, turn. The order comes from a range partitioning on all of these, which splits a
long conversation; no conversation is gathered in one place.

Defined results: null and empty texts are messages without lines; rows without a
conversation id form one conversation, apart from all others; a null turn comes first;
messages of equal conversation, turn, role and text are one message with several rows, each
of which is returned; a quote of something nobody wrote before stays unlinked and still goes;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stable_key, written

_MARKS = r"^((?:[ \t]*>)+)"
_ATTRIBUTION = r"(?i)^\s*(on\b.{1,300}\bwrote|le\b.{1,300}\ba écrit|am\b.{1,300}\bschrieb|el\b.{1,300}\bescribió)\s*:\s*$"


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, _MARKS, ""), r"\s+", " ")))


def _unit(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("h"), F.length(text).alias("n"))


def parse_messages(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """Per row: keys, ``body`` without quotes, quotable ``own`` units and ``quoted`` units with level and weight."""
    df = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                         F.col(text).alias("text"))
    df = df.withColumn("scope", stable_key("conv_id")).withColumn(
        "message", F.md5(stable_key("conv_id", "turn", "role", "text")))
    raw = F.when(F.coalesce(F.col("text"), F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split("text", r"\r?\n"))
    df = df.withColumn("raw", raw)
    df = df.withColumn("lines", F.transform("raw", lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 1), "[^>]", "")).alias("level"),
        _normal(x).alias("normal"), x.alias("raw"))))
    df = df.withColumn("lines", F.transform("lines", lambda x, i: F.struct(
        # an attribution line goes with the quote that it announces
        F.when((x["level"] == 0) & x["raw"].rlike(_ATTRIBUTION)
               & (F.coalesce(F.get(F.col("lines"), i + 1)["level"], F.lit(0)) > 0), F.lit(-1))
        .otherwise(x["level"]).alias("level"), x["normal"].alias("normal"), x["raw"].alias("raw"))))
    df = df.withColumn("cuts", F.filter(
        F.transform("lines", lambda x, i: F.when(
            (i == 0) | (x["level"] != F.get(F.col("lines"), i - 1)["level"]), i)), lambda i: i.isNotNull()))
    df = df.withColumn("runs", F.transform("cuts", lambda c, j: F.struct(
        F.get(F.col("lines"), c)["level"].alias("level"),
        F.filter(F.transform(F.slice(F.col("lines"), c + 1,
                                     F.coalesce(F.get(F.col("cuts"), j + 1), F.size("lines")) - c),
                             lambda x: x["normal"]), lambda s: s != "").alias("lines"))))
    own = F.filter("runs", lambda r: (r["level"] == 0) & (F.size(r["lines"]) > 0))
    quoted = F.filter("runs", lambda r: (r["level"] > 0) & (F.size(r["lines"]) > 0))
    df = df.select("conv_id", "turn", "role", "scope", "message", own.alias("own"), quoted.alias("quoted"),
                   F.btrim(F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["raw"]), "\n"),
                           F.lit(" \t\r\n")).alias("body"))
    whole = F.array_join(F.flatten(F.transform("own", lambda r: r["lines"])), "\n")
    joined = lambda r: F.array_join(r["lines"], "\n")
    own_units = F.array_distinct(F.concat(
        F.when(F.size("own") > 0, F.array(_unit(whole))).otherwise(F.array().cast("array<struct<h: long, n: int>>")),
        F.transform("own", lambda r: _unit(joined(r))),
        F.flatten(F.transform("own", lambda r: F.transform(r["lines"], _unit)))))
    def weighted(unit: Column, level: Column, weight: Column) -> Column:
        return F.struct(unit["h"].alias("h"), unit["n"].alias("n"), level.alias("level"), weight.cast("long").alias("weight"))
    # a run of one line is that line; of several, the whole weighs more than twice its lines
    quoted_units = F.flatten(F.transform("quoted", lambda r: F.concat(
        F.when(F.size(r["lines"]) > 1, F.array(weighted(_unit(joined(r)), r["level"], F.length(joined(r)) * 2 + 1)))
        .otherwise(F.array().cast("array<struct<h: long, n: int, level: int, weight: long>>")),
        F.transform(r["lines"], lambda x: weighted(_unit(x), r["level"], F.length(x))))))
    return df.select("conv_id", "turn", "role", "scope", "message", "body", own_units.alias("own"), quoted_units.alias("quoted"),
                     F.aggregate("quoted", F.lit(0), lambda a, r: a + F.size(r["lines"])).alias("n_quoted"))


#: Ranges of turns, cut at quantiles of all turns, so that a hot conversation falls into many.
TURN_RANGES = 64


def latest_writers(quotes: DataFrame, writers: DataFrame, bounds: list[float]) -> DataFrame:
    """``quotes`` plus ``writer``: the greatest ``who`` below the quote's own among the writers of its unit;
    without a writer a quote is left out. Units are ``scope, h, n``; ``who`` begins with the turn."""
    unit = ["scope", "h", "n"]
    turn = F.col("who.turn")
    span = F.when(turn.isNull(), F.lit(0)).otherwise(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= turn)))
    wrote = writers.join(quotes.select(*unit).distinct(), unit, "left_semi").select(*unit, "who", F.lit(1).alias("writes"))
    events = quotes.withColumn("writes", F.lit(0)).unionByName(wrote, allowMissingColumns=True).withColumn("span", span)
    mine = F.when(F.col("writes") == 1, F.col("who"))
    # at one message its quotes come first, so that it is no writer of its own quotes
    ahead = Window.partitionBy(*unit, "span").orderBy("who", "writes").rowsBetween(Window.unboundedPreceding, -1)
    near = events.withColumn("writer", F.last(mine, ignorenulls=True).over(ahead)).where("writes = 0").drop("writes")
    earlier = Window.partitionBy(*unit).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    handed = events.groupBy(*unit, "span").agg(F.max(mine).alias("top")).select(  # a row a range of a unit
        *unit, "span", F.max("top").over(earlier).alias("handed"))
    out = near.join(handed, [*unit, "span"]).withColumn("writer", F.coalesce("writer", "handed"))
    return out.where("writer IS NOT NULL").drop("span", "handed")


def reply_links(parsed: DataFrame) -> DataFrame:
    """``(message, parent, n_linked)`` of the messages whose quotes are found in earlier ones."""
    once = parsed.dropDuplicates(["message"])
    who = F.struct("turn", "message").alias("who")
    writers = once.select("scope", who, F.explode("own").alias("u")).select("scope", "who", "u.h", "u.n")
    quotes = once.where(F.size("quoted") > 0).select(
        "scope", who, F.explode("quoted").alias("u"), F.array_min(F.transform("quoted", lambda q: q["level"])).alias("outer"))
    quotes = quotes.select("scope", "who", "outer", "u.h", "u.n", "u.level", "u.weight")
    bounds = parsed.select(F.col("turn").cast("double").alias("turn")).approxQuantile(
        "turn", [i / TURN_RANGES for i in range(1, TURN_RANGES)], 0.001)
    found = latest_writers(quotes, writers, sorted(set(bounds))).withColumnRenamed("writer", "first")
    score = found.groupBy("who.message", "first").agg(
        F.sum(F.when(F.col("level") == F.col("outer"), F.col("weight")).otherwise(F.lit(0))).alias("weight"),
        F.count("*").alias("units"))
    best = score.groupBy("message").agg(F.max(F.struct("weight", "first")).alias("b"), F.sum("units").alias("n_linked"))
    return best.select("message", F.when(F.col("b.weight") > 0, F.col("b.first.message")).alias("parent"),
                       F.when(F.col("b.weight") > 0, F.col("b.first.turn")).alias("parent_turn"), "n_linked")


def thread_roots(links: DataFrame) -> DataFrame:
    """``(message, root, depth)`` by pointer doubling over ``(message, parent)``."""
    state = written(links.select("message", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        above = state.select(F.col("message").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        if state.join(above, "root", "left_semi").isEmpty():
            return state
        state = written(state.join(above, "root", "left").select(
            "message", F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "threads")


def reply_order(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """The messages in order of reply: ``conv_id, thread_turn, depth, turn, role, parent_turn,
    n_quoted, n_linked, text, formatted``."""
    parsed = written(parse_messages(messages, conv, turn, role, text), "messages")
    links = written(reply_links(parsed), "links")
    roots = thread_roots(links.where(F.col("parent").isNotNull()).select("message", "parent"))
    turns = parsed.select(F.col("message").alias("root"), F.col("turn").alias("root_turn")).dropDuplicates(["root"])
    placed = links.join(roots, "message", "left").join(turns, "root", "left").select(
        "message", "root", "root_turn", "depth", "parent_turn", "n_linked")
    out = parsed.join(placed, "message", "left")
    out = out.select(
        "conv_id", F.when(F.col("depth").isNull(), F.col("turn")).otherwise(F.col("root_turn")).alias("thread_turn"),
        F.coalesce("root", "message").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "turn",
        "role", "parent_turn", F.col("n_quoted").cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("body").alias("text"), "message",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("body"), F.lit("\n")).alias("formatted"))
    return out.orderBy("conv_id", "thread_turn", "thread", "depth", "turn", "message").drop("message", "thread")
