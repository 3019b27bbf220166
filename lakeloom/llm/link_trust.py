"""URL filters: host rules, and trust spread over the graph of hosts (DataFrame functions only).

1. Rules name a host and a path. A rule fits its host and all subdomains if the path of the
   url starts with the rule's; the longest rule that fits decides (of equal ones the longer
   host, then the greater text).
2. Seeds. A host is trusted by the share of its pages that a rule allows and distrusted by the
   share that a rule blocks.
3. Propagation: personalised PageRank with damping ``ALPHA`` in ``ROUNDS`` rounds, trust along
   the edges and distrust against them. Starting from ``x = s``, a round is
   ``x = (1 - ALPHA) s + ALPHA P x``; a host that no edge leaves passes on to itself, so mass is
   neither lost nor made, and a lone host whose pages are all blocked has a distrust of 1.
4. Edges: host A links to host B by as many pages as hold a link to B (``href`` of ``a`` elements
   with a host of its own; links within a host are none). A host and the nearest domain above
   it that is a host of the graph are linked both ways by ``KIN`` pages: they have one owner.
5. A page that no rule fits is blocked if the distrust of its host exceeds its trust by
   ``threshold`` or more.

Masses are integers in units of 1e-9 and shares are rounded down, so sums do not depend on
their order, and reruns and lost executors change no bit. A round is one join and one
aggregate over hosts and edges; every ``ROUNDS_A_TABLE`` rounds are written to the shared
folder. Pages are pre-aggregated to hosts and host pairs before they are shuffled; their join
with the host scores is split by adaptive execution where a host holds many pages.

Defined results: a null url, or one without ``://``, has the empty host and path, no rule, is
no host of the graph, and is allowed; null and empty pages hold no links; repeated rows are
pages of their own; hosts over 253 characters (no DNS names) have no domain above them; very
long pages are searched whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

UNIT = 1_000_000_000
ALPHA = 0.85
ROUNDS = 20
ROUNDS_A_TABLE = 5
KIN = 1
LONGEST_HOST = 253

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host of an absolute or protocol-relative link; the same in Java's and RE2's syntax.
LINK = (r"""(?i)<a[ \t\n\r\f/](?:[^<>]*?[ \t\n\r\f"'/])?href[ \t\n\r\f]*=[ \t\n\r\f]*["']?[ \t\n\r\f]*(?:https?:)?//"""
        r"""([^/?#"'<>\\ \t\n\r\f]+)""")


class Rule(NamedTuple):
    verdict: str  #: ``allow`` or ``block``
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = F.coalesce(F.get(F.split(url, "://", 2), 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.coalesce(F.get(F.split(url, "://", 2), 1), F.lit(""))
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct ``(size, host_size, text, verdict)`` of the rule that decides, or null."""
    fits = [F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
                   F.struct(F.lit(len(r.text)).alias("size"), F.lit(len(r.host)).alias("host_size"),
                            F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))) for r in rules]
    none = F.lit(None).cast("struct<size:int,host_size:int,text:string,verdict:string>")
    return F.array_max(F.array(*fits, none))


def linked_hosts(html: Column) -> Column:
    """The distinct hosts that a page links to by ``a`` elements."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: F.translate(x, UPPER, LOWER)))


def ruled_pages(pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url",
                html: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, ruled, targets)`` of every page: one pass over the texts."""
    slim = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
                        path_of(F.col(url)).alias("path"), linked_hosts(F.col(html)).alias("targets"))
    best = slim.withColumn("best", longest_rule(F.col("host"), F.col("path"), rules))
    return best.select("page_id", "host", "path", F.col("best.text").alias("rule"), F.col("best.verdict").alias("ruled"),
                       F.array_remove(F.array_except("targets", F.array("host")), "").alias("targets"))


def host_edges(ruled: DataFrame, kin: int = KIN) -> DataFrame:
    """``(src, dst, w)``: distinct host pairs with the pages that link them, kin edges added."""
    links = ruled.where("host <> ''").select(F.col("host").alias("src"), F.explode("targets").alias("dst"))
    links = links.groupBy("src", "dst").agg(F.count("*").alias("w"))
    if not kin:
        return links
    links = written(links, "host-links")
    hosts = ruled.where("host <> ''").select("host").union(links.select("dst")).distinct()
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(2), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = hosts.where((F.size(labels) > 2) & (F.length("host") <= LONGEST_HOST)).select("host", F.explode(above).alias("domain"))
    near = chain.join(hosts.select(F.col("host").alias("domain")), "domain").groupBy("host").agg(
        F.max(F.struct(F.length("domain").alias("n"), "domain"))["domain"].alias("domain"))
    pairs = near.select(F.col("host").alias("src"), F.col("domain").alias("dst")).union(near.select("domain", "host"))
    both = links.union(pairs.withColumn("w", F.lit(kin).cast("long")))
    return both.groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(seeds: DataFrame, edges: DataFrame, alpha: float = ALPHA, rounds: int = ROUNDS) -> DataFrame:
    """``(kind, host, x)`` after ``rounds`` rounds. ``seeds(kind, host, s)`` holds integer masses over 0,
    ``edges(kind, src, dst, w)`` weights over 0; a host's mass goes out in proportion to its weights."""
    totals = edges.groupBy("kind", "src").agg(F.sum("w").alias("all")).withColumnRenamed("src", "host")
    rate = (F.lit(alpha) * F.col("w").cast("double")) / F.col("all").cast("double")
    going = edges.withColumnRenamed("src", "host").join(totals, ["kind", "host"]).select("kind", "host", "dst", rate.alias("rate"))
    nodes = seeds.select("kind", "host").union(edges.select("kind", "dst")).distinct()
    ends = nodes.join(totals, ["kind", "host"], "left_anti").select(
        "kind", "host", F.col("host").alias("dst"), F.lit(alpha).alias("rate"))
    rates = written(going.union(ends), "host-rates")
    held = written(seeds.select("kind", "host", "s"), "host-seeds")
    base = held.select("kind", "host", F.floor(F.col("s") * F.lit(1.0 - alpha)).cast("long").alias("x"))
    x = held.select("kind", "host", F.col("s").alias("x"))
    for i in range(rounds):
        out = x.join(rates, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), F.floor(F.col("x") * F.col("rate")).cast("long").alias("x"))
        x = base.union(out).groupBy("kind", "host").agg(F.sum("x").alias("x"))
        if (i + 1) % ROUNDS_A_TABLE == 0 or i + 1 == rounds:
            x = written(x, "host-mass")
    return x


def host_scores(ruled: DataFrame, kin: int = KIN, alpha: float = ALPHA, rounds: int = ROUNDS) -> DataFrame:
    """``(host, trust, distrust)`` in units of 1e-9 of the hosts that have any."""
    share = lambda v: F.floor(F.lit(float(UNIT)) * F.count(F.when(F.col("ruled") == v, 1)) / F.count("*")).cast("long")
    hosts = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("allow"), share("block").alias("block"))
    kinds = F.array(F.struct(F.lit("trust").alias("kind"), F.col("allow").alias("s")),
                    F.struct(F.lit("distrust").alias("kind"), F.col("block").alias("s")))
    seeds = hosts.select("host", F.explode(kinds).alias("k")).where("k.s > 0").select("k.kind", "host", "k.s")
    edges = written(host_edges(ruled, kin), "host-edges")
    ways = edges.select(F.lit("trust").alias("kind"), "src", "dst", "w").union(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), "w"))
    mass = propagate(seeds, ways, alpha, rounds)
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("x")).otherwise(F.lit(0).cast("long"))).alias(k)
    return mass.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: Sequence[Rule], threshold: float = 0.5, page_id: str = "page_id", url: str = "url",
          html: str = "html", kin: int = KIN) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` of every page."""
    ruled = written(ruled_pages(pages, rules, page_id, url, html), "ruled-pages")
    scores = written(host_scores(ruled, kin), "host-scores")
    both = ruled.drop("targets").join(scores, "host", "left")
    zero = F.lit(0).cast("long")
    trust, distrust = F.coalesce("trust", zero), F.coalesce("distrust", zero)
    own = F.when(distrust - trust >= int(threshold * UNIT), F.lit("block")).otherwise(F.lit("allow"))
    return both.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
                       trust.alias("trust"), distrust.alias("distrust"))
