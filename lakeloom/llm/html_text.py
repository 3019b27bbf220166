"""Main text of web pages: page structure, then a host suffix array for what structure lets pass.

Parsing cuts a page into blocks and drops what structure names as chrome: menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments of readers and markup.
Character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by line feeds. If the page declares its article
(``article``, ``main``, or a container named like one), the blocks of all such containers are
the text. Containers other than the best kind are left
out where they hold less than ``RUN`` tokens together (a teaser, say); containers that hold
less text than stands outside declare nothing.

Elements that are chrome by name alone, and forms, are judged when the page has been read: where
nothing outside of them declares an article, one that holds a declared article, or else most
of the page's text, was a wrapper and no chrome (a page inside a form, a layout class). Names
of states ("no-sidebar", "alert-visible") name no part. Readers' comments, teasers and adverts
are never taken for wrappers. Parsing takes time linear in the page.

Repetition across the host then has its say on every page. The token streams of a host's pages,
apart for those that declare an article and those that do not, are one text, and its suffix
array is sorted to a depth of ``RUN`` tokens: Spark sorts the suffixes by ranges of (host, first
``RUN`` tokens, page), neighbours are compared on their tokens, and each entry keeps the length of
its common prefix with the one before. Every substring of ``RUN`` tokens or more that occurs
on distinct pages is a chain of neighbours that share ``RUN`` tokens. On pages that declare no article
the tokens covered by such a chain are boilerplate and go; the unique runs stay. Inside a declared article
a text that a few pages share is article text (a quotation, a second edition), so only what more than
half of the host's declared pages hold, and ``TEMPLATE_PAGES`` at least, counts there, and only blocks that
it covers from end to end go: a notice under a name that structure does not know. A page that would
lose half of its article that way is an edition of a text, and keeps it.

Only suffixes that can have such a neighbour enter the array. Each window of ``RUN`` tokens has
an anchor, the ``ANCHOR`` tokens in it with the smallest hash; equal windows have equal anchors, so
windows whose anchor is on too few pages of the host are on too few themselves. Counting
anchors takes a number for some five tokens and no text; their hashes decide nothing else.
Ranges end between the pages that hold a suffix, so neither a host with a third of all pages nor a
menu on all of them gathers in one task.

Defined results: null or empty html gives the empty text; very long pages are read whole; a null url belongs to the host
"" ; equal streams (copies of a page, repeated rows) are one page, so copies do not erase
each other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .common import ship_package, written

#: Tokens of a substring that counts as repeated.
RUN = 12
#: Tokens of a window's anchor.
ANCHOR = 4
#: Distinct pages of a host that hold a text at least, if it is a template inside their articles.
TEMPLATE_PAGES = 5
CACHE_TOKENS = 1 << 20
_SLICE = 1 << 15

# Names of HTML elements and words that web pages use for their parts.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre section summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_CHROME_TAGS = frozenset(
    "aside audio button canvas datalist dialog footer head header map menu nav noscript object select svg "
    "template video".split())
_CHROME_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_CHROME_WORDS = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav "
    "navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion "
    "recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar topbar widget".split())
_ARTICLE_CHROME = frozenset("ad ads advert comment comments promo related reply sponsored teaser".split())
_CONTENT_WORDS = frozenset("article content entry post story".split())
#: Words of names that tell a state of an element, not which part of the page it is.
_STATES = frozenset("active closed disabled enabled has hidden hide is no open opened show visible with without".split())
#: Chrome words of parts that hold text of their own, however much; an element so named is no wrapper.
_OWN_TEXT = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts comment comments disqus promo promotion recommended "
    "related replies reply respond sponsor sponsored".split())
_LISTS = frozenset("li dt dd tr td th option body head ul ol dl table".split())
_OPENERS = ("nav", "header", "head", "menu", "ul", "form")
#: Tokens that an element holds at least to be a wrapper by the share of its text.
WRAPPER_TOKENS = 25
#: Elements that hold an article when named like one, and words that such names end in.
_CONTAINERS = frozenset("center div section table tbody td".split())
_CONTAINER_ENDS = _CONTENT_WORDS | frozenset("area body container inner main text wrap wrapper".split())
_CLOSES = {  # an element that a sibling of the same kind ends
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)"""
    r"""(?:((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|([^>]*)>)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_CUT = re.compile(r"<[a-zA-Z/!?]")
_NAME = re.compile(r"[\s_-]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
ARTICLE, MAIN, CONTENT = 1, 2, 4


def _attributes(text: str) -> dict[str, str]:
    if "=" not in text:
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


NO, YES, MAYBE = 0, 1, 2


def _part(name: str, attributes: str) -> tuple[int, int]:
    """(is chrome: no, yes, or unless it proves a wrapper; which declared container) of an element."""
    mark = ARTICLE if name == "article" else MAIN if name == "main" else 0
    if name in _CHROME_TAGS:
        return YES, 0
    a = _attributes(attributes)
    if not a:
        return YES if attributes.strip().lower() == "hidden" else MAYBE if name == "form" else NO, mark
    role = a.get("role", "").lower()
    if role in _CHROME_ROLES or a.get("aria-hidden") == "true" or _HIDDEN.search(a.get("style", "")):
        return YES, 0
    if name in ("html", "body", "main"):
        return NO, mark
    names = f"{a.get('class', '')} {a.get('id', '')}".lower().split()
    words = {w for n in names for w in _NAME.split(n)}
    parts = {w for n in names if _STATES.isdisjoint(split := _NAME.split(n)) for w in split}
    if parts & (_ARTICLE_CHROME if mark == ARTICLE else _CHROME_WORDS):
        return YES if mark == ARTICLE or parts & _OWN_TEXT else MAYBE, 0
    if name == "form":
        return MAYBE, 0
    if role == "article" or a.get("itemprop", "").lower() == "articlebody":
        mark |= ARTICLE
    if role == "main":
        mark |= MAIN
    if name in _CONTAINERS and words & _CONTENT_WORDS and any(map(_names_content, names)):
        mark |= CONTENT
    return NO, mark


def _names_content(name: str) -> bool:
    """Whether a class or id names an article's container ("post-content", "post-17"), not a part of it ("post-title")."""
    words = [w for w in _NAME.split(name) if w and not w.isdigit()]
    return bool(words) and words[-1] in _CONTAINER_ENDS and not _CONTENT_WORDS.isdisjoint(words)


def _tokens(text: str) -> int:
    return text.count(" ") + 1


def _chosen(blocks: list[tuple[int, str]]) -> tuple[bool, list[str]]:
    """All text of declared containers, or that of one kind, best kind first, if less than ``RUN`` tokens
    stand in the others: too little to be an article.

    Marked text that is less than half of the page's declares nothing.
    """
    sizes = [_tokens(t) for _, t in blocks]
    marked = sum(n for (k, _), n in zip(blocks, sizes) if k)
    rest = sum(sizes) - marked
    if not marked or (rest >= RUN and rest > marked):
        return False, [t for _, t in blocks]
    for kind in (ARTICLE, MAIN, CONTENT):
        own = sum(n for (k, _), n in zip(blocks, sizes) if k & kind)
        if own and marked - own < RUN:
            return True, [t for k, t in blocks if k & kind]
    return True, [t for k, t in blocks if k]


class _Open:
    """The open elements of a page: each knows what holds for all that contain it."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, bool, int, int]] = [("", NO, False, 0, -1)]  # name, chrome, hidden, marks, wrapper
        self.names: Counter[str] = Counter()
        self.lists: list[str] = []
        self.wrappers: list[int] = []  # of each possible wrapper the one around it, or -1
        self.declares: list[bool] = []

    @property
    def hidden(self) -> bool:
        return self.stack[-1][2]

    @property
    def marks(self) -> int:
        return self.stack[-1][3]

    @property
    def wrapper(self) -> int:
        return self.stack[-1][4]

    def push(self, name: str, chrome: int, mark: int) -> None:
        _, _, hidden, marks, wrapper = self.stack[-1]
        if chrome == MAYBE:
            self.wrappers.append(wrapper)
            self.declares.append(False)
            wrapper = len(self.wrappers) - 1
        if mark & (ARTICLE | MAIN) and not hidden and wrapper >= 0:
            self.declares[wrapper] = True
        self.stack.append((name, chrome, hidden or chrome == YES, marks | mark, wrapper))
        self.names[name] += 1
        if name in _LISTS:
            self.lists.append(name)

    def close(self, names: tuple[str, ...]) -> bool:
        if not any(self.names[n] for n in names):
            return False
        while True:
            name = self.stack.pop()[0]
            self.names[name] -= 1
            if name in _LISTS:
                self.lists.pop()
            if name in names:
                return True

    def opener(self) -> str | None:
        """The name of the outermost open chrome that an article may have been left open in."""
        if not any(self.names[n] for n in _OPENERS):
            return None
        return next((n for n, c, *_ in self.stack if c and n in _OPENERS), None)


def _unwrapped(blocks: list[tuple[int, int, str]], wrappers: list[int], declares: list[bool]) -> list[tuple[int, str]]:
    """The blocks outside chrome: possible wrappers that prove to be one keep theirs."""
    if not wrappers:
        return [(m, t) for m, _, t in blocks]
    sizes = [0] * len(wrappers)
    for _, w, t in blocks:
        if w >= 0:
            sizes[w] += _tokens(t)
    holds = list(declares)
    for w in range(len(wrappers) - 1, -1, -1):  # an element comes after the one around it
        if wrappers[w] >= 0:
            sizes[wrappers[w]] += sizes[w]
            holds[wrappers[w]] |= holds[w]
    proven = [False] * len(wrappers)
    if not any(m and w < 0 for m, w, _ in blocks):
        total = sum(_tokens(t) for *_, t in blocks)
        by_share = not any(holds)
        proven = [2 * n > total and n >= WRAPPER_TOKENS if by_share else h for n, h in zip(sizes, holds)]
    kept = []
    for w, up in enumerate(wrappers):
        kept.append(proven[w] and (up < 0 or kept[up]))
    return [(m, t) for m, w, t in blocks if w < 0 or kept[w]]


def page_blocks(page: str | None) -> tuple[bool, list[str]]:
    """(declared, blocks): the page's article, or all blocks outside its chrome if it declares none."""
    page = page or ""
    tree = _Open()
    blocks: list[tuple[int, int, str]] = []
    parts: list[str] = []
    at, end = 0, len(page)

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append((tree.marks, tree.wrapper, text))
            parts.clear()

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            rest = page[at:]
            cut = _CUT.search(rest)
            if not tree.hidden:
                parts.append(rest[:cut.start()] if cut else rest)
            break
        if m.start() > at and not tree.hidden:
            parts.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name in _BLOCKS:
                flush()
            tree.close((name,))
            continue
        if name in _RAW:
            stop = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end if stop is None else stop.start()
            if name == "title":
                flush()
            continue
        if name == "br":
            if not tree.hidden:
                parts.append(" ")
            continue
        block = name in _BLOCKS
        if block:
            flush()
            if name != "body":
                tree.close(("p",))
        if name in _CLOSES:
            ends = _CLOSES[name]
            nearest = next((n for n in reversed(tree.lists) if n in ends or n in ("ul", "ol", "dl", "table")), "")
            if nearest in ends:
                tree.close((nearest,))
                if name == "tr" and tree.stack[-1][0] == "tr":
                    tree.close(("tr",))
        if name in _VOID:
            continue
        raw = m[3] if m[3] is not None else m[4] or ""
        chrome, mark = _part(name, raw)
        if chrome == MAYBE and not block:
            chrome = YES  # part of a line
        if mark & (ARTICLE | MAIN) and not chrome and (tree.hidden or tree.wrapper >= 0):
            # an article opens inside a menu or header that nobody closed; readers' comments stay what they are
            opener = tree.opener() if tree.hidden else None
            if opener:
                tree.close((opener,))
        if (block or chrome or mark) and not raw.endswith("/"):
            tree.push(name, chrome, mark)
    flush()
    return _chosen(_unwrapped(blocks, tree.wrappers, tree.declares))


def stream_key(blocks: list[str]) -> int:
    import xxhash
    return xxhash.xxh64_intdigest("\n".join(blocks)) - (1 << 63)


def _stream(blocks: list[str]) -> list[str]:
    return " ".join(blocks).split(" ") if blocks else []


class Anchors(dict):
    """The anchor of every window of a token stream; the hashes of tokens are kept between pages."""

    def __missing__(self, token: str) -> int:
        import xxhash
        if len(self) >= CACHE_TOKENS:
            self.clear()
        got = self[token] = xxhash.xxh64_intdigest(token)
        return got

    def __call__(self, tokens: list[str]) -> np.ndarray:
        if len(tokens) < RUN:
            return np.empty(0, np.int64)
        one = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        n = len(tokens) - ANCHOR + 1
        key = one[:n].copy()
        for k in range(1, ANCHOR):
            key = key * np.uint64(0x9E3779B97F4A7C15) + one[k:k + n]
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
        inside = np.lib.stride_tricks.sliding_window_view(key, RUN - ANCHOR + 1)
        return key[inside.argmin(axis=1) + np.arange(len(inside))].view(np.int64)


def _covered(starts: list[int]) -> set[int]:
    return {i + j for i in starts for j in range(RUN)}


def without(blocks: list[str], starts: list[int]) -> str:
    """The blocks less the tokens inside the windows that begin at ``starts``."""
    gone = _covered(starts)
    out, at = [], 0
    for b in blocks:
        tokens = b.split(" ")
        left = [t for i, t in enumerate(tokens, at) if i not in gone]
        at += len(tokens)
        if left:
            out.append(" ".join(left))
    return "\n".join(out)


def without_templates(blocks: list[str], starts: list[int]) -> str:
    """The blocks less those that lie inside the windows whole; all of them, if half of the tokens or more would go."""
    gone = _covered(starts)
    kept, at, lost = [], 0, 0
    for b in blocks:
        n = _tokens(b)
        if gone.issuperset(range(at, at + n)):
            lost += n
        else:
            kept.append(b)
        at += n
    return "\n".join(kept if 2 * lost < at else blocks)


_SITE = ["host", "declared"]  # one text each


def _anchored(parsed: DataFrame) -> DataFrame:
    """``(row, site, host, declared, stream, keys)``: the distinct anchors of each page that has a window."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            found = [np.unique(anchors(_stream(b))) for b in batch.column(5).to_pylist()]
            ends = np.cumsum([0] + [len(f) for f in found]).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)) if found else pa.array([], pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], keys], ["row", "site", "host", "declared", "stream", "keys"])

    return parsed.select("row", F.xxhash64(*_SITE).alias("site"), *_SITE, "stream", "blocks").mapInArrow(
        rows, "row long, site long, host string, declared boolean, stream long, keys array<long>")


def _candidates(parsed: DataFrame, sites: DataFrame) -> DataFrame:
    """``(row, keys)``: one page of each distinct stream that holds anchors which enough pages of its site hold,
    copies of a page counted as pages."""
    counts = _anchored(parsed).select("site", F.explode("keys").alias("key")).groupBy("site", "key").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = written(counts.join(sites.select(F.xxhash64(*_SITE).alias("site"), "least"), "site").where(
        "n >= least").select("site", "key"), "anchors")
    hits = _anchored(parsed).withColumn("key", F.explode("keys")).join(broadcast_if_small(keys), ["site", "key"], "left_semi")
    return hits.groupBy(*_SITE, "stream").agg(F.min("row").alias("row"), F.collect_set("key").alias("keys")).select("row", "keys")


def suffix_array(pages: DataFrame) -> DataFrame:
    """``(host, declared, head, stream, at, lcp, new)`` for the windows of ``pages(host, declared, stream, blocks, keys)``
    that have an anchor among ``keys``, in the order of the array within each file.

    ``head`` is the suffix to a depth of ``RUN`` tokens, ``lcp`` counts the tokens that it shares with the entry before
    (of its site), ``new`` is 1 where the entry before has another head or page. All entries of one head and page are
    in one range, so the sum of ``new`` counts a head's pages.
    """
    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            for host, declared, stream, blocks, keys in zip(*[c.to_pylist() for c in batch.columns]):
                tokens = _stream(blocks)
                at = np.flatnonzero(np.isin(anchors(tokens), np.array(keys, np.int64)))
                for s in range(0, len(at), _SLICE):
                    some = at[s:s + _SLICE].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([host] * len(some), pa.string()), pa.array([declared] * len(some), pa.bool_()),
                         pa.array([" ".join(tokens[i:i + RUN]) for i in some], pa.string()),
                         pa.array([stream] * len(some), pa.int64()), pa.array(some, pa.int32())],
                        [*_SITE, "head", "stream", "at"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, tokens = (None, None, None, None), []
        for batch in batches:
            shared, new = [], []
            for entry in zip(*[c.to_pylist() for c in batch.columns[:4]]):
                if entry[:3] == before[:3]:
                    shared.append(RUN)
                else:
                    last, tokens = tokens, entry[2].split(" ")
                    same = 0
                    if entry[:2] == before[:2]:
                        same = next((i for i, (a, b) in enumerate(zip(last, tokens)) if a != b), RUN)
                    shared.append(same)
                new.append(int(entry != before))
                before = entry
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shared, pa.int32()), pa.array(new, pa.int32())],
                [*_SITE, "head", "stream", "at", "lcp", "new"])

    fields = "host string, declared boolean, head string, stream long, at int"
    ordered = pages.select(*_SITE, "stream", "blocks", "keys").mapInArrow(suffixes, fields).repartitionByRange(
        *_SITE, "head", "stream").sortWithinPartitions(*_SITE, "head", "stream", "at")
    return ordered.mapInArrow(neighbours, f"{fields}, lcp int, new int")


def repeated_windows(parsed: DataFrame) -> DataFrame:
    """``(host, declared, stream, starts)``: where the windows begin that enough pages of the site hold."""
    parsed = parsed.where(F.size("blocks") > 0)
    sites = parsed.groupBy(*_SITE).agg(F.count_distinct("stream").alias("pages")).select(
        *_SITE, F.when(F.col("declared"), F.greatest(F.lit(TEMPLATE_PAGES), F.floor(F.col("pages") / 2) + 1)).otherwise(2)
        .cast("long").alias("least")).where("not declared or least <= pages")
    sites = written(sites, "sites")
    candidates = written(_candidates(parsed, sites), "candidates")
    array = written(suffix_array(parsed.join(broadcast_if_small(candidates, SMALL), "row")), "suffixes")
    heads = array.groupBy(*_SITE, "head").agg(F.sum("new").alias("n")).join(sites, _SITE).where("n >= least").select(*_SITE, "head")
    return array.join(heads, [*_SITE, "head"], "left_semi").groupBy(*_SITE, "stream").agg(F.collect_set("at").alias("starts"))


#: Rows with a list each that a broadcast takes at most.
SMALL = 20_000


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars, declared, n_repeated)`` per row; ``n_repeated`` counts the windows
    that so many other pages of the host hold that they tell a template (on pages that declare no article, one)."""
    ship_package(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html")).withColumn("host", host)
    kind = slim.schema["page_id"].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                got = [page_blocks(h) for h in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([d for d, _ in got], pa.bool_()),
                     pa.array([stream_key(b) for _, b in got], pa.int64()),
                     pa.array([b for _, b in got], pa.list_(pa.string()))],
                    ["page_id", "url", "host", "declared", "stream", "blocks"])

    blocks = slim.select("page_id", "url", "host", "html").mapInArrow(
        parse, f"page_id {kind}, url string, host string, declared boolean, stream long, blocks array<string>")
    parsed = written(blocks.withColumn("row", F.monotonically_increasing_id()), "pages", compression="zstd")
    covered = written(repeated_windows(parsed), "covered")
    joined = parsed.join(broadcast_if_small(covered, SMALL), [*_SITE, "stream"], "left").select(
        "page_id", "url", "declared", "blocks", F.coalesce("starts", F.array().cast("array<int>")).alias("starts"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for declared, blocks, starts in zip(*[c.to_pylist() for c in batch.columns[2:]]):
                texts.append("\n".join(blocks) if not starts else
                             (without_templates if declared else without)(blocks, starts))
                counts.append(len(starts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), batch.column(2), pa.array(counts, pa.int64())],
                ["page_id", "url", "text", "declared", "n_repeated"])

    out = joined.mapInArrow(keep, f"page_id {kind}, url string, text string, declared boolean, n_repeated long")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "declared", "n_repeated")
