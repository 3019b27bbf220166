import random

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import html_text as H


@pytest.mark.parametrize("page,blocks", [
    (None, []), ("", []), ("   \n", []), ("plain &amp; simple", ["plain & simple"]),
    ("<article><h1>A  b\n c</h1><p>One<p>Two <b>bold</b>er<br>line</article><footer>f</footer>", ["A b c", "One", "Two bolder line"]),
    ("<nav>menu</nav><main><p>x</p><aside>no</aside><p>y &lt;3 &eacute; &#x41;&am;</p></main>", ["x", "y <3 é A&am;"]),
    ("<article><p>t</p><div class='ad'>buy</div><div class=\"x cookie-banner\">ok</div><form>in</form><p>u</p></article>", ["t", "u"]),
    ("<article><p>t</p><section id=comments><article><p>reader</p></article></section></article>", ["t"]),
    ("<article>t</article><div class=comments><article class=comment>reader</article></div>", ["t"]),
    ("<body class='has-sidebar'><div class='post-content'><p>text</p></div><div class='sidebar'>s</div>", ["text"]),
    ("<script>var a='<article>';</script><style>p{}</style><article>x<script>if(a<b){'</p>'}</script>y</article>", ["xy"]),
    ("<nav><ul><li>unclosed<article><p>still read</p></article>", ["still read"]),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", ["one", "two", "a", "b", "c"]),
    ("<article>a < b and 3 <4 <!-- c > d -->e<p title='x>y'>f</p><p title=it's>g</p></article><p>out", ["a < b and 3 <4 e", "f", "g"]),
    ("<article>cut off <div class=\"x", ["cut off"]), ("<article>open comment <!-- never closed <p>x", ["open comment"]),
    ("<article><header><p>by</p></header><p>z</p><div hidden>h</div><div style='display: none'>n</div><p/>w</article>", ["z", "w"]),
    ("<ARTICLE><P>Caps</P></ARTICLE>", ["Caps"]), ("<article><p>a</article></article></p><p>late</p>", ["a"]),
    ("<article></article><main><p>m</p></main>", ["m"]), ("<title>only</title>", []),
    ("<article><div><p>p1<div>d</div>tail</div></article>", ["p1", "d", "tail"]),
    ("<article><span class='ad'>ad</span>x <i>y</i>z</article>", ["x yz"]),
])
def test_structure(page, blocks):
    assert H.page_blocks(page)[1] == blocks


def brute(rows):
    """Windows of every pair of distinct streams of a host, compared one by one."""
    parsed = [(i, u, *H.page_blocks(h)) for i, u, h in rows]
    host = lambda u: (u or "").split("://")[-1].split("/")[0].lower() if u else ""
    out = []
    for i, u, declared, blocks in parsed:
        if declared:
            out.append((i, "\n".join(blocks)))
            continue
        tokens = " ".join(blocks).split(" ") if blocks else []
        gone = set()
        for _, u2, d2, b2 in parsed:
            if d2 or host(u2) != host(u) or b2 == blocks:
                continue
            t2 = " ".join(b2).split(" ")
            seen = {tuple(t2[j:j + H.RUN]) for j in range(len(t2) - H.RUN + 1)}
            gone |= {j + k for j in range(len(tokens) - H.RUN + 1) if tuple(tokens[j:j + H.RUN]) in seen for k in range(H.RUN)}
        left, at = [], 0
        for b in blocks:
            words = b.split(" ")
            keep = [w for k, w in enumerate(words, at) if k not in gone]
            at += len(words)
            left += [" ".join(keep)] if keep else []
        out.append((i, "\n".join(left)))
    return sorted(out, key=str)


def test_host_suffix_array_matches_brute_force(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    chrome = [text(15), text(9) + "</div><div>" + text(9), text(5)]
    rows = []
    for i in range(60):
        host = rnd.choice(["a.org", "A.org", "b.org"])
        body = "".join(f"<div>{x}</div>" for x in
                       [chrome[0], text(rnd.randint(1, 30)), *([chrome[1]] if rnd.random() < 0.6 else []), text(20), chrome[2]])
        rows.append((i, f"http://{host}/{i}", f"<body>{body}"))
    rows.append((100, "http://a.org/x", rows[0][2]))  # a copy of a page erases nothing of it
    rows += [(None, None, f"<p>{text(30)}"), (101, None, rows[3][2]), (102, "http://b.org/", None), (102, "http://b.org/", None),
             (103, "http://a.org/", f"<article>{chrome[0]}</article>"), (104, "http://c.org", "<p>" + "long " * 30_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = H.main_text(df).collect()
    assert sorted(((r.page_id, r.text) for r in out), key=str) == brute(rows)
    assert all(r.n_chars == len(r.text) for r in out)
    assert any(r.n_repeated for r in out)
    assert next(r.text for r in out if r.page_id == 103) == chrome[0]
    assert H.main_text(df.limit(0)).collect() == []


LONG = "a page of fourteen words that stands alone and is not to be lost"


@pytest.mark.parametrize("page,text", [
    (f"<body><h1 class=post-title>T</h1><p>{LONG}</p>", f"T\n{LONG}"),
    (f"<body><div class='entry-meta'>by me</div><p>{LONG}</p>", f"by me\n{LONG}"),
    (f"<main><p>{LONG}</p><p>{LONG}</p></main><article class=card>a teaser</article>", f"{LONG}\n{LONG}"),
    (f"<div class=content><p>{LONG}</p></div><article class=card>a teaser</article>", LONG),
    (f"<div><p>{LONG}</p></div><article class=card>a teaser</article>", f"{LONG}\na teaser"),
    (f"<article><p>{LONG}</p></article><div class=content>see too</div>", LONG),
    (f"<div id=post-17><h1 class=post-title>T</h1><p>{LONG}</p></div><p>out</p>", f"T\n{LONG}"),
    (f"<main><h1>T</h1><article><p>{LONG}</p></article></main>", LONG),
])
def test_no_small_part_takes_the_place_of_the_article(page, text):
    assert "\n".join(H.page_blocks(page)[1]) == text


FIFTY = " ".join(f"word{i}" for i in range(50))
MORE = " ".join(f"more{i}" for i in range(60))


@pytest.mark.parametrize("page,text", [
    (f'<div class="site no-sidebar"><article><p>{FIFTY}</p></article></div>', FIFTY),
    (f'<div class="entry-content has-sidebar"><p>{FIFTY}</p></div>', FIFTY),
    (f'<div class="wrap search"><article><p>{FIFTY}</p></article></div>', FIFTY),
    (f'<div class="page alert-visible"><article><p>{FIFTY}</p></article></div>', FIFTY),
    (f'<form id="aspnetForm"><nav>menu</nav><p>{FIFTY}</p><div class=ad>buy</div></form>', FIFTY),
    (f'<form id="aspnetForm"><div class=search>find</div><article><p>{FIFTY}</p></article></form>', FIFTY),
    (f"<main><p>{FIFTY}</p><article>{MORE}</article></main>", f"{FIFTY}\n{MORE}"),
    (f'<article>{MORE}</article><div class="post-content">{FIFTY}</div>', f"{MORE}\n{FIFTY}"),
    (f'<article>t</article><div class="cookie">{FIFTY}</div>', "t"),          # a long notice beside a short article
    (f'<p>short</p><div class=comments>{FIFTY}</div>', "short"),              # comments are never a wrapper
    (f'<div class=sidebar><article>{FIFTY}</article></div><article>{MORE}</article>', MORE),
    ("<form>name password</form>", ""), (f"<p>{FIFTY}</p><form>{FIFTY} {MORE}</form>", FIFTY + "\n" + FIFTY + " " + MORE),
])
def test_wrappers_and_states_are_no_chrome(page, text):
    assert "\n".join(H.page_blocks(page)[1]) == text


def test_time_is_linear_in_the_page():
    import time

    def seconds(n):
        page = "<div>x" * n + "<li>y" * n + "<p>z</p>" * n
        start = time.process_time()
        H.page_blocks(page)
        return time.process_time() - start

    seconds(500)
    assert seconds(16_000) < 30 * max(seconds(2_000), 0.005)


def brute_declared(rows):
    """Blocks of declared pages, less those covered by windows that over half of the host's distinct declared pages hold."""
    parsed = [(i, u.split("/")[2], H.page_blocks(h)[1]) for i, u, h in rows]
    windows = lambda b: [tuple(t[j:j + H.RUN]) for t in [" ".join(b).split(" ")] for j in range(len(t) - H.RUN + 1)]
    out = []
    for i, host, blocks in parsed:
        others = {tuple(b) for _, h, b in parsed if h == host}
        held = [set(windows(b)) for b in others]
        least = max(H.TEMPLATE_PAGES, len(others) // 2 + 1)
        starts = [j for j, w in enumerate(windows(blocks)) if sum(w in h for h in held) >= least]
        out.append((i, H.without_templates(blocks, starts), len(starts)))
    return sorted(out)


def test_host_suffix_array_decides_on_declared_pages(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    notice, quote, edition = text(15), text(20), text(80)
    page = lambda *parts: "<article>" + "".join(f"<p class=x>{p}</p>" for p in parts) + "</article>"
    rows = [(i, f"http://a.org/{i}", page(text(30), *([notice] if i % 4 else []), text(rnd.randint(5, 40)), *([quote] if i < 8 else [])))
            for i in range(24)]
    rows += [(100 + i, f"http://b.org/{i}", page(edition, text(3))) for i in range(8)]    # editions of one text stay whole
    rows += [(200 + i, f"http://c.org/{i}", page(text(40), notice)) for i in range(4)]    # too few pages for a template
    rows += [(300 + i, "http://a.org/copy", rows[1][2]) for i in range(30)]               # copies are one page
    got = H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert sorted((r.page_id, r.text, r.n_repeated) for r in got) == brute_declared(rows)
    texts = {r.page_id: r.text for r in got}
    assert notice not in texts[1] and quote in texts[1] and texts[300] == texts[1] and notice in texts[200]
    assert all(edition in texts[100 + i] for i in range(8))


def test_suffix_array_is_sorted_and_neighbours_are_compared(spark):
    rows = [("h", False, 1, ["a b", "c " * 11 + "d", "e"]), ("h", False, 2, ["a b " + "c " * 11 + "d"]), ("g", False, 3, ["x " * 20 + "y"])]
    anchors = H.Anchors()
    rows = [(*r, [int(k) for k in set(anchors(" ".join(r[3]).split(" ")))]) for r in rows]
    df = spark.createDataFrame(rows, "host string, declared boolean, stream long, blocks array<string>, keys array<long>")
    array = H.suffix_array(df.coalesce(1)).withColumn("file", F.spark_partition_id()).withColumn("n", F.monotonically_increasing_id()).orderBy("n").collect()
    assert [tuple(r[:5]) for r in array] == sorted(
        (h, d, " ".join(t[i:i + H.RUN]), s, i) for h, d, s, b, _ in rows for t in [" ".join(b).split(" ")]
        for i in range(len(t) - H.RUN + 1))
    for a, b in zip(array, array[1:]):
        if a.file == b.file:
            x, y = a["head"].split(" "), b["head"].split(" ")
            assert b.lcp == (next((i for i in range(H.RUN) if x[i] != y[i]), H.RUN) if a.host == b.host else 0)
            assert b.new == (tuple(a[:4]) != tuple(b[:4]))
