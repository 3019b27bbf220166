import math
import random
import re
from collections import Counter

import duckdb
import pytest

from lakeloom.llm import link_trust as L
from lakeloom.llm import oracles, queries

RULES = queries.URL_RULES
LOW = str.maketrans(L.UPPER, L.LOWER)
SPACE = " \t\n\r\f"


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return host.translate(LOW), path


def rule_of(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.text), len(r.host), r.text), default=None)


def links(html):
    out = set()
    for tag in re.findall(r"<a[ \t\n\r\f/][^<>]*", html or "", re.I):
        for m in re.finditer(r"""(?<=[ \t\n\r\f"'/])href[ \t\n\r\f]*=[ \t\n\r\f]*["']?[ \t\n\r\f]*(?:https?:)?//([^/?#"'<>\\ \t\n\r\f]+)""", tag, re.I):
            out.add(m[1].translate(LOW))
            break
    return out


def spread(seeds, edges):
    total = Counter()
    for (a, _), w in edges.items():
        total[a] += w
    for h in set(seeds) | {b for _, b in edges}:
        if h not in total:
            edges = edges | Counter({(h, h): 1})
            total[h] = 1
    base = {h: math.floor(s * (1.0 - L.ALPHA)) for h, s in seeds.items()}
    x = dict(seeds)
    for _ in range(L.ROUNDS):
        new = Counter(base)
        for (a, b), w in edges.items():
            if a in x:
                new[b] += math.floor(x[a] * ((L.ALPHA * float(w)) / float(total[a])))
        x = new
    return x


def brute(pages):
    judged = []
    for page_id, url, html in pages:
        host, path = split_url(url)
        judged.append((page_id, host, path, rule_of(host, path), links(html) - {host, ""}))
    count, allow, block, edges = Counter(), Counter(), Counter(), Counter()
    for _, host, _, rule, targets in judged:
        if host:
            count[host] += 1
            allow[host] += rule is not None and rule.verdict == "allow"
            block[host] += rule is not None and rule.verdict == "block"
            for t in targets:
                edges[host, t] += 1
    nodes = set(count) | {b for _, b in edges}
    for h in nodes:
        parts = h.split(".")
        above = [".".join(parts[i:]) for i in range(1, len(parts) - 1)] if len(h) <= L.LONGEST_HOST else []
        near = next((d for d in above if d in nodes), None)
        if near is not None:
            edges[h, near] += L.KIN
            edges[near, h] += L.KIN
    of = lambda c: {h: math.floor(1e9 * c[h] / count[h]) for h in count if c[h]}
    trust, bad = spread(of(allow), edges), spread(of(block), Counter({(b, a): w for (a, b), w in edges.items()}))
    out = []
    for page_id, host, path, rule, _ in judged:
        t, d = trust.get(host, 0), bad.get(host, 0)
        own = "block" if d - t >= L.UNIT // 2 else "allow"
        out.append((page_id, host, path, rule and rule.text, rule.verdict if rule else own, t, d))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def made_pages():
    rnd = random.Random(5)
    hosts = [f"{s}{n}.example.{t}" for n in "abcd" for t in ("net", "com", "org") for s in ("", "www.", "blog.")]
    hosts += ["net", "example.com", "other.test", "deep.er.other.test", "com", "x" * 260 + ".other.test"]
    pages = []
    for i in range(700):
        host = "hot.example.com" if rnd.random() < 0.33 else rnd.choice(hosts)
        to = [rnd.choice(hosts) for _ in range(rnd.choice([0, 0, 1, 2, 5]))]
        body = "".join(rnd.choice(['<a href="https://{}/x">y</a>', "<A class=b HREF='//{}'>", '<a\nhref=http://{}?q>', '<p data-href="//{}">',
                                   '<a data-href="//{}/">', "<abbr href=//{}>", '<a title="t"href="HTTP://{}#f">', '<a href="/local">'])
                       .format(h.upper() if rnd.random() < 0.2 else h) for h in to)
        url = f"http{rnd.choice(['', 's'])}://{host}{rnd.choice(['/en/1', '/de/2', '/fr/3', '/de', '', '/', '?a=/de/', '#/de/', '/x/de/'])}"
        pages.append((i, url, body))
    pages += [(None, "https://a.example.org/fr/1", "<a href=//a.example.com>"), (1, pages[1][1], pages[1][2]), (2, None, "<a href=//z.test>"),
              (3, "no scheme.net/", None), (4, "://", ""), (5, "a?u=http://B.NET/p", None), (6, "http://a.b.net:80/x", "<a href='//'>"),
              (7, "http://Ünet.net/É\n/?x", "<a " + "y " * 50_000 + "href=//late.test>"), (8, "http://notnet/", "<a href=")]
    return pages


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("pages"))
    spark.createDataFrame(made_pages(), "page_id long, url string, html string").selectExpr(
        "*", "'clash' as host", "'c' as targets", "1 as `all`").write.parquet(f"{place}/pages.parquet")
    return place


def test_matches_brute_force(spark, folder):
    got = queries.op12_link_trust(spark, folder)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"]
    rows, want = order(got.collect()), order(brute(made_pages()))
    assert rows == want
    own = [r for r in rows if r[3] is None and r[1]]
    assert {r[4] for r in own} == {"allow", "block"}  # the method decides both ways


def test_matches_the_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    want = con.execute(oracles.link_trust_verdicts(RULES))
    columns = [d[0] for d in want.description]
    assert order(queries.op12_link_trust(spark, folder).select(columns).collect()) == order(want.fetchall())


def test_trust_flows_along_links_and_distrust_against_them(spark):
    rules = [L.Rule("allow", "good.test"), L.Rule("block", "bad.test")]
    rows = [(1, "http://good.test/", "<a href=//friend.test>"), (2, "http://friend.test/", ""), (3, "http://bad.test/", ""),
            (4, "http://pusher.test/", "<a href=//bad.test>"), (5, "http://lone.test/", "")]
    got = {r["host"]: r for r in L.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules).collect()}
    assert got["friend.test"]["trust"] > 0 and got["friend.test"]["distrust"] == 0
    assert got["pusher.test"]["distrust"] > L.UNIT // 2 and got["pusher.test"]["verdict"] == "block"
    assert got["lone.test"]["verdict"] == "allow" and got["lone.test"]["trust"] == 0
    assert got["bad.test"]["distrust"] == math.floor(L.UNIT * (1.0 - L.ALPHA)) and got["bad.test"]["rule"] == "bad.test/"


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert L.judge(none, RULES).collect() == []
