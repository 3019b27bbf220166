import base64
import hashlib
import random

from pyspark.sql import functions as F

from lakeloom.llm import warc as W

DATE = "2026-01-01T00:00:00Z"


def test_round_trip_of_records():
    rnd = random.Random(1)
    for _ in range(200):
        block = bytes(rnd.randrange(256) for _ in range(rnd.randint(0, 50))) + rnd.choice([b"", b"\r\n\r\n"])
        headers = [("WARC-Type", "x"), ("A", "b: c"), ("A", "é\nline")]
        got, back = W.parse_record(W.record_bytes(headers, block))
        assert back == block and got == [("WARC-Type", "x"), ("A", "b: c"), ("A", "é line"), ("Content-Length", str(len(block)))]
    for bad in (None, b"", b"junk", b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc", b"WARC/1.1\r\nX: y\r\n\r\nabc", b"WARC/1.1"):
        assert W.parse_record(bad) is None and W.derive(bad) == []


def test_derivatives_link_and_keep():
    page = ("<html><head><title>A &amp;\n B</title><script>x<p></script></head><body><nav><a href='/n?a=1&amp;b=2'>menu</a></nav>"
            "<p>One  <b>t</b>wo &lt;x&gt;<p>three<a HREF=\"http://o/\">four</a><!-- <a href='/no'> --></body>")
    data = W.response_record(7, "http://h/p", page, DATE)
    headers, block = W.parse_record(data)
    extra = W.record_bytes([h for h in headers if h[0] != "Content-Length"] + [("WARC-IP-Address", "192.0.2.1")], block)
    (k1, h1, b1), (k2, h2, b2) = W.derive(extra)
    m, c = dict(h1), dict(h2)
    source = dict(headers)
    assert (k1, k2) == ("metadata", "conversion")
    assert m["WARC-Refers-To"] == c["WARC-Refers-To"] == source["WARC-Record-ID"]
    assert m["WARC-Concurrent-To"] == c["WARC-Record-ID"] and c["WARC-Concurrent-To"] == m["WARC-Record-ID"]
    for d, b in ((m, b1), (c, b2)):
        assert d["WARC-Target-URI"] == "http://h/p" and d["WARC-Date"] == DATE and d["WARC-IP-Address"] == "192.0.2.1"
        assert d["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert b2.decode() == "menu\nOne two <x>\nthreefour"
    fields = b1.decode().split("\r\n")
    assert "title: A & B" in fields and "outlink: /n?a=1&b=2" in fields and "outlink: http://o/" in fields
    assert f"source-payload-digest: {source['WARC-Payload-Digest']}" in fields
    assert "source-payload-check: ok" in fields and "source-block-check: ok" in fields
    assert "source-header: Content-Type: text/html; charset=utf-8" in fields
    assert W.derive(extra) == W.derive(extra)


def test_other_sources():
    def made(kind, payload, headers=()):
        return W.derive(W.record_bytes([("WARC-Type", "response"), *headers],
                                       b"HTTP/1.1 404 No\r\nContent-Type: " + kind + b"\r\n\r\n" + payload))
    assert made(b"text/plain; charset=latin-1", "é<p>".encode("latin-1"))[1][2].decode() == "é<p>"
    assert made(b"text/html; charset=nope", b"<p>\xff")[1][2].decode() == "�"
    assert made(b"image/png", b"\x89PNG")[1][2] == b"" and made(b"text/html", b"")[1][2] == b""
    bad = made(b"text/html", b"x", [("WARC-Payload-Digest", "sha1:AAAA"), ("WARC-Block-Digest", "md5:00")])[0][2].decode()
    assert "source-payload-check: mismatch" in bad and "source-block-check: unknown" in bad and "source-status: HTTP/1.1 404 No" in bad
    assert W.derive(W.record_bytes([("WARC-Type", "request")], b"GET /")) == []


def test_tables(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (1, "http://a/", "<p>x</p>"), (None, None, None), (2, "", ""), (3, "u", "<p>long " + "w " * 60_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit(1))
    out = W.derivatives(W.responses_of_pages(pages, DATE), "page_id").collect()
    assert len(out) == 2 * len(rows)
    for r in out:
        headers, block = W.parse_record(bytes(r.record))
        assert block.decode() == r.block and len(block) == r.content_length and dict(headers)["WARC-Refers-To"] == r.refers_to
    texts = sorted((str(r.page_id), r.block) for r in out if r.record_type == "conversion")
    assert texts == sorted((str(i), W.visible_text(h or "")) for i, _, h in rows)
    mixed = spark.createDataFrame([(1, None), (2, bytearray(b"junk")), (3, bytearray(W.response_record(3, "u", "t", DATE)))], "k long, record binary")
    assert [r.k for r in W.derivatives(mixed, "k").collect()] == [3, 3]
    assert W.derivatives(W.responses_of_pages(pages.limit(0), DATE), "page_id").collect() == []
