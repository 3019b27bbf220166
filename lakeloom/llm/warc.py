"""WARC derivatives: linked metadata and plain-text conversion records of response records.

A record is its bytes (``WARC/1.1`` header lines, block, two line ends). For every response
record the builder makes

- a ``metadata`` record (``application/warc-fields``): title, outlinks, HTTP status and
  header lines, and the source's length, type and digests, with the verdict of checking them;
- a ``conversion`` record (``text/plain``): the visible text of an HTML or text payload,
  one block a line.

Both refer to the response (``WARC-Refers-To``, with its target URI and date), to each other
(``WARC-Concurrent-To``), carry over the source's own header lines (all but those that
describe its block) and hold the digest of their block. Record ids are name-based UUIDs of
the source id and the kind, so a task that runs again writes the same records.

One pass, row by row, no shuffle. Defined results: rows that are null, no WARC record or no
response have no derivatives; a missing digest is reported as absent, a wrong one as a
mismatch; an empty payload converts to an empty text; an unknown charset is read as UTF-8,
bad bytes as U+FFFD; repeated rows are converted each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

VERSION = "WARC/1.1"
# Header names that describe a record's own block or identity.
_OWN = frozenset(
    "warc-type warc-record-id warc-block-digest warc-payload-digest warc-concurrent-to warc-refers-to content-type "
    "content-length warc-truncated warc-segment-number warc-identified-payload-type".split())

_DROP = re.compile(r"<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<title\b.*?(?:</title\s*>|\Z)",
                   re.S | re.I)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|"
    r"main|nav|ol|p|pre|section|table|td|th|tr|ul|br)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*(?:>|\Z)")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CHARSET = re.compile(r"charset\s*=\s*\"?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _line(text: str) -> str:
    return " ".join(text.split())


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """Serialise; ``Content-Length`` is added, line ends inside values become spaces."""
    head = [VERSION, *[f"{k}: {_line(v)}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes | None) -> tuple[list[tuple[str, str]], bytes] | None:
    """(headers, block) of a record's bytes, or None where they are none."""
    if not data or not data.startswith(b"WARC/"):
        return None
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark:
        return None
    headers = [(k.strip(), v.strip()) for k, _, v in
               (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:]) if k]
    size = {k.lower(): v for k, v in headers}.get("content-length", "")
    if not size.isdigit() or int(size) > len(rest):
        return None
    return headers, rest[:int(size)]


def response_record(key, url: str | None, page: str | None, date: str) -> bytes:
    """A response record of a crawled page."""
    payload = (page or "").encode()
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)) + payload
    uri = _line(url or "")
    return record_bytes([
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id(f"{key}\n{uri}\n{digest(payload)}")),
        ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(http)), ("Content-Type", "application/http; msgtype=response")], http)


def visible_text(page: str) -> str:
    """The text of a page without markup: one block a line, white space folded, empty lines left out."""
    text = _TAG.sub("", _BREAK.sub("\n", _DROP.sub(" ", page).replace("\n", " ")))
    return "\n".join(x for x in (" ".join(line.split()) for line in html.unescape(text).split("\n")) if x)


def _verdict(stated: str | None, data: bytes) -> str:
    if not stated:
        return "absent"
    if not stated.lower().startswith("sha1:"):
        return "unknown"
    return "ok" if stated[5:].upper() == digest(data)[5:] else "mismatch"


def derive(data: bytes | None) -> list[tuple[str, list[tuple[str, str]], bytes]]:
    """(kind, headers, block) of the two derivatives of a response record; none for other bytes."""
    record = parse_record(data)
    if record is None:
        return []
    headers, block = record
    source = {k.lower(): v for k, v in headers}
    if source.get("warc-type", "").lower() != "response":
        return []
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *fields = head.decode("utf-8", "replace").split("\r\n")
    kind = next((v.strip() for k, _, v in (f.partition(":") for f in fields) if k.strip().lower() == "content-type"), "")
    charset = _CHARSET.search(kind)
    try:
        page = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    markup = not kind or "html" in kind.lower() or "xml" in kind.lower()
    if markup:
        text = visible_text(page)
        found = _TITLE.search(page)
        title = _line(html.unescape(found[1])) if found else ""
        links = [_line(html.unescape(a or b or c)) for a, b, c in _LINK.findall(page)]
    else:
        text = page if kind.lower().startswith("text/") else ""
        title, links = "", []
    name = source.get("warc-record-id", digest(data))
    ids = {k: record_id(f"{name}\n{k}") for k in ("metadata", "conversion")}
    kept = [(k, v) for k, v in headers if k.lower() not in _OWN]
    own = [("title", title), ("source-status", status), ("source-content-type", kind),
           ("source-length", str(len(payload))),
           ("source-payload-digest", source.get("warc-payload-digest", "")),
           ("source-payload-check", _verdict(source.get("warc-payload-digest"), payload)),
           ("source-block-digest", source.get("warc-block-digest", "")),
           ("source-block-check", _verdict(source.get("warc-block-digest"), block)),
           *[("source-header", f) for f in fields if f], *[("outlink", x) for x in links]]
    blocks = {"metadata": "".join(f"{k}: {_line(v)}\r\n" for k, v in own).encode(), "conversion": text.encode()}
    types = {"metadata": "application/warc-fields", "conversion": "text/plain; charset=utf-8"}
    return [(k, [("WARC-Type", k), ("WARC-Record-ID", ids[k]), ("WARC-Refers-To", name),
                 ("WARC-Concurrent-To", ids["conversion" if k == "metadata" else "metadata"]), *kept,
                 ("WARC-Block-Digest", digest(b)), ("Content-Type", types[k])], b) for k, b in blocks.items()]


def responses_of_pages(pages: DataFrame, date: str, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(key, record)``: a response record of every row of a table of pages."""
    ship_package(pages.sparkSession)
    slim = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"))
    kind = slim.schema["key"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                records = [response_record(*r, date) for r in zip(*[c.to_pylist() for c in part.columns])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(records, pa.binary())], ["key", "record"])

    return slim.mapInArrow(rows, f"key {kind}, record binary").withColumnRenamed("key", key)


_FIELDS = [("record_type", "WARC-Type"), ("record_id", "WARC-Record-ID"), ("refers_to", "WARC-Refers-To"),
           ("concurrent_to", "WARC-Concurrent-To"), ("target_uri", "WARC-Target-URI"), ("warc_date", "WARC-Date"),
           ("content_type", "Content-Type"), ("block_digest", "WARC-Block-Digest")]


def derivatives(responses: DataFrame, key: str, record: str = "record") -> DataFrame:
    """Two rows for each response record: the key, the fields of the new record's header, the
    length of its block, the block as text and the whole record as bytes."""
    ship_package(responses.sparkSession)
    slim = responses.select(F.col(key).alias("key"), F.col(record).alias("record"))
    kind = slim.schema["key"].dataType.simpleString()
    names = ["key", *[n for n, _ in _FIELDS], "content_length", "block", "record"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                of, made = [], []
                for i, data in enumerate(part.column(1).to_pylist()):
                    for _, headers, block in derive(data):
                        of.append(i)
                        first = dict(reversed(headers))
                        made.append([first.get(h) for _, h in _FIELDS] + [len(block), block.decode(), record_bytes(headers, block)])
                if made:
                    cols = list(zip(*made))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(of)), *[pa.array(c, pa.string()) for c in cols[:len(_FIELDS)]],
                         pa.array(cols[-3], pa.int64()), pa.array(cols[-2], pa.string()), pa.array(cols[-1], pa.binary())], names)

    schema = ", ".join([f"key {kind}", *[f"{n} string" for n, _ in _FIELDS], "content_length long", "block string", "record binary"])
    return slim.mapInArrow(rows, schema).withColumnRenamed("key", key)
