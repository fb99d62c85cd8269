"""Derived web-archive records: response records become linked ``metadata`` and plain-text
``conversion`` records that keep refers-to identifiers, source headers and digests."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _spark as S
from ._html import Token, attributes, tokens

#: Elements that begin and end a line of plain text, and those whose content is no text.
LINES = frozenset("address article aside blockquote body br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section select table tbody td tfoot th thead title tr ul".split())
RAW, NESTED, FOREIGN = frozenset("script style textarea".split()), frozenset("noscript template svg".split()), frozenset(["svg"])
_SPACE = re.compile(r"[ \t\n\r\f\v ]+")
_TITLE_END = re.compile(r"</title\s*>", re.I)
_LANG = re.compile(r"[A-Za-z0-9-]+")


def _tokens(source: str) -> list[Token]:
    return tokens(source, RAW, NESTED, FOREIGN)


def _lines(found: list[Token]) -> str:
    lines: list[list[str]] = [[]]
    for kind, name, value, _ in found:
        if kind == "text":
            lines[-1].append(value)
        elif kind in ("gap", "hidden") or kind == "start" and name in FOREIGN and value.endswith("/"):
            lines[-1].append(" ")
        elif name in LINES:
            lines.append([])
    whole = (_SPACE.sub(" ", html.unescape(_SPACE.sub(" ", "".join(x)))).strip() for x in lines if x)
    return "\n".join(x for x in whole if x)


def plain_text(source: str) -> str:
    """Visible text: one line per block, character references decoded, white space in a
    line made one space, no empty lines."""
    return _lines(_tokens(source))


def _about(source: str, found: list[Token]) -> tuple[str, str, list[str]]:
    """Title, language and links in page order; comments and elements without text have none."""
    title = lang = None
    links = []
    for kind, name, value, at in found:
        if kind != "start":
            continue
        if name == "title" and title is None:
            end = _TITLE_END.search(source, at)
            title = html.unescape(source[at : end.start()]) if end else ""
        elif name == "html" and lang is None:
            m = _LANG.match(dict(reversed(attributes(value))).get("lang", ""))
            lang = m[0] if m else None
        elif name == "a" and (href := next((v for k, v in attributes(value) if k == "href"), None)) is not None:
            links.append(html.unescape(href))
    return title or "", lang or "", links


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """The same urn for the same parts, so a task that runs again repeats its ids."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def serialised(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one serialised record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _clean(value: str | None) -> str:
    return _SPACE.sub(" ", value or "").strip()


def derived(rid: str, uri: str, date: str, http: str, payload: str) -> list[dict]:
    """The metadata and the conversion record of one response."""
    found = _tokens(payload)
    raw, text = payload.encode("utf-8", "surrogatepass"), _lines(found).encode("utf-8", "surrogatepass")
    source = digest(raw)
    ids = {kind: record_id(kind, rid) for kind in ("metadata", "conversion")}
    title, lang, links = _about(payload, found)
    status, *fields = [x for x in http.replace("\r\n", "\n").split("\n") if x.strip()] or [""]
    lines = [("sourceStatus", status), *((f"sourceHeader-{k.strip()}", v) for k, _, v in (f.partition(":") for f in fields))]
    lines += [("title", title), ("language", lang), *(("outlink", x) for x in links)]
    about = "".join(f"{k}: {_clean(v)}\r\n" for k, v in lines if _clean(v)).encode("utf-8", "surrogatepass")
    out = []
    for kind, block, mime, other in (("metadata", about, "application/warc-fields", "conversion"), ("conversion", text, "text/plain; charset=utf-8", "metadata")):
        headers = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", rid), ("WARC-Refers-To-Target-URI", _clean(uri)), ("WARC-Target-URI", _clean(uri)), ("WARC-Refers-To-Date", date), ("WARC-Date", date),
                   ("WARC-Concurrent-To", ids[other]), ("WARC-Source-Payload-Digest", source), ("WARC-Block-Digest", digest(block)), ("Content-Type", mime), ("Content-Length", str(len(block)))]
        out.append({"record_type": kind, "record_id": ids[kind], "refers_to": rid, "concurrent_to": ids[other], "target_uri": uri, "source_digest": source, "block_digest": digest(block), "content_length": len(block), "record": serialised([h for h in headers if h[1]], block)})
    return out


SCHEMA = "key bigint, record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, source_digest string, block_digest string, content_length bigint, record binary"


def as_responses(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a page table: ``key, rid, uri, date, http, payload``. The
    table has no crawl date, so ``date`` stands for it."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n"))
    name = F.md5(F.concat_ws("\x00", F.coalesce(F.col(key_col).cast("string"), F.lit("-")), F.col(url_col), F.sha2(payload, 256)))
    rid = F.concat(F.lit("<urn:uuid:"), *(x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [name.substr(a, n)]), F.lit(">"))
    return pages.select(F.col(key_col).cast("bigint").alias("key"), rid.alias("rid"), F.col(url_col).alias("uri"), F.lit(date).alias("date"), head.alias("http"), payload.alias("payload"))


def derive(responses: DataFrame) -> DataFrame:
    """Two rows per response (``key, rid, uri, date, http, payload``): its metadata and
    its conversion record, each with its serialised bytes in ``record``.

    Both refer to the response's id and name each other as concurrent; the ids are a
    function of the response's, so repeated rows repeat them. A null payload is empty, a
    null header block is left out, a null uri stays null and is left out of the bytes.
    Extra columns are ignored; an empty table gives no rows. One page is held at a time.
    """
    S.text_batches(responses.sparkSession)

    def run(batches):
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for key, rid, uri, date, http, payload in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [r | {"key": key} for r in derived(rid or "", uri, date or "", http or "", payload or "")]
            types = {"key": pa.int64(), "content_length": pa.int64(), "record": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names)

    return responses.select("key", "rid", "uri", "date", "http", "payload").mapInArrow(run, SCHEMA)
