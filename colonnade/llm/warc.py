"""WARC derivatives: for each response a metadata record and a plain-text conversion record, linked to it.

A response record gives two derived records. The *metadata* record holds, as JSON, the response's own WARC headers, its HTTP
status and headers, and what the page says about itself: title, meta tags and links. The *conversion* record holds the page's plain
text. Both carry WARC-Refers-To with the response's WARC-Record-ID, the target address, date and digests of the source, and digests of
their own block; the conversion record also names the metadata record as concurrent. Identifiers of derived records are made
from the source's identifier and the kind, so a second run, or a task that runs again, gives the same records.

Records are built one by one inside a scan; nothing is shuffled, and a task's memory is one batch of records.

Chunked and compressed payloads (gzip, deflate, zstd) are undone before they are read; digests remain those of the source.

Defined results: records other than responses with a record id give nothing; a response without HTTP header block is all payload; a payload of unknown encoding has no text; a null or empty
html is an empty payload, whose records have empty text and no links; a null address gives empty target headers; other columns are
ignored, whatever their names; repeated rows give repeated records; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import markup

# The record layout of the WARC 1.1 format.
VERSION = "WARC/1.1"
LINE = "\r\n"
#: Bytes that are read of a file, or inflated, at once.
PIECE = 1 << 16
#: Attributes that hold addresses, by element.
LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action", "source": "src", "embed": "src", "video": "src", "audio": "src"}

Headers = list[tuple[str, str]]


def sha1_base32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    """A record identifier made from a name, the same each time."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=4)}>"


def one_line(value: str) -> str:
    """A header value: line breaks and control characters become spaces."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def write_record(headers: Headers, block: bytes) -> bytes:
    """A record's bytes; Content-Length is added."""
    head = LINE.join([VERSION, *(f"{k}: {one_line(v)}" for k, v in headers), f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _inflated(data: memoryview) -> Iterator[bytes]:
    """The bytes of gzip members one after another, in pieces; what is damaged or cut off ends them."""
    at, member = 0, zlib.decompressobj(31)
    while at < len(data):
        fed = data[at : at + PIECE]
        try:
            out = member.decompress(fed, PIECE)
            while out:
                yield out
                out = b"" if member.eof else member.decompress(member.unconsumed_tail, PIECE)
        except zlib.error:
            return
        at += len(fed) - len(member.unused_data)
        if member.eof:
            member = zlib.decompressobj(31)


def read_records(data: bytes) -> Iterator[tuple[Headers, bytes]]:
    """The (headers, block) of each record of a WARC file, plain or gzipped, as they come: what is read of the file is inflated piece by piece and held no longer than its
    record. A cut-off last record is left out."""
    view = memoryview(data)
    pieces = _inflated(view) if data[:2] == b"\x1f\x8b" else (bytes(view[i : i + PIECE]) for i in range(0, len(view), PIECE))
    held, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        if at > PIECE:
            del held[:at]
            at = 0
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while (start := held.find(b"WARC/", at)) < 0:
            at = max(at, len(held) - 4)
            if not more():
                return
        at, seen = start, start
        while (stop := held.find(b"\r\n\r\n", max(seen - 3, at))) < 0:
            seen, before = len(held), at
            if not more():
                return
            seen -= before - at
        headers = header_lines(held[at:stop].decode("utf-8", "replace").split(LINE)[1:])
        length = find(headers, "Content-Length")
        if not length.isdigit():
            return
        at = stop + 4
        while len(held) - at < int(length):
            if not more():
                return
        yield headers, bytes(held[at : at + int(length)])
        at += int(length)


def header_lines(lines: list[str]) -> Headers:
    """Names and values of header lines, continued ones put together."""
    headers: Headers = []
    for line in lines:
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            headers.append((name.strip(), value.strip()))
    return headers


def find(headers: Headers, name: str, default: str = "") -> str:
    """The first value of a header; names are the same in any case."""
    return next((v for k, v in headers if k.lower() == name.lower()), default)


def response_record(page_id: object, url: str | None, html: str | None, date: str) -> tuple[Headers, bytes]:
    """The response record of a fetched page."""
    payload = (html or "").encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    digest = sha1_base32(payload)
    return [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id(f"response {page_id} {url} {digest}")),
        ("WARC-Date", date),
        ("WARC-Target-URI", url or ""),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", sha1_base32(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ], block


def http_parts(block: bytes) -> tuple[str, str, Headers, bytes]:
    """HTTP version, status, headers and payload of a response block."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not gap:
        return "", "", [], block
    lines = head.decode("latin-1").split(LINE)
    version, _, status = lines[0].partition(" ")
    return version, status, header_lines(lines[1:]), payload


def unchunked(payload: bytes) -> bytes:
    """The chunks of a chunked payload put together, as far as they are well formed; a payload that is not chunked after all as it is."""
    parts, at = [], 0
    while (stop := payload.find(b"\r\n", at)) >= 0:
        try:
            size = int(payload[at:stop].split(b";")[0], 16)
        except ValueError:
            break
        if not size:
            return b"".join(parts)
        parts.append(payload[stop + 2 : stop + 2 + size])
        at = stop + 4 + size
    return b"".join(parts) if parts else payload


def decoded_payload(headers: Headers, payload: bytes) -> bytes:
    """The payload without its transfer and content encodings. One whose encoding is unknown here has no content; damaged data give what came before the damage,
    and data that are not encoded as they say are taken as they are."""
    if "chunked" in find(headers, "Transfer-Encoding").lower():
        payload = unchunked(payload)
    for name in reversed([x.strip().lower() for x in find(headers, "Content-Encoding").split(",") if x.strip()]):
        if name in ("identity", "utf-8"):
            continue
        if name in ("gzip", "x-gzip"):
            payload = b"".join(_inflated(memoryview(payload))) if payload[:2] == b"\x1f\x8b" else payload
        elif name == "deflate":
            payload = _deflated(payload)
        elif name == "zstd":
            payload = _zstd(payload)
        else:
            return b""
    return payload


def _deflated(payload: bytes) -> bytes:
    """Zlib data, or, as some servers send, bare deflate data."""
    for bits in (15, -15):
        inflater, out = zlib.decompressobj(bits), []
        try:
            for at in range(0, len(payload), PIECE):
                out.append(inflater.decompress(payload[at : at + PIECE]))
        except zlib.error:
            pass
        if any(out):
            return b"".join(out)
    return payload


def _zstd(payload: bytes) -> bytes:
    out, reader = [], zstandard.ZstdDecompressor().stream_reader(payload, read_across_frames=True)
    try:
        while piece := reader.read(PIECE):
            out.append(piece)
    except zstandard.ZstdError:
        pass
    return b"".join(out) or payload


def charset(headers: Headers, payload: bytes) -> str:
    """What the HTTP header, else an early meta tag, names as encoding and Python knows; UTF-8 otherwise."""
    for told in (find(headers, "Content-Type"), payload[:1024].decode("latin-1")):
        if named := re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", told, re.I):
            try:
                "".encode(named[1])
            except LookupError:
                continue
            return named[1]
    return "utf-8"


def page_facts(html: str, base: str) -> tuple[str, list[dict], list[dict], str]:
    """Title, meta tags, links (made absolute) and plain text of a page, in one reading."""
    title, metas, links, lines, held = "", [], [], [], []
    anchor: dict | None = None
    words: list[str] = []

    def line_ends() -> None:
        if held and (line := markup.squeeze(markup.decode("".join(held)))):
            lines.append(line)
        held.clear()

    for kind, name, rest in markup.events(html):
        if kind == "text":
            held.append(name)
            if anchor is not None:
                words.append(name)
            continue
        if kind == "raw":
            if name == "title" and not title:
                title = markup.squeeze(markup.decode(rest))
            if name not in markup.RAW:
                held.append(rest)
            continue
        if name in markup.BLOCK or name in ("br", "title"):
            line_ends()
        if kind == "end":
            if name == "a" and anchor is not None:
                anchor["text"] = markup.squeeze(markup.decode("".join(words)))
                anchor = None
            continue
        if name == "meta":
            metas.append(markup.attributes(rest))
        elif name in LINKS and rest:
            attributes = markup.attributes(rest)
            if address := attributes.get(LINKS[name], "").strip():
                try:
                    address = urljoin(base, address)
                except ValueError:
                    pass
                links.append(link := {"path": f"{name.upper()}@/{LINKS[name]}", "url": address})
                if name == "a":
                    anchor, words = link, []
    line_ends()
    return title, metas, links, "\n".join(lines)


def by_name(headers: Headers) -> dict[str, str | list[str]]:
    """Headers by name, in whatever case: the value, or all values in order where a name is repeated, under its first spelling."""
    spelt: dict[str, str] = {}
    out: dict[str, list[str]] = {}
    for name, value in headers:
        out.setdefault(spelt.setdefault(name.lower(), name), []).append(value)
    return {name: values if len(values) > 1 else values[0] for name, values in out.items()}


def derive(headers: Headers, block: bytes) -> list[tuple[Headers, bytes, dict]]:
    """The metadata and the conversion record of a response, each with facts about it; none for other records."""
    source = find(headers, "WARC-Record-ID")
    if find(headers, "WARC-Type") != "response" or not source:
        return []
    url, date = find(headers, "WARC-Target-URI"), find(headers, "WARC-Date")
    version, status, http, payload = http_parts(block)
    page = decoded_payload(http, payload)
    title, metas, links, text = page_facts(page.decode(charset(http, page), "replace"), url)
    digest = find(headers, "WARC-Payload-Digest") or sha1_base32(payload)
    envelope = {
        "Envelope": {
            "Format": "WARC",
            "WARC-Header-Length": sum(len(k.encode()) + len(v.encode()) + 4 for k, v in headers),
            "Block-Digest": find(headers, "WARC-Block-Digest") or sha1_base32(block),
            "Actual-Content-Length": len(block),
            "WARC-Header-Metadata": by_name(headers),
            "Payload-Metadata": {
                "Actual-Content-Type": find(headers, "Content-Type"),
                "HTTP-Response-Metadata": {
                    "Response-Message": {"Version": version, "Status": status},
                    "Headers": by_name(http),
                    "Entity-Length": len(payload),
                    "Entity-Digest": digest,
                    "HTML-Metadata": {"Head": {"Title": title, "Metas": metas}, "Links": links},
                },
            },
        }
    }
    ids = {kind: record_id(f"{kind} {source}") for kind in ("metadata", "conversion")}
    out = []
    for kind, content, body in (("metadata", "application/json", json.dumps(envelope, ensure_ascii=False).encode()), ("conversion", "text/plain", text.encode())):
        own = sha1_base32(body)
        linked: Headers = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", ids[kind]),
            ("WARC-Date", date),
            ("WARC-Target-URI", url),
            ("WARC-Refers-To", source),
            ("WARC-Refers-To-Target-URI", url),
            ("WARC-Refers-To-Date", date),
            ("WARC-Source-Payload-Digest", digest),
            ("WARC-Block-Digest", own),
            ("Content-Type", content),
        ]
        if kind == "conversion":
            linked.insert(5, ("WARC-Concurrent-To", ids["metadata"]))
        out.append((linked, body, {"title": title, "n_links": len(links), "n_chars": len(text), "digest": own, "source_digest": digest}))
    return out


DERIVED = "page_id long, kind string, record_id string, refers_to string, target_uri string, content_length long, block_digest string, source_digest string, title string, n_links int, n_chars long, record binary"


def derive_pages(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The derived records of pages (page_id, url, html), two for each row; ``record`` is the record as it goes to a file."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows: list[tuple] = []
                for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    # The response goes through a record's bytes, as it would through a file.
                    derived = (x for response in read_records(write_record(*response_record(page_id, url, html, date))) for x in derive(*response))
                    for headers, block, facts in derived:
                        value = dict(headers)
                        rows.append((page_id, value["WARC-Type"], value["WARC-Record-ID"], value["WARC-Refers-To"], value["WARC-Target-URI"], len(block), facts["digest"], facts["source_digest"], facts["title"], facts["n_links"], facts["n_chars"], write_record(headers, block)))
                kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), *[pa.string()] * 3, pa.int32(), pa.int64(), pa.binary()]
                names = [x.split()[0] for x in DERIVED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(build, DERIVED)


def derive_files(spark: SparkSession, path: str) -> DataFrame:
    """The derived records of the WARC files under a path: source file, kind, record_id, refers_to and record. A file is one row, so keep files at the usual gigabyte."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                name = batch.column(0)[row].as_py()
                for headers, block in read_records(batch.column(1)[row].as_buffer().to_pybytes()):
                    for linked, body, _ in derive(headers, block):
                        value = dict(linked)
                        cells = [name, value["WARC-Type"], value["WARC-Record-ID"], value["WARC-Refers-To"], write_record(linked, body)]
                        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names=["file", "kind", "record_id", "refers_to", "record"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(build, "file string, kind string, record_id string, refers_to string, record binary")


def gzip_member(record: bytes) -> bytes:
    """A record as the gzip member that goes to a .warc.gz file; the members of a file stand one after another."""
    return gzip.compress(record, mtime=0)
