from __future__ import annotations

import gzip
import io
import json
import time
import zlib
from email.parser import BytesHeaderParser
from http.client import HTTPResponse

import pytest
import zstandard

from colonnade.llm import warc

PAGES = "page_id long, url string, html string, record string, kind string"
HTML = '<html><head><title>A &amp; B</title><meta name="d" content="x"><link href="/s.css"></head><body><a href="../z?q=1&amp;r">Link <b>text</b></a><p>Body</p><script src=x.js>no()</script></body></html>'


def records(spark, rows):
    return warc.derive_pages(spark.createDataFrame([(*r, "a", "b") for r in rows], PAGES)).collect()


def test_records_are_linked(spark):
    rows = records(spark, [(1, "http://h.example/a/b", HTML)])
    source, block = warc.response_record(1, "http://h.example/a/b", HTML, "1970-01-01T00:00:00Z")
    parsed = {r["kind"]: next(iter(warc.read_records(bytes(r["record"])))) for r in rows}
    assert set(parsed) == {"metadata", "conversion"}
    for r in rows:
        headers, body = parsed[r["kind"]]
        assert warc.find(headers, "WARC-Refers-To") == warc.find(source, "WARC-Record-ID") == r["refers_to"]
        assert warc.find(headers, "warc-target-uri") == "http://h.example/a/b"
        assert warc.find(headers, "WARC-Block-Digest") == warc.sha1_base32(body) == r["block_digest"]
        assert warc.find(headers, "WARC-Source-Payload-Digest") == warc.sha1_base32(HTML.encode()) == r["source_digest"]
        assert len(body) == r["content_length"]
    assert warc.find(parsed["conversion"][0], "WARC-Concurrent-To") == warc.find(parsed["metadata"][0], "WARC-Record-ID")
    assert parsed["conversion"][1].decode() == "A & B\nLink text\nBody"
    facts = json.loads(parsed["metadata"][1])["Envelope"]
    assert facts["WARC-Header-Metadata"] == {**dict(source), "Content-Length": str(len(block))} and facts["Actual-Content-Length"] == len(block)
    page = facts["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert page["HTML-Metadata"]["Head"] == {"Title": "A & B", "Metas": [{"name": "d", "content": "x"}]}
    assert [(x["path"], x["url"]) for x in page["HTML-Metadata"]["Links"]] == [("LINK@/href", "http://h.example/s.css"), ("A@/href", "http://h.example/z?q=1&r"), ("SCRIPT@/src", "http://h.example/a/x.js")]
    assert page["HTML-Metadata"]["Links"][1]["text"] == "Link text" and page["Headers"]["Content-Type"] == "text/html; charset=utf-8"


def test_odd_rows(spark):
    rows = records(spark, [(None, None, None), (2, "", ""), (2, "", ""), (3, "http://[x", "<a href='http://[y'>t"), (4, "u\r\nInjected: 1", "x" * 200_000)])
    assert len(rows) == 10 and len({r["record_id"] for r in rows}) == 8
    for r in rows:
        headers, _ = next(iter(warc.read_records(bytes(r["record"]))))
        assert not warc.find(headers, "Injected")
    assert records(spark, []) == []


def test_files_round_trip(spark, tmp_path):
    sources = [warc.response_record(i, f"http://h/{i}", HTML, "2020-01-01T00:00:00Z") for i in range(3)]
    info = ([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:0>")], b"software: x")
    data = [warc.write_record(h, b) for h, b in [info, *sources]]
    (tmp_path / "a.warc").write_bytes(b"".join(data) + b"WARC/1.1\r\ncut")
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(warc.gzip_member, data)))
    rows = warc.derive_files(spark, str(tmp_path)).collect()
    assert len(rows) == 12
    expected = {warc.find(h, "WARC-Record-ID") for h, _ in sources}
    assert {r["refers_to"] for r in rows} == expected


def test_other_encodings():
    headers, block = [("WARC-Type", "response"), ("WARC-Record-ID", "<x>")], b"HTTP/1.0 404 Gone\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\xe9"
    (_, facts, _), (_, text, _) = warc.derive(headers, block)
    assert text.decode() == "café" and json.loads(facts)["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["Response-Message"] == {"Version": "HTTP/1.0", "Status": "404 Gone"}
    assert warc.derive([("WARC-Type", "request"), ("WARC-Record-ID", "<x>")], block) == []


def test_repeated_headers_are_kept():
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", "<x>"), ("WARC-Concurrent-To", "<a>"), ("WARC-Concurrent-To", "<b>")]
    block = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nset-cookie: b=2\r\nContent-Type: text/html\r\n\r\n<p>x"
    (_, facts, _), _ = warc.derive(headers, block)
    told = json.loads(facts)["Envelope"]
    assert told["WARC-Header-Metadata"] == {"WARC-Type": "response", "WARC-Record-ID": "<x>", "WARC-Concurrent-To": ["<a>", "<b>"]}
    assert told["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"] == {"Set-Cookie": ["a=1", "b=2"], "Content-Type": "text/html"}


def encoded(name, body):
    if name == "raw deflate":
        c = zlib.compressobj(wbits=-15)
        return c.compress(body) + c.flush()
    return {"gzip": gzip.compress, "deflate": zlib.compress, "zstd": zstandard.compress, "identity": bytes}[name](body)


@pytest.mark.parametrize("name", ["gzip", "deflate", "raw deflate", "zstd", "identity"])
@pytest.mark.parametrize("chunked", [False, True])
def test_encoded_payloads(name, chunked):
    html = "<title>T</title><p>caf\u00e9 " + "x y " * 50_000
    body = encoded(name, html.encode())
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: {name.split()[-1]}\r\n"
    if chunked:
        parts = [body[i : i + 1000] for i in range(0, len(body), 1000)]
        body = b"".join(b"%x;ext=1\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"
        head += "Transfer-Encoding: chunked\r\n"
    (_, facts, _), (_, text, about) = warc.derive([("WARC-Type", "response"), ("WARC-Record-ID", "<x>")], head.encode() + b"\r\n" + body)
    assert text.decode() == "T\n" + ("caf\u00e9 " + "x y " * 50_000).strip() and about["title"] == "T"
    told = json.loads(facts)["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert told["Entity-Length"] == len(body) and told["Entity-Digest"] == warc.sha1_base32(body)


def test_damaged_and_unknown_encodings():
    head = [("WARC-Type", "response"), ("WARC-Record-ID", "<x>")]

    def text(name, body):
        return warc.derive(head, b"HTTP/1.1 200 OK\r\nContent-Encoding: " + name + b"\r\n\r\n" + body)[1][1].decode()

    assert text(b"br", b"<p>secret") == "" and text(b"gzip", b"<p>plain") == text(b"deflate", b"<p>plain") == text(b"zstd", b"<p>plain") == "plain"
    cut = gzip.compress(b"<p>" + b"a b " * 100_000)
    assert text(b"gzip", cut[: len(cut) // 2]).startswith("a b a b")


def independent(data):
    """Another reader: the standard library's mail and HTTP parsers."""
    stream, out = io.BytesIO(data), []
    while line := stream.readline():
        assert line == b"WARC/1.1\r\n"
        lines = []
        while (line := stream.readline()) != b"\r\n":
            lines.append(line)
        headers = BytesHeaderParser().parsebytes(b"".join(lines))
        out.append((headers.items(), stream.read(int(headers["Content-Length"]))))
        assert stream.read(4) == b"\r\n\r\n"
    return out


def test_records_against_another_reader(spark):
    rows = records(spark, [(i, f"http://h.example/{i}", HTML * (i % 4)) for i in range(20)])
    data = b"".join(bytes(r["record"]) for r in rows)
    theirs = independent(data)
    assert [(list(h), b) for h, b in warc.read_records(data)] == theirs == [(list(h), b) for h, b in warc.read_records(gzip.compress(data))]
    assert len(theirs) == 40 and all(dict(h)["WARC-Refers-To"] == r["refers_to"] for (h, _), r in zip(theirs, rows, strict=True))
    _, block = warc.response_record(1, "u", HTML, "d")

    class Socket:
        def makefile(self, _):
            return io.BytesIO(block)

    answer = HTTPResponse(Socket())
    answer.begin()
    assert (answer.status, answer.read()) == (200, warc.http_parts(block)[3])


def test_files_of_many_members_take_their_length():
    member = [warc.gzip_member(warc.write_record(*warc.response_record(i, f"http://h/{i}", HTML, "d"))) for i in range(50)]
    for n in (100, 800):
        began = time.process_time()
        assert sum(1 for _ in warc.read_records(b"".join(member * n))) == 50 * n
        took = time.process_time() - began
        assert took < 0.001 * 50 * n
    large = warc.write_record(*warc.response_record(1, "u", "z" * 5_000_000, "d"))
    assert [len(b) > 5_000_000 for _, b in warc.read_records(large + large)] == [True, True]
    assert list(warc.read_records(b"")) == list(warc.read_records(b"no records")) == list(warc.read_records(b"\x1f\x8bbad")) == []
