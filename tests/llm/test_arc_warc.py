from __future__ import annotations

import gzip
import hashlib
import io

import pytest
from messy import prose

from tributary.llm import arc_warc
from tributary.session import scratch_path

PAGE_SCHEMA = "page_id long, url string, html string, payload string, digest int"


def pages():
    big, small = "<p>" + prose(1, 60) + "</p>\r\n\r\nmore", "<p>tiny</p>"
    rows = [(1, "http://a/x", big), (2, "http://a/y", big), (3, "http://a/z", small), (4, "http://a/w", small),
            (5, None, None), (6, "", ""), (None, "http://n/1", big), (8, "http://a b/\tc　d", "é" * 50),
            (9, "http://q/", "é" * 49 + "e"), (9, "http://q/", "é" * 49 + "e"), (10, "u", "\x00\r\nWARC/1.0\r\n" * 12),
            (11, "http://v1\n/", "HTTP/1.1 200 OK\r\n\r\n" + big), (0, "http://long", prose(2, 40_000))]
    return [(i, u, h, "p", 1) for i, u, h in rows]


def expected(rows):
    out = []
    for i, _, h, *_ in rows:
        body = (h or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == body and r[0] is not None]
        revisit = i is not None and len(body) >= 100 and min(same) < i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                    min(same) if revisit else None))
    return sorted(out, key=str)


def run(spark, frame, **options):
    arc, warc = scratch_path(spark, "t-arc"), scratch_path(spark, "t-warc")
    arc_warc.write_arc(frame, arc, **options)
    arc_warc.convert(spark, arc, warc)
    return arc, warc


@pytest.mark.parametrize("file_bytes", [1 << 20, 500])
def test_round_trip(spark, file_bytes):
    frame = spark.createDataFrame(pages(), PAGE_SCHEMA).repartition(3)
    arc, warc = run(spark, frame, file_bytes=file_bytes)
    back = arc_warc.read_warc(spark, warc)
    got = [tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == expected(pages())
    payloads = {r.page_id: bytes(r.payload) for r in back.where("record_type = 'response' and page_id is not null").collect()}
    assert all(payloads[i] == (h or "").encode() for i, _, h, *_ in pages() if i in payloads)
    assert back.select("record_id").distinct().count() == len(pages())
    lost = back.where("refers_to is not null").select("refers_to_id").subtract(back.select("record_id"))
    assert lost.count() == 0 and back.where("refers_to is not null").count() > 0
    assert back.where("date <> '2024-01-01T00:00:00Z'").count() == 0
    versions = {bytes(gzip.decompress(r.content)).split(b"\n")[1][:1]
                for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(arc).collect()}
    assert versions == {b"1", b"2"}


def test_empty_pages(spark):
    _, warc = run(spark, spark.createDataFrame([], PAGE_SCHEMA))
    assert arc_warc.read_warc(spark, warc).count() == 0


def test_a_much_copied_payload(spark):
    body = prose(3, 40)
    rows = [(i, f"http://h/{i}", body if i % 3 == 0 else f"{body} {i}", "", 0) for i in range(300)]
    _, warc = run(spark, spark.createDataFrame(rows, PAGE_SCHEMA).repartition(6))
    back = arc_warc.read_warc(spark, warc).collect()
    assert {r.page_id: r.refers_to for r in back} == {i: 0 if i % 3 == 0 and i else None for i in range(300)}


def arc(version, *records):
    return arc_warc.arc_head(version, "t") + b"\n" + b"\n".join(records) + b"\n"


def parsed(content):
    return list(arc_warc.parse_arc(io.BufferedReader(io.BytesIO(content))))


def test_version_specific_lines_and_declared_lengths():
    one = arc_warc.arc_record(1, "http://x/", "19970102030405", "t", b"HTTP/1.0 200\r\n\r\nline\n\nline")
    two = arc_warc.arc_record(2, "http://y/", "20010203", "t", b"no http\n")
    assert parsed(arc(1, one, one))[1] == (1, "http://x/", "0.0.0.0", "19970102030405", "text/html", None,
                                           b"HTTP/1.0 200\r\n\r\nline\n\nline", None)
    assert parsed(arc(2, two))[0][5:] == ("200", b"no http\n", None)
    assert arc_warc.split_http(b"no http\n") == (b"", b"no http\n")
    assert arc_warc.warc_date("20010203") == "2001-02-03T00:00:00Z"


def test_legacy_lines_with_spaces():
    lines = [(1, b"http://a/x y z 10.0.0.1 19970102030405 text/html; charset=utf-8 3",
              ("http://a/x y z", "10.0.0.1", "19970102030405", "text/html; charset=utf-8", None)),
             (1, b"dns:a 20000101000000 1.2.3.4 20000101000001 text/dns 3",
              ("dns:a 20000101000000", "1.2.3.4", "20000101000001", "text/dns", None)),
             (2, b"http://b/?q=1 2 ::1 20010203040506 text/html; a=b; c 404 - http://l 77 f.arc 3",
              ("http://b/?q=1 2", "::1", "20010203040506", "text/html; a=b; c", "404"))]
    for version, line, expected_ in lines:
        (entry,) = parsed(arc(version, line + b"\nabc"))
        assert entry[1:6] == expected_ and entry.content == b"abc" and entry.reason is None


def test_damage_becomes_rejects_and_the_rest_is_read():
    good = arc_warc.arc_record(1, "http://x/", "19970102030405", "t", b"good")
    two = arc_warc.arc_record(2, "http://y/", "20010203", "t", b"two")
    bad_date = b"http://d/ 1.1.1.1 20011301000000 text/html 3\nabc"
    long = b"http://l/ 1.1.1.1 20010101000000 text/html 9999\nabc"
    for content, reasons, kept in [
        (arc(1, good, bad_date, good), ["header line"], 2), (arc(1, two, good), ["header line"], 1),
        (arc(1, good, long, good, good), ["9999 bytes declared"], 3), (arc(1, good)[:-3], ["4 bytes declared"], 0),
        (arc(1, good, b"\xff\x00 junk\nmore junk", good), ["header line"], 2),
        (b"http://x 1 2 3 4\n", ["no version block"], 0), (arc(1, good).replace(b"\n1 0", b"\n7 0"), ["unknown version"], 0),
        (b"filedesc:// 0 0 t x\n", ["no version block"], 0), (b"", [], 0),
    ]:
        entries = parsed(content)
        found = [e.reason for e in entries if e.reason]
        assert len(found) == len(reasons) and all(f.startswith(r) for f, r in zip(found, reasons, strict=True)), found
        assert [e.content for e in entries if not e.reason] == [b"good"] * kept
        assert [e.number for e in entries] == list(range(len(entries)))
    whole = gzip.compress(arc(1, *[good] * 2000), 0)
    cut = list(arc_warc.parse_arc(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(whole[:len(whole) // 2])))))
    assert cut[-1].reason and len(cut) > 100 and all(e.reason is None for e in cut[:-1])


def test_every_reference_resolves(spark, tmp_path):
    """Several capture dates, repeated rows, content without HTTP head, rejects."""
    body = "<p>" + prose(1, 60)

    def record(i, date, url):
        return arc_warc.arc_record(1, url, date, "t", arc_warc.http_block(i, body.encode()))

    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "a.gz").write_bytes(gzip.compress(arc(
        1, record(7, "19990101000000", "http://b"), record(3, "19970102030405", "http://a"), b"dirty line",
        record(3, "19970102030405", "http://a"), record(9, "20010101", "http://c d"))))
    (tmp_path / "arc" / "b.gz").write_bytes(gzip.compress(arc(
        1, record(3, "19980102030405", "http://a"), record(8, "19980102030405", "http://x"),
        b"http://t 1.1.1.1 19980102030405 text/plain; charset=x 5\nplain")))
    arc_warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"), rejects_path=str(tmp_path / "rejects"))
    back = arc_warc.read_warc(spark, str(tmp_path / "warc")).collect()
    by_id = {r.record_id: r for r in back}
    assert len(by_id) == len(back) == 7
    revisits = [r for r in back if r.record_type == "revisit"]
    assert sorted((r.page_id, r.refers_to) for r in revisits) == [(7, 3), (8, 3), (9, 3)]
    for r in revisits:
        of = by_id[r.refers_to_id]
        assert (of.record_type, of.page_id, of.payload_digest) == ("response", 3, r.payload_digest)
    assert {r.url for r in back} == {"http://a", "http://b", "http://c%20d", "http://x", "http://t"}
    (reject,) = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert (reject.number, reject.reason, bytes(reject.content)) == (2, "header line", b"dirty line\n")
