"""Legacy archives, their conversion, and pages read back, against plain Python."""

from __future__ import annotations

from collections import defaultdict
from hashlib import sha1

import pytest

from tillroll.llm import web_archives
from tillroll.llm.web_records import (
    Origin,
    Record,
    arc_opening,
    arc_record,
    converted,
    digest,
    http_parts,
    http_response,
    read_arc,
    read_warc,
    record_id,
    timestamp,
)

NESTED = "y\r\n\r\nWARC/1.1\r\n\r\n\n\n"
PAGES = [
    (1, "http://a/", "x" * 1500), (2, None, "x" * 1500), (None, "http://b c/\n", "x" * 1500),
    (5, "u", NESTED * 100), (6, "u", NESTED * 100), (6, "u", NESTED * 100),
    (7, "", None), (8, "", ""), (9, "z", "short"), (10, "z", "short"),
    (None, None, "é" * 600), (None, None, "é" * 600), (11, "http://q", "\n\n\nabc"), (-4, "x", "é" * 499),
    (12, "x", "1" * 999), (13, "x", "1" * 999), (14, "x", "2" * 1000), (15, "x", "2" * 1000), (16, "l", "long " * 400_000),
]
SCHEMA = "page_id bigint, url string, html string, archive string, record string, payload string"


def plain(pages: list[tuple]) -> list[tuple]:
    groups = defaultdict(list)
    for page_id, _, html, *_ in pages:
        groups[(html or "").encode()].append(page_id)
    rows = []
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for place, page_id in enumerate(ids, 1):
            revisit = len(payload) >= 1000 and place < len(ids)
            rows.append(
                (page_id, len(payload), sha1(payload).hexdigest(), *(("revisit", ids[-1]) if revisit else ("response", None)))
            )
    return sorted(rows, key=repr)


def found(pages) -> list[tuple]:
    return sorted((tuple(r) for r in web_archives.archived(pages).collect()), key=repr)


@pytest.mark.parametrize("size", [4000, 16 << 20])
def test_pages_through_both_formats(spark, monkeypatch, size):
    monkeypatch.setattr(web_archives, "ARCHIVE", size)
    rows = [(*page, "a", "r", "p") for page in PAGES] + [(100 + i, "h", "hot" * 500, "a", "r", "p") for i in range(300)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == plain(rows)


def test_no_pages(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("version", [1, 2])
def test_legacy_archive_by_version(version):
    block = http_response(b"payload", 3)
    data = arc_opening(version, "old.arc", "19990312010203")
    data += b"\n" + arc_record(version, "http://a/with blank", "10.0.0.1", "199903120102", "text/html", block)
    data += b"\n" + arc_record(version, "dns:a", "10.0.0.2", "19990312010204", "text/dns", b"a 1 IN A 10.0.0.1\n") + b"\n"
    opening, page, name = read_arc(data)
    assert page.fields["URL"] == "http://a/with blank" and page.block == block and page.whole
    assert data[page.offset :].startswith(b"http://a/with blank")
    assert name.block == b"a 1 IN A 10.0.0.1\n"

    made = b"".join(converted(r, "old.arc") + b"\r\n\r\n" for r in (opening, page, name))
    info, response, resource = read_warc(made)
    assert [r.fields["WARC-Type"] for r in (info, response, resource)] == ["warcinfo", "response", "resource"]
    assert response.fields["WARC-Date"] == "1999-03-12T01:02:00Z"
    assert response.fields["WARC-IP-Address"] == "10.0.0.1"
    assert response.fields["WARC-Record-ID"] == record_id("old.arc", page.offset) != resource.fields["WARC-Record-ID"]
    assert response.fields["WARC-Payload-Digest"] == digest(b"payload")
    assert response.fields["WARC-Block-Digest"] == digest(block) and response.block == block
    assert resource.fields["Content-Type"] == "text/dns" and resource.fields["WARC-Target-URI"] == "dns:a"


def test_declared_field_names_and_lengths():
    said = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n\n"
    data = b"filedesc://o 0.0.0.0 2001 text/plain %d\n" % len(said) + said
    data += b"\nhttp://a 1.1.1.1 2001 text/html 9\nab\n\ncd\nef\nhttp://b 1.1.1.1 2001 text/html 50\ncut"
    _, first, last = read_arc(data)
    assert first.block == b"ab\n\ncd\nef" and first.whole
    assert last.block == b"cut" and not last.whole
    assert b"WARC-Truncated: length" in converted(last, "o")


def test_revisit_keeps_the_head_only():
    record = Record(dict(zip(["URL", "IP-address", "Archive-date", "Content-type"], ["http://a", "-", "2001", "t"])), http_response(b"p" * 2000, 4), 9)
    (made,) = read_warc(converted(record, "o", Origin("<urn:uuid:1>", 8, "2001-01-01T00:00:00Z")) + b"\r\n\r\n")
    assert made.fields["WARC-Type"] == "revisit" and made.fields["WARC-Refers-To"] == "<urn:uuid:1>"
    assert http_parts(made.block)[2] == b"" and made.fields["WARC-Payload-Digest"] == digest(b"p" * 2000)


def test_damage_is_told():
    with pytest.raises(ValueError, match="version block"):
        list(read_arc(b"http://a 1.1.1.1 2001 text/html 3\nabc"))
    with pytest.raises(ValueError, match="version 3"):
        list(read_arc(b"filedesc://o 0.0.0.0 2001 text/plain 6\n3 0 x\n"))
    with pytest.raises(ValueError, match="fields"):
        list(read_arc(arc_opening(2, "o", "2001") + b"\nhttp://a 2001 3\nabc"))
    record = converted(next(read_arc(arc_opening(1, "o", "2001"))), "o")
    with pytest.raises(ValueError, match="digest"):
        list(read_warc(record[:-3] + b"xyz\r\n\r\n"))
    with pytest.raises(ValueError, match="no record"):
        list(read_warc(b"something else"))


def test_dates():
    assert timestamp("1996") == "1996-01-01T00:00:00Z"
    assert timestamp("19961231235958") == "1996-12-31T23:59:58Z"
    for bad in ("", "199", "1996-1-1", "199612312359581"):
        with pytest.raises(ValueError):
            timestamp(bad)
