"""Records of legacy ARC and of WARC archives, as bytes."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha1

# The fields of a header line by version of the legacy format.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length",
    ],
}
# Names of the WARC format.
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What ends a WARC record, and an ARC record.
WARC_END, ARC_END = "\r\n\r\n", "\n"
#: HTTP header that names a page, and fields of a revisit beyond the standard ones.
PAGE_HEADER = "X-Page-Id"
PAYLOAD_LENGTH, REFERS_TO_PAGE = "WARC-Payload-Length", "WARC-Refers-To-Page"


@dataclass
class Record:
    """A record of an archive: its header's fields, the block, and where it begins."""

    fields: dict[str, str]
    block: bytes
    offset: int
    whole: bool = True


def arc_record(version: int, url: str, ip: str, date: str, kind: str, block: bytes, **more: str) -> bytes:
    """A legacy record without its end; fields of version 2 that are not given are ``-``."""
    given = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Archive-length": str(len(block))}
    given |= {name.replace("_", "-"): value for name, value in more.items()}
    line = " ".join(given.get(name, "-") for name in ARC_FIELDS[version])
    return f"{line}\n".encode() + block


def arc_opening(version: int, name: str, date: str) -> bytes:
    """The version block that a legacy archive begins with."""
    said = f"{version} 0 -\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", said, Filename=name)


def read_arc(data: bytes) -> Iterator[Record]:
    """The records of a legacy archive, the version block first.

    The length is the last word of a header line in either version; the version block says how
    many words a line has, and an address may hold blanks, so lines are split from the right. A
    record whose declared length goes beyond the archive is given with what is there.
    """
    names, at = None, 0
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        try:
            length = int(line.rsplit(" ", 1)[-1])
        except ValueError:
            raise ValueError(f"no length in the header line at {at}: {line[:80]!r}") from None
        block = data[end + 1 : end + 1 + length]
        if names is None:
            names = _declared(line, block)
        words = line.rsplit(" ", len(names) - 1)
        if len(words) < len(names):
            raise ValueError(f"{len(words)} of {len(names)} fields in the header line at {at}: {line[:80]!r}")
        yield Record(dict(zip(names, words)), block, at, len(block) == length)
        at = end + 1 + length


def _declared(line: str, block: bytes) -> list[str]:
    if not line.startswith("filedesc:"):
        raise ValueError("a legacy archive begins with a version block")
    said = block.decode("utf-8", "replace").split("\n")
    version = int(said[0].split(" ")[0])
    if version not in ARC_FIELDS:
        raise ValueError(f"version {version} of the legacy format")
    named = said[1].split() if len(said) > 1 else []
    # Names are declared by hand in old archives: they count where they are as many as the version has.
    return named if len(named) == len(ARC_FIELDS[version]) and named[-1] == "Archive-length" else ARC_FIELDS[version]


def http_response(payload: bytes, page_id: int | None) -> bytes:
    """The page as a server would send it."""
    named = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n{named}\r\n"
    return head.encode() + payload


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(head, headers in lower case, payload) of an HTTP response; all payload if it is none."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    end = block.find(b"\r\n\r\n")
    head, payload = (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    headers = dict(line.split(":", 1) for line in lines if ":" in line)
    return head, {name.strip().lower(): value.strip() for name, value in headers.items()}, payload


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1(data).digest()).decode()


def record_id(archive: str, offset: int) -> str:
    """The identifier of a legacy record, the same whenever it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def timestamp(date: str) -> str:
    """A date of a legacy header line as a WARC date; dates may end early, from the month on."""
    if not date.isdigit() or not 4 <= len(date) <= 14 or len(date) % 2:
        raise ValueError(f"date {date!r}")
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


@dataclass
class Origin:
    """The record that a revisit refers to."""

    record: str
    page_id: int | None
    date: str = field(default="")


def converted(record: Record, archive: str, origin: Origin | None = None) -> bytes:
    """The WARC record of a legacy record, without its end.

    The version block becomes ``warcinfo``, an HTTP response ``response``, or ``revisit`` without
    its payload if ``origin`` is given, and anything else ``resource``. Identifier and digests are
    made from the place and the bytes of the record, the date from its header line.
    """
    f = record.fields
    url, kind = f["URL"], f["Content-type"]
    head, _, payload = http_parts(record.block)
    named = {"WARC-Record-ID": record_id(archive, record.offset), "WARC-Date": timestamp(f["Archive-date"])}
    block = record.block
    if url.startswith("filedesc:"):
        said = block.decode("utf-8", "replace").strip().replace("\r", "").split("\n")
        block = "".join(f"description: {line}\r\n" for line in said).encode()
        named |= {"WARC-Type": "warcinfo", "WARC-Filename": archive, "Content-Type": "application/warc-fields"}
    else:
        if url != "-":
            named["WARC-Target-URI"] = url
        if f["IP-address"] not in ("-", "0.0.0.0"):
            named["WARC-IP-Address"] = f["IP-address"]
        named["WARC-Payload-Digest"] = digest(payload)
        if not head:
            named |= {"WARC-Type": "resource", "Content-Type": kind}
        else:
            named |= {"WARC-Type": "response", "Content-Type": "application/http;msgtype=response"}
    if origin is not None:
        block = head
        named |= {
            "WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": origin.record,
            PAYLOAD_LENGTH: str(len(payload)),
        }
        named |= {"WARC-Refers-To-Date": origin.date} if origin.date else {}
        named |= {} if origin.page_id is None else {REFERS_TO_PAGE: str(origin.page_id)}
    elif not record.whole:
        named["WARC-Truncated"] = "length"
    named |= {"WARC-Block-Digest": digest(block), "Content-Length": str(len(block))}
    lines = "".join(f"{name}: {value}\r\n" for name, value in named.items())
    return f"{WARC_VERSION}\r\n{lines}\r\n".encode() + block


def read_warc(data: bytes) -> Iterator[Record]:
    """The records of a WARC archive, by their declared lengths; block digests are verified."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : max(end, at)].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = {name: value.strip() for name, value in (line.split(":", 1) for line in lines[1:])}
        block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
        if fields.get("WARC-Block-Digest", digest(block)) != digest(block):
            raise ValueError(f"the record at {at} does not have its block's digest")
        yield Record(fields, block, at)
        at = end + 4 + len(block) + len(WARC_END)
