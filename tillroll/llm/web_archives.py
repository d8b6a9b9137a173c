"""Conversion of legacy web archives to WARC, and pages written and read that way."""

from __future__ import annotations

import base64
import gzip
import re
from collections.abc import Iterator
from hashlib import sha1, sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import as_bytes
from tillroll.llm.token_output import shared_folder
from tillroll.llm.web_records import (
    ARC_END,
    ARC_FIELDS,
    PAGE_HEADER,
    PAYLOAD_LENGTH,
    REFERS_TO_PAGE,
    WARC_END,
    Origin,
    Record,
    arc_opening,
    arc_record,
    converted,
    http_parts,
    http_response,
    read_arc,
    read_warc,
    record_id,
    timestamp,
)
from tillroll.session import checkpoint, size_checked

#: Bytes after which an archive is closed; one record may be larger.
ARCHIVE = 16 << 20
#: Bytes from which a payload that was seen before is not kept again.
REVISITED = 1000
#: Date of the legacy records of pages, which have none.
CAPTURED = "20000101000000"

_LINES = "volume int, place bigint, record binary"
_SEEN = "archive string, payload binary, offsets array<bigint>, page_id bigint, offset bigint, record string, date string"
_PAGES = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _lines(volume: list[int], records: list[bytes], first: int) -> pa.RecordBatch:
    places = pa.array(range(first, first + len(records)), pa.int64())
    columns = [pa.array(volume, pa.int32()), places, pa.array(records, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["volume", "place", "record"])


def _write(lines: DataFrame, folder: str, end: str) -> None:
    # One record is one line of a text file, with the end of a record as line separator: the
    # files are plain archives, gzipped, and Spark commits those of a task that succeeded.
    ordered = lines.sortWithinPartitions("volume", "place")
    text = ordered.select("volume", F.col("record").cast("string").alias("value"))
    text.write.partitionBy("volume").options(lineSep=end, compression="gzip").text(folder)


def _address(url: str | None) -> str:
    # Header lines are parted by blanks.
    return re.sub(r"[\s\x00-\x1f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), (url or "").strip()) or "-"


def _legacy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    volume, size, place = -1, ARCHIVE, 0
    for batch in batches:
        volumes, records = [], []
        rows = zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), as_bytes(batch.column("html")))
        for page_id, url, payload in rows:
            if size >= ARCHIVE:
                volume, size = volume + 1, 0
                version = sorted(ARC_FIELDS)[(task + volume) % len(ARC_FIELDS)]
                records.append(arc_opening(version, f"pages-{task}-{volume}.arc", CAPTURED)[: -len(ARC_END)])
                volumes.append(volume)
            block = http_response(payload, page_id)
            more = {"Result_code": "200", "Filename": f"pages-{task}-{volume}.arc", "Offset": str(size)}
            record = arc_record(version, _address(url), "0.0.0.0", CAPTURED, "text/html", block, **more)
            size += len(record)
            records.append(record)
            volumes.append(volume)
        if records:
            yield _lines(volumes, records, place)
            place += len(records)


def write_arc(pages: DataFrame, folder: str) -> None:
    """Legacy archives of both versions with a record per page, the html as its payload (null: none)."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    _write(rows.mapInArrow(_legacy, _LINES), folder, ARC_END)


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, content): the files under ``folder``, named by their folder and file name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.regexp_extract("path", "[^/]+/[^/]+$", 0).alias("archive"), "content")


def _unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for n in range(batch.num_rows):  # archive by archive, whatever a batch holds
        yield batch.slice(n, 1).to_pylist()[0]


def _page_id(headers: dict[str, str]) -> int | None:
    named = headers.get(PAGE_HEADER.lower(), "")
    return int(named) if re.fullmatch(r"-?\d+", named) else None


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Per archive and payload: where it is, and which of its records would be the one to keep.
    for batch in batches:
        for row in _rows(batch):
            found: dict[bytes, list[tuple]] = {}
            for record in read_arc(_unpacked(row["content"])):
                head, headers, payload = http_parts(record.block)
                if head and record.whole and len(payload) >= REVISITED:
                    entry = (_page_id(headers), record.offset, timestamp(record.fields["Archive-date"]))
                    found.setdefault(sha256(payload).digest(), []).append(entry)
            best = [max(e, key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for e in found.values()]
            columns = [
                pa.array([row["archive"]] * len(found), pa.string()),
                pa.array(list(found), pa.binary()),
                pa.array([[x[1] for x in e] for e in found.values()], pa.list_(pa.int64())),
                pa.array([x[0] for x in best], pa.int64()),
                pa.array([x[1] for x in best], pa.int64()),
                pa.array([record_id(row["archive"], x[1]) for x in best], pa.string()),
                pa.array([x[2] for x in best], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SEEN.split(", ")])


def revisits(files: DataFrame) -> DataFrame:
    """(archive, revisits): per archive the records that repeat a payload, and what they refer to.

    The record of the largest page id stays (ids that are missing are the smallest; of equal ones
    the last archive and place). An archive brings each payload once, however often it holds it,
    so what a hot payload shuffles are as many rows as archives.
    """
    seen = checkpoint(files.mapInArrow(_seen, _SEEN))
    stays = F.max(F.struct("page_id", "archive", "offset", "record", "date")).alias("origin")
    times = F.sum(F.size("offsets")).alias("times")
    repeated = checkpoint(seen.groupBy("payload").agg(stays, times).where("times > 1").drop("times"))
    each = seen.select("archive", "payload", F.explode("offsets").alias("place")).join(size_checked(repeated), "payload")
    others = each.where((F.col("archive") != F.col("origin.archive")) | (F.col("place") != F.col("origin.offset")))
    entry = F.struct("place", F.col("origin.record").alias("record"), F.col("origin.page_id").alias("page_id"), F.col("origin.date").alias("date"))
    return others.groupBy("archive").agg(F.collect_list(entry).alias("revisits"))


def _converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    volume, place = 0, 0
    for batch in batches:
        for row in _rows(batch):
            origins = {r["place"]: Origin(r["record"], r["page_id"], r["date"]) for r in row["revisits"] or []}
            records = [
                converted(record, row["archive"], origins.get(record.offset)) for record in read_arc(_unpacked(row["content"]))
            ]
            yield _lines([volume] * len(records), records, place)
            volume, place = volume + 1, place + len(records)


def convert(spark: SparkSession, source: str, folder: str) -> None:
    """The legacy archives under ``source`` as WARC archives under ``folder``, one for one.

    Header lines are read by the version each archive declares, and blocks by their declared
    lengths. A payload of REVISITED bytes or more that several records have is kept in one and
    revisited by the others. An archive that is damaged fails the conversion, one that ends early
    gives a truncated last record.
    """
    files = archives(spark, source)
    known = size_checked(checkpoint(revisits(files)))
    _write(files.join(known, "archive", "left").mapInArrow(_converted, _LINES), folder, WARC_END)


def _page(record: Record) -> tuple | None:
    fields = record.fields
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    _, headers, payload = http_parts(record.block)
    declared = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if kind == "response" and sha1(payload).hexdigest() != declared:
        raise ValueError(f"{fields['WARC-Record-ID']} does not have its payload's digest")
    size = int(fields[PAYLOAD_LENGTH]) if kind == "revisit" else len(payload)
    refers = fields.get(REFERS_TO_PAGE)
    return _page_id(headers), size, declared, kind, None if refers is None else int(refers)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for row in _rows(batch):
            found = [page for record in read_warc(_unpacked(row["content"])) if (page := _page(record))]
            if found:
                columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PAGES.split(", ")])


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the pages of WARC archives.

    Digests are SHA-1 in hexadecimal, verified against block and payload. A revisit has the size
    and digest of the payload it refers to.
    """
    return archives(spark, folder).mapInArrow(_read, _PAGES)


def archived(pages: DataFrame) -> DataFrame:
    """The pages, written as legacy archives, converted to WARC, and read from there.

    A row per page: repeated rows each, of which all but one revisit it; null html is an empty
    payload; pages without id or url have none in their records; an empty table gives no rows;
    other columns are not read.
    """
    spark = pages.sparkSession
    legacy, modern = shared_folder(spark), shared_folder(spark)
    write_arc(pages, legacy)
    convert(spark, legacy, modern)
    return read_pages(spark, modern)
