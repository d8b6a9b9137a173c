"""Token ids in compressed files, in ascending order of their documents."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import offsets
from tillroll.llm.range_coder import compress, decompress
from tillroll.llm.word_tokens import VOCABULARY, folded, text_slices, word_ids
from tillroll.session import lookup

#: Id that ends every document.
END = 1
#: Ids of a frame, about: what a task codes at once, in blocks of its own.
FRAME = 1 << 22

#: Bytes of text whose words are looked up at once, about.
TEXT = 1 << 23

#: A frame: its place, the documents and their lengths, and per block words and checksum.
FRAMES = (
    "part int, frame int, before bigint, n_ids bigint, doc_ids array<bigint>, lengths array<int>, "
    "words array<int>, crcs array<bigint>, payload binary"
)


def _frames(path: str):
    def frame(part: int, number: int, before: int, held: list[tuple]) -> pa.RecordBatch:
        doc_ids = [d for docs, _, _ in held for d in docs]
        lengths = np.concatenate([n for _, n, _ in held])
        ids = np.concatenate([i for _, _, i in held])
        sizes, crcs, payload = compress(ids)
        columns = [
            pa.array([part], pa.int32()),
            pa.array([number], pa.int32()),
            pa.array([before], pa.int64()),
            pa.array([len(ids)], pa.int64()),
            pa.array([doc_ids], pa.list_(pa.int64())),
            pa.array([lengths.tolist()], pa.list_(pa.int32())),
            pa.array([sizes.tolist()], pa.list_(pa.int32())),
            pa.array([crcs.tolist()], pa.list_(pa.int64())),
            pa.array([payload], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FRAMES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for some in text_slices(batch.column("text"), TEXT):
                lengths, ids = word_ids(path).of_texts(folded(some, path))
                closed = np.insert(ids, offsets(lengths)[1:], END)
                held.append((doc_ids[: len(some)], lengths + 1, closed))
                doc_ids = doc_ids[len(some) :]
                size += len(closed)
                if size >= FRAME:
                    yield frame(part, number, before, held)
                    number, before, held, size = number + 1, before + size, [], 0
        if held:
            yield frame(part, number, before, held)

    return run


def write_tokens(docs: DataFrame, folder: str, path: str = VOCABULARY) -> None:
    """Writes the ids of every whole text, each document closed by id 1, under ``folder``.

    Documents go in ascending doc_id (null first, equal ids by a hash of their text): the
    texts are range partitioned once, and a partition is encoded and compressed as it is
    read in order. Rows of one id, or without one, may lie in several partitions.
    Null and empty texts hold the end id alone; repeated rows are written each; an empty
    table gives no frames. A frame is a row of a Parquet file, which Spark commits as a
    whole, so tasks may fail and be run again.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Rows alike in id and text are told by a number, so that no number of them goes to one task.
    keys = ["doc_id", "hash", "row"]
    rows = rows.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    ordered.mapInArrow(_frames(path), FRAMES).write.parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files: ids little-endian, 32 bits each.

    ``start`` counts the ids of all documents before. Every block's checksum is verified.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):  # frame by frame, whatever a batch holds
                row = batch.slice(n, 1).to_pylist()[0]
                ids = decompress(row["n_ids"], np.array(row["words"]), np.array(row["crcs"]), row["payload"])
                lengths = np.array(row["lengths"], np.int64)
                ends = offsets(4 * lengths)
                buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids.tobytes())]
                binary = pa.Array.from_buffers(pa.binary(), len(lengths), buffers)
                starts = row["start"] + row["before"] + ends[:-1] // 4
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(lengths), binary]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    frames = spark.read.schema(FRAMES).parquet(folder)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task that wrote
    parts = frames.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = frames.join(lookup(starts), "part")  # small beside the frames: these need not move
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under the shared checkpoint folder; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tillroll-")
    return f"{folder}/files-{uuid.uuid4().hex}"


def written(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents, from the files just written."""
    folder = shared_folder(docs.sparkSession)
    write_tokens(docs, folder)
    rows = read_tokens(docs.sparkSession, folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
