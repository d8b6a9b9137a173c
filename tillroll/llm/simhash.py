"""Near-duplicates by SimHash fingerprints, compared through pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import as_bytes, over_batches, slices
from tillroll.llm.graph import components
from tillroll.session import checkpoint

#: Words of a shingle and its hash seed.
SHINGLE, SEED = 3, 42
#: Fingerprints link at so many differing bits at most.
MAX_BITS = 2
#: Reference fingerprints of the distance table.
N_PIVOTS = 24
#: A fingerprint's bytes; near pairs differ in MAX_BITS of them at most.
N_BYTES = 8

# Bit b of a byte as a count of one in byte lane b.
_LANES = np.array([sum(1 << (8 * b) for b in range(8) if byte >> b & 1) for byte in range(256)], np.uint64)


def _hashes(text: bytes) -> list[int]:
    words = text.lower().split()  # of bytes: A-Z, and white space \x20 and \x09-\x0D
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: -SHINGLE].tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())]


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text; zero for texts without words."""
    each = [_hashes(text) for text in texts]
    counts = np.array([len(h) for h in each], np.int64)
    found = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return found
    hashes = np.fromiter((h for one in each for h in one), np.uint64, int(counts.sum()))
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8).T]  # eight counters of a byte each
    # Sums of up to 255 hashes fit the byte lanes; then those are widened and summed per text.
    first = np.cumsum(counts) - counts
    parts = -(-counts[full] // 255)
    starts = np.repeat(first[full], parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    partial = np.add.reduceat(lanes, starts, axis=1)
    wide = np.ascontiguousarray(partial.T).view(np.uint8).reshape(len(starts), 64).astype(np.int64)
    bits = np.add.reduceat(wide, np.cumsum(parts) - parts, axis=0)
    over = (2 * bits > counts[full, None]).astype(np.uint8)
    found[full] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
    return found


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number; null texts as empty."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_bytes(rows.column("text"))
        fps = [fingerprints(texts[part]) for part in slices(texts)]
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(np.concatenate(fps).view(np.int64))], ["doc_id", "fp"]
        )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(over_batches(batch), "doc_id bigint, fp bigint")


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """The reference fingerprints: fixed, evenly spread 64-bit numbers."""
    return np.random.default_rng(SEED).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def distance_table(fps: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances (row per reference, column per fingerprint)."""
    return np.bitwise_count(references[:, None] ^ fps[None, :]).astype(np.int8)


def near_links(fps: np.ndarray, references: np.ndarray) -> list[tuple[int, int]]:
    """Positions of linked pairs that connect all of ``fps`` which links connect.

    A breadth-first walk over the distance table: candidates of a fingerprint are those
    not yet reached whose distance to every reference differs from its own by MAX_BITS at
    most (by the triangle inequality no link is lost); the survivors are verified. Each
    fingerprint is reached once, so a group gives a tree and not all its pairs.
    """
    table = distance_table(fps, references)
    order = np.argsort(table[0], kind="stable")  # sorted by the first distance: a window holds all candidates
    fps, table = fps[order], table[:, order]
    left = np.ones(len(fps), bool)
    links = []
    for root in range(len(fps)):
        if not left[root]:
            continue
        left[root] = False
        frontier = [root]
        while frontier:
            x = frontier.pop()
            low = np.searchsorted(table[0], table[0, x] - MAX_BITS, "left")
            high = np.searchsorted(table[0], table[0, x] + MAX_BITS, "right")
            near = low + np.flatnonzero(left[low:high])
            for coordinate in table[1:]:
                near = near[np.abs(coordinate[near] - coordinate[x]) <= MAX_BITS]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= MAX_BITS]
            left[near] = False
            links += [(int(order[x]), int(order[y])) for y in near]
            frontier += near.tolist()
    return links


def _cells() -> Column:
    """(cell, part): per choice of bytes that may differ, the remaining bytes."""
    each = []
    for cell, free in enumerate(combinations(range(N_BYTES), MAX_BITS)):
        mask = ~sum(0xFF << (8 * b) for b in free) & (1 << 64) - 1
        signed = mask - (1 << 64) if mask >> 63 else mask
        each.append(F.struct(F.lit(cell).cast("tinyint").alias("cell"), F.col("fp").bitwiseAND(F.lit(signed)).alias("part")))
    return F.inline(F.array(*each))


def _links_of_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Rows come sorted by cell and part; a run of equal ones may go on in the next batch.
    references = pivots()
    held: list[pa.RecordBatch] = []

    def runs(rows: pa.Table, last: bool):
        cell, part, fp = (rows.column(c).to_numpy() for c in ("cell", "part", "fp"))
        cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fp)]))
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        a, b = [], []
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            for x, y in near_links(fp[s:e].view(np.uint64), references):
                a.append(fp[s + x])
                b.append(fp[s + y])
        rest = int(ends[-1]) if len(ends) else 0
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]), rest

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        same = batch.column("cell")[0] == batch.column("cell")[-1] and batch.column("part")[0] == batch.column("part")[-1]
        if same and len(held) > 1:  # one run all through: wait for its end
            continue
        rows = pa.Table.from_batches(held)
        made, rest = runs(rows, last=False)
        held = rows.slice(rest).combine_chunks().to_batches()
        if made.num_rows:
            yield made
    if held:
        made, _ = runs(pa.Table.from_batches(held), last=True)
        if made.num_rows:
            yield made


def classes(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) of materialised (doc_id, fp) rows: ``root`` names the component of a fingerprint.

    Equal fingerprints collapse to one, and it is fingerprints that links connect: rows
    may share a doc_id, or have none, and still be told apart. A pair within MAX_BITS bits
    agrees in six of the eight bytes, so it meets in one of 28 cells, each named by six
    bytes; two free bytes bound a cell at 65,536 fingerprints, however many rows there
    are. Within a cell the pivot distance table decides.
    """
    reps = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    dealt = reps.select("fp", _cells()).repartition("cell", "part").sortWithinPartitions("cell", "part", "fp")
    links = checkpoint(dealt.mapInArrow(_links_of_cells, "a bigint, b bigint"))
    found = components(links).toDF("fp", "root")
    linked = checkpoint(found.join(reps, "fp"))
    smallest = linked.groupBy("root").agg(F.min("rep").alias("smallest"))
    moved = linked.select("fp", "root").join(smallest, "root")
    own = F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("smallest"))
    return reps.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), own.alias("component_id"))


def linked(prints: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of materialised (doc_id, fp) rows."""
    return prints.join(classes(prints), "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows
    share their component; rows without doc_id link like any other, and a component of
    such rows alone has null. An empty table gives no rows.
    """
    found = linked(checkpoint(fingerprinted(docs)))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: that of smallest doc_id; rows without one only where no other is.

    Rows that share a doc_id but no component all stay; of rows that share both, and of
    those without doc_id, the one that sorts first stays.
    """
    prints = checkpoint(fingerprinted(docs))
    named = classes(prints)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    counts = prints.join(named, "fp").groupBy("doc_id").agg(F.count("*").alias("n"), F.max(first).alias("first"))
    counts = checkpoint(counts)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"))
    ids = counts.where("doc_id is not null and n = 1 and first").select(F.col("doc_id").alias("id"))
    single = rows.join(ids, "id").select("row.*")
    again = counts.where("first and (n > 1 or doc_id is null)").select(F.col("doc_id").alias("id"))
    if again.isEmpty():
        return single
    # Several rows under one id, or rows without an id: these go by their text.
    several = rows.join(again, rows["id"].eqNullSafe(again["id"]), "left_semi").select("row.*")
    each = fingerprinted_rows(several).join(named, "fp").where(F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("component_id")))
    return single.unionAll(each.groupBy("root").agg(F.min("row").alias("row")).select("row.*"))


def fingerprinted_rows(docs: DataFrame) -> DataFrame:
    """(row, fp) for rows that no doc_id tells apart, joined by their text."""
    texts = docs.select("text").distinct().withColumn("doc_id", F.xxhash64("text"))
    prints = fingerprinted(texts).select("doc_id", "fp")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("doc_id"))
    return rows.join(prints.distinct(), "doc_id").select("row", "fp")
