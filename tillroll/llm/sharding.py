"""Shards of near equal size by longest-processing-time scheduling of whole groups."""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import numbered
from tillroll.session import checkpoint

N_SHARDS = 24
#: Bytes that a document costs besides its text.
OVERHEAD = 8


def schedule(sizes: np.ndarray, counts: np.ndarray, n_shards: int = N_SHARDS) -> np.ndarray:
    """How many groups of each size each shard takes: a row per size, a column per shard.

    ``sizes`` are distinct. Longest processing time first: groups go in descending size,
    each to the shard with the least load (ties: the smallest shard), from a heap. Of
    ``counts[i]`` groups of one size, those that lie under the final water level are
    dealt at once, as taking them one by one would end the same; fewer than one per shard
    remain for the heap.
    """
    loads = [0] * n_shards
    taken = np.zeros((len(sizes), n_shards), np.int64)
    for row in np.argsort(-sizes, kind="stable").tolist():
        size, count = int(sizes[row]), int(counts[row])
        if count > n_shards and size:
            # The highest level so that no more than `count` groups start at or below it.
            low, high = min(loads) - 1, max(loads) + size * count
            while low < high:
                level = (low + high + 1) // 2
                if sum(max(0, (level - load) // size + 1) for load in loads) <= count:
                    low = level
                else:
                    high = level - 1
            for shard, load in enumerate(loads):
                n = max(0, (low - load) // size + 1)
                taken[row, shard] += n
                loads[shard] += n * size
                count -= n
        heap = [(load, shard) for shard, load in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(count):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            taken[row, shard] += 1
            loads[shard] += size
    return taken


def sharded(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs``.

    Rows with equal texts form a group and stay together (null counts as the empty
    text); the law is ``bytes``: sizes near equal, as far as whole groups allow. Slots
    number the rows of a shard from 0. Repeated rows are separate rows of their group, an
    empty table gives no rows.

    The schedule sees groups only as counts per size. Their number is below the square
    root of twice the bytes of the corpus, as distinct sizes add up to no more than that:
    the only thing that comes to the driver. Which group takes which place among those of
    its size follows from its number there, given without gathering them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = checkpoint(
        docs.select(
            F.col("doc_id").cast("bigint"),
            (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    groups = checkpoint(rows.groupBy("digest").agg(F.sum("size").alias("total")))
    histogram = groups.groupBy("total").agg(F.count("*").alias("n")).orderBy("total").toPandas()
    taken = schedule(histogram["total"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64), n_shards)
    upto = np.cumsum(taken, axis=1)
    bounds = rows.sparkSession.createDataFrame(
        list(zip(histogram["total"].tolist(), upto.tolist())), "total bigint, upto array<bigint>"
    )
    placed = numbered(groups, ["total"], F.col("digest"), "rank").join(bounds, "total")
    shard = F.size(F.filter("upto", lambda bound: bound <= F.col("rank")))
    assigned = placed.select("digest", shard.alias("shard"))
    dealt = checkpoint(rows.join(assigned, "digest").drop("digest"))
    # With the number of the row, rows that share an id, or have none, are spread like any.
    slots = numbered(dealt, ["shard"], F.struct("doc_id", "row"), "slot")
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
