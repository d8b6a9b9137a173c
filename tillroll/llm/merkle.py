"""Merkle manifest of a corpus, with proofs opened together per partition of leaves."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.ordering import running_total
from tillroll.session import checkpoint, shuffle_partitions, size_checked

#: Levels of a tree that one task derives: a partition of leaves holds 2 ** SPAN at most.
SPAN = 12

#: A partition of leaves, in order, and the nodes outside it that its proofs need.
PARTS = (
    "tree string, part bigint, n bigint, doc_ids array<bigint>, leaves array<binary>, altered array<binary>, "
    "top binary, levels array<int>, places array<bigint>"
)
_NODES = "tree string, level int, place bigint, n bigint, node binary"
_PROOFS = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)

Coordinate = tuple[int, int]


def joined(nodes: Iterable[bytes]) -> bytes:
    """H of some nodes: the digest of their hexadecimal texts, one after the other."""
    return sha256(b"".join(node.hex().encode() for node in nodes)).digest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    return max(0, n - 1).bit_length()


def missing(places: Iterable[int], n: int, levels: int | None = None) -> list[Coordinate]:
    """(level, place) of the least nodes that, with the leaves at ``places``, prove all of these.

    Going up, a sibling is missing if it exists and is not above one of the leaves; what
    two leaves share is asked for once, and nothing that can be derived is.
    """
    asked, known, width = [], sorted(set(places)), n
    for level in range(height(n) if levels is None else levels):
        held = set(known)
        asked += [(level, p ^ 1) for p in known if p ^ 1 < width and p ^ 1 not in held]
        known, width = sorted({p >> 1 for p in known}), (width + 1) >> 1
    return asked


def derived(leaves: dict[int, bytes], n: int, fetched: dict[Coordinate, bytes]) -> list[dict[int, bytes]]:
    """The nodes of each level above the leaves: their interiors, each made once, beside the fetched ones."""
    levels, width, current = [], n, dict(leaves)
    for level in range(height(n)):
        current |= {place: node for (at, place), node in fetched.items() if at == level}
        levels.append(current)
        above = {}
        for p in {p >> 1 for p in current}:
            pair = [current.get(2 * p), current.get(2 * p + 1)]
            if pair[0] is not None and (pair[1] is not None or 2 * p + 1 >= width):
                above[p] = joined(node for node in pair if node is not None)
        current, width = above, (width + 1) >> 1
    return [*levels, current]


def siblings(place: int, n: int, levels: list[dict[int, bytes]]) -> list[bytes | None]:
    """The other node of the run at each level up to the root, None where the run has one node."""
    path, width = [], n
    for level in range(height(n)):
        path.append(levels[level][place ^ 1] if place ^ 1 < width else None)
        place, width = place >> 1, (width + 1) >> 1
    return path


def folded(leaf: bytes, place: int, path: list[bytes | None]) -> bytes:
    """The root that a leaf and its siblings give."""
    for other in path:
        pair = (leaf, other) if place & 1 == 0 else (other, leaf)
        leaf = joined(node for node in pair if node is not None)
        place >>= 1
    return leaf


def _digest(source: Column, n_chars: Column) -> Column:
    def said(value: Column) -> Column:
        text = value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(sized, F.lit("-"))

    fields = [F.col("doc_id").cast("bigint"), source, F.col("lang"), n_chars, F.col("text")]
    return F.unhex(F.sha2(F.concat(*map(said, fields)), 256))


def tampered() -> Column:
    """Every seventh document, by a checksum of its id; none without id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("bigint").cast("string")) % 7 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, altered) per document, materialised.

    ``tree`` orders and names the languages, null first. ``altered`` is the leaf after tampering,
    null where that changes nothing.
    """
    n_chars = F.col("n_chars").cast("bigint")
    changed = F.when(tampered() & n_chars.isNotNull(), _digest(F.col("source"), n_chars + 1))
    return checkpoint(
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            _digest(F.col("source"), n_chars).alias("leaf"),
            changed.alias("altered"),
        )
    )


def placed(rows: DataFrame) -> DataFrame:
    """Add ``place``, 0, 1, ... in a tree in ascending order of doc_id, and its ``n``, materialised.

    Rows without id come first, equal ids by leaf. Range partitioned by (tree, id, leaf), and equal
    rows by where they stand, so neither a language nor an id nor a row that many share is one
    task's; only a count per partition and tree is put in sequence. The partitions are as many as a
    shuffle starts with: equal rows compress to little and would be merged into one by their size.
    """
    keys = ["tree", "doc_id", "leaf", "_row"]
    ordered = rows.withColumn("_row", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys)
    ordered = ordered.sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
    ordered = checkpoint(ordered.withColumn("_line", F.monotonically_increasing_id()).drop("_row"))
    runs = ordered.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_line").alias("_first"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = checkpoint(
        runs.select(
            "tree",
            "_part",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
            F.sum("_n").over(of_tree).alias("n"),
        )
    )
    numbered = ordered.join(size_checked(starts), ["tree", "_part"])
    return numbered.withColumn("place", F.col("_line") + F.col("_offset")).drop("_line", "_offset", "_part")


def _rise(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    # The levels above some nodes in a row; a last node without neighbour rises alone.
    risen = [nodes]
    for _ in range(levels):
        nodes = [joined(nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        risen.append(nodes)
    return risen


def _part(span: int):
    def run(table: pa.Table) -> pa.Table:
        # One partition of leaves: its top node, and what its proofs need from outside.
        table = table.sort_by("place")
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        places, found = table.column("place").to_pylist(), table.column("leaf").to_pylist()
        asked = missing(places, n)
        row = [
            pa.array([tree], pa.string()),
            pa.array([places[0] >> span], pa.int64()),
            pa.array([n], pa.int64()),
            pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            pa.array([found], pa.list_(pa.binary())),
            pa.array([table.column("altered").to_pylist()], pa.list_(pa.binary())),
            pa.array([_rise(found, min(span, height(n)))[-1][0]], pa.binary()),
            pa.array([[level for level, _ in asked]], pa.list_(pa.int32())),
            pa.array([[place for _, place in asked]], pa.list_(pa.int64())),
        ]
        return pa.table(row, [c.split()[0] for c in PARTS.split(", ")])

    return run


def partitions(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """The placed leaves by aligned runs of 2 ** span, one row each, materialised."""
    aligned = rows.withColumn("part", F.shiftright("place", span))
    return checkpoint(aligned.groupBy("tree", "part").applyInArrow(_part(span), PARTS))


def _risen(base: int, span: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        nodes, first = table.column("node").to_pylist(), table.column("place")[0].as_py()
        rows = [
            (tree, base + up, (first >> up) + i, -(-n >> up), node)
            for up, level in enumerate(_rise(nodes, min(span, height(n))))
            for i, node in enumerate(level)
        ]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
        return pa.table(columns, [c.split()[0] for c in _NODES.split(", ")])

    return run


def upper(tops: DataFrame, base: int, span: int = SPAN) -> DataFrame:
    """(tree, level, place, n, node): all nodes of the trees at and above the given ones of level ``base``.

    ``tops`` holds (tree, place, n, node); ``n`` is the number of nodes of that level of the tree.
    A round rises ``span`` levels, each group of 2 ** span neighbours in a task of its own.
    """
    found, current = [], tops
    while True:
        groups = current.withColumn("group", F.shiftright("place", span)).groupBy("tree", "group")
        risen = checkpoint(groups.applyInArrow(_risen(base, span), _NODES))
        base += span
        last = (F.col("level") == base) & (F.col("n") > 1)  # the next round's leaves
        found.append(risen.where(~last))
        current = risen.where(last)
        if current.isEmpty():
            return reduce(DataFrame.unionAll, found)


def _roots(nodes: DataFrame) -> DataFrame:
    # (tree, node): the highest node of each tree.
    return nodes.groupBy("tree").agg(F.max_by("node", "level").alias("node"))


def _opened(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The proofs of a partition of leaves, from what was fetched for it.
        for batch in batches:
            for row in (row for n in range(batch.num_rows) for row in batch.slice(n, 1).to_pylist()):
                yield _proofs_of(row, row["part"] << span)

    return run


def _proofs_of(row: dict, first: int) -> pa.RecordBatch:
    n, tree = row["n"], [f["node"] for f in row["crown"]]
    fetched = {(f["level"], f["place"]): f["node"] for f in row["fetched"] or []}
    levels = derived(dict(enumerate(row["leaves"], first)), n, fetched)
    root, subroot = row["root"].hex(), levels[-1][0].hex()
    if subroot != row["subroot"].hex():
        raise ValueError("a partition of leaves does not lead to the root of its tree")
    made = []
    for place, (doc_id, leaf, altered) in enumerate(zip(row["doc_ids"], row["leaves"], row["altered"]), first):
        path = siblings(place, n, levels)
        end = folded(folded(altered or leaf, place, path), row["tree_place"], tree).hex()
        proof = joined(node for node in [*path, *tree] if node is not None).hex()
        made.append((doc_id, leaf.hex(), subroot, root, proof, end, end == root))
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*made), kinds)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PROOFS.split(", ")])


def _crown(roots: DataFrame, span: int) -> DataFrame:
    """(tree, tree_place, subroot, root, crown): a proof of each language's root under the root of all."""
    one = F.lit("").alias("tree")  # the languages are the leaves of one tree
    ranked = running_total(roots, F.col("tree"), F.lit(1).cast("bigint"))
    counted = F.lit(roots.count()).cast("bigint").alias("n")
    numbered = checkpoint(ranked.select(one, F.col("tree").alias("name"), F.col("before").alias("place"), counted, "node"))
    nodes = checkpoint(upper(numbered.drop("name"), 0, span))
    top = nodes.groupBy("tree").agg(F.max_by("node", "level").alias("root"), F.max("level").alias("height"))
    steps = F.when(F.col("height") > 0, F.sequence(F.lit(0), F.col("height") - 1))
    paths = numbered.join(F.broadcast(top), "tree").withColumn("level", F.explode_outer(steps))  # top is one row
    wanted = paths.withColumn("sibling", F.expr("shiftright(place, level) ^ 1L"))
    others = nodes.select("level", F.col("place").alias("sibling"), F.col("node").alias("other"))
    # A run of one node has no sibling: its level stays, with null.
    entry = F.when(F.col("level").isNotNull(), F.struct("level", F.col("other").alias("node")))
    found = wanted.join(others, ["level", "sibling"], "left").select(
        F.col("name").alias("tree"), F.col("place").alias("tree_place"), F.col("node").alias("subroot"), "root",
        entry.alias("entry"),
    )
    keys = ["tree", "tree_place", "subroot", "root"]
    return found.groupBy(*keys).agg(F.sort_array(F.collect_list("entry")).alias("crown"))


def proofs(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per document.

    Leaves of a language ascend by doc_id, rows without id first, equal ids by leaf; runs of two
    are joined until one node remains, and the nodes of all languages (null first) likewise. A
    partition of leaves asks once for the nodes outside it that its proofs need together, derives
    the interiors they share, and opens each proof itself. Repeated rows are leaves each; null
    fields are told from empty ones; an empty table gives no rows; other columns are not read.
    """
    parts = partitions(placed(leaves(docs)), span)
    width = F.shiftright(F.col("n") + ((1 << span) - 1), span)
    tall = parts.where(F.col("n") > 1 << span)
    low = parts.where(F.col("n") <= 1 << span).select("tree", F.col("top").alias("node"))
    tops = tall.select("tree", F.col("part").alias("place"), width.alias("n"), F.col("top").alias("node"))
    nodes = upper(tops, span, span)
    crown = checkpoint(_crown(checkpoint(low.unionAll(_roots(nodes))), span))

    asked = tall.select("tree", "part", F.explode(F.arrays_zip("levels", "places")).alias("want"))
    asked = asked.select("tree", "part", F.col("want.levels").alias("level"), F.col("want.places").alias("place"))
    fetched = (
        asked.join(nodes, ["tree", "level", "place"])
        .groupBy("tree", "part")
        .agg(F.collect_list(F.struct("level", "place", "node")).alias("fetched"))
    )
    whole = parts.join(size_checked(checkpoint(fetched)), ["tree", "part"], "left").join(size_checked(crown), "tree")
    needed = ["part", "n", "doc_ids", "leaves", "altered", "fetched", "tree_place", "subroot", "root", "crown"]
    return whole.select(*needed).mapInArrow(_opened(span), _PROOFS)
