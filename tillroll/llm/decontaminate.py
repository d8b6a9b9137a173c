"""Documents that hold benchmark passages, found by latent semantic retrieval."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import as_texts, flat_ranges, slices
from tillroll.session import checkpoint, size_checked

#: Words of a passage; passages overlap by half.
PASSAGE = 48
#: Columns of the random test matrix, and dimensions kept of the latent space.
RANK = 128
#: Share of an item's weight that its most frequent terms may hold to be left out of :func:`_demand`.
FREQUENT = 0.4
#: Cosine in the latent space from which an item is a candidate.
MIN_COSINE = 0.3
#: Share of an item in the longest common subsequence: enough alone, and with the answer.
SURE, LIKELY = 0.8, 0.5
#: Share of an item's weight, by distinct terms, that must be there for either.
MIN_WEIGHT = 0.5
#: The answer of an item: its last words. It counts as found from this share on.
ANSWER_WORDS, ANSWER_SHARE = 8, 0.75
#: Items that are searched for in one scan, and bytes that a benchmark may have.
BLOCK, BLOCK_CHARS = 1000, 16 << 20
#: Weight of the items among the passages of the factorisation.
ITEM_WEIGHT = 30.0

# A-Z in lower case; what is neither letter, digit nor beyond ASCII separates terms.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


@dataclass
class Index:
    """What a block of items is searched with. Term 0 stands for all others."""

    item_ids: list[int]
    items: list[np.ndarray]
    vocabulary: dict[bytes, int]
    weights: list[dict[int, float]] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    basis: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    demand: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Shares of common terms, a row each, and the row of a term or -1.
    common: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    column: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    #: Items that hold any other term and their shares, from ``begins[term]`` on.
    begins: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    holders: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    held: np.ndarray = field(default_factory=lambda: np.zeros(0))


def new_index(rows: list[tuple[int, str]]) -> Index:
    vocabulary: dict[bytes, int] = {}
    items = []
    for _, text in rows:
        items.append(np.array([vocabulary.setdefault(t, len(vocabulary) + 1) for t in terms(text)], np.int64))
    return Index([i for i, _ in rows], items, vocabulary)


def _term_ids(index: Index, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of terms of each text, and the ids of all of them."""
    each = [terms(text) for text in texts]
    lengths = np.fromiter(map(len, each), np.int64, len(each))
    found = map(index.vocabulary.get, chain.from_iterable(each), repeat(0))
    return lengths, np.fromiter(found, np.int32, int(lengths.sum()))


def _halves(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all half passages among the words of all texts, and the text of each."""
    half = PASSAGE // 2
    n = -(-lengths // half)
    owner = np.repeat(np.arange(len(lengths)), n)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return (np.cumsum(lengths) - lengths)[owner] + half * inside, owner


def _test_matrix(index: Index) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((len(index.vocabulary) + 1, RANK)).astype(np.float32)


def sketch(docs: DataFrame, index: Index) -> tuple[int, np.ndarray, np.ndarray]:
    """(number of documents, document frequency per term, N'N T) over all documents.

    N counts the benchmark's terms in passages of all texts, T is the test matrix. Every
    task adds up its own passages; its sums, whose size the block bounds, are added up
    term by term.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        test = _test_matrix(index)
        width = len(index.vocabulary) + 1
        seen, product, n = np.zeros(width, np.int64), np.zeros(test.shape, np.float64), 0
        for batch in batches:
            texts = as_texts(batch.column("text"))
            n += len(texts)
            for part in slices(texts, 1 << 18):
                lengths, ids = _term_ids(index, texts[part])
                at = np.flatnonzero(ids)
                if not len(at):
                    continue
                term, owner = ids[at].astype(np.int64), np.searchsorted(np.cumsum(lengths), at, "right")
                order = np.lexsort((owner, term))
                term_sorted, owner_sorted = term[order], owner[order]
                fresh = np.append(True, (term_sorted[1:] != term_sorted[:-1]) | (owner_sorted[1:] != owner_sorted[:-1]))
                seen += np.bincount(term_sorted[fresh], minlength=width)
                # Passages that do not overlap, numbered through all texts.
                passage = (at - (np.cumsum(lengths) - lengths)[owner]) // PASSAGE + (owner << 32)
                first = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
                row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
                sums = np.add.reduceat(test[term], first, axis=0)
                some = np.flatnonzero(np.append(True, term_sorted[1:] != term_sorted[:-1]))
                product[term_sorted[some]] += np.add.reduceat(sums[row[order]], some, axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(seen), pa.array(np.full(width, n)), pa.array(list(product), pa.list_(pa.float64()))],
            ["term", "seen", "n", "row"],
        )

    rows = docs.select(F.col("text").cast("string")).mapInArrow(partial, "term bigint, seen bigint, n bigint, row array<double>")
    wide = rows.groupBy("term").agg(F.sum("seen").alias("seen"), F.sum("n").alias("n"), *[F.sum(F.get("row", k)).alias(f"c{k}") for k in range(RANK)])
    found = wide.toPandas().sort_values("term")  # a row per term of the block
    if found.empty:
        return 0, np.zeros(len(index.vocabulary) + 1), np.zeros((len(index.vocabulary) + 1, RANK))
    return int(found["n"].max()), found["seen"].to_numpy(), found[[f"c{k}" for k in range(RANK)]].to_numpy()


def factorise(index: Index, n_docs: int, seen: np.ndarray, product: np.ndarray) -> Index:
    """The index with its weights, latent basis and the items' places in it.

    With A = N D (D the idf) and the items added as heavy rows, D N'N T is A'A times the
    test matrix D^-1 T, from which the Nystroem form of the randomised decomposition
    gives A's right singular vectors.
    """
    n_docs = max(n_docs, 1)
    idf = np.log1p(n_docs / (1.0 + seen))
    idf[0] = 1.0  # terms outside the block: no item has them, so they weigh nothing anywhere
    test = _test_matrix(index) / idf[:, None]
    counts = np.zeros((len(index.items), len(idf)))
    for row, item in zip(counts, index.items):
        np.add.at(row, item, 1)
    items = counts * idf
    image = idf[:, None] * product + ITEM_WEIGHT * (items.T @ (items @ test))
    shift = np.sqrt(len(idf)) * np.finfo(np.float64).eps * np.linalg.norm(image)
    image = image + shift * test
    core = test.T @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    kept = values > values.max(initial=0.0) * 1e-10
    root = image @ (vectors[:, kept] / np.sqrt(values[kept]))
    basis = np.linalg.svd(root, full_matrices=False)[0] if kept.any() else np.zeros((len(idf), 1))
    latent = items @ basis
    latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    for item in index.items:
        own = np.unique(item)
        index.weights.append(dict(zip(own.tolist(), (idf[own] / idf[own].sum()).tolist())))
    index.demand = _demand(index)
    _by_term(index, len(idf))
    index.idf, index.latent = idf.astype(np.float32), latent.astype(np.float32)
    index.basis = (idf[:, None] * basis).astype(np.float32)
    index.basis[0] = 0
    return index


def _by_term(index: Index, width: int) -> None:
    # The shares of the items' weights by term: rows of common terms, lists of the others.
    sizes = [len(own) for own in index.weights]
    term = np.fromiter(chain.from_iterable(index.weights), np.int64, sum(sizes))
    share = np.fromiter(chain.from_iterable(own.values() for own in index.weights), np.float64, len(term))
    item = np.repeat(np.arange(len(sizes)), sizes)
    often = np.flatnonzero(np.bincount(term, minlength=width) >= _COMMON)
    index.column = np.full(width, -1)
    index.column[often] = np.arange(len(often))
    index.common = np.zeros((len(often), len(sizes)), np.float32)
    common = index.column[term] >= 0
    index.common[index.column[term[common]], item[common]] = share[common]
    order = np.flatnonzero(~common)[np.argsort(term[~common], kind="stable")]
    index.begins = np.append(0, np.cumsum(np.bincount(term[order], minlength=width)))
    index.holders, index.held = item[order], share[order]


def _demand(index: Index) -> np.ndarray:
    """Per term a number such that words which hold MIN_WEIGHT of any item sum up to 1 at least.

    An item's most frequent terms, up to FREQUENT of its weight, are left out: the rest
    of MIN_WEIGHT has to come from its other terms. A term counts for the item that it
    does most for, so no item is lost.
    """
    demand = np.zeros(len(index.vocabulary) + 1)
    for own in index.weights:
        terms = np.fromiter(own, np.int64, len(own))
        shares = np.fromiter(own.values(), np.float64, len(own))
        order = np.argsort(shares, kind="stable")
        sums = np.cumsum(shares[order])
        free = int(np.searchsorted(sums, FREQUENT, "right"))
        rest = order[free:]
        left = MIN_WEIGHT - (sums[free - 1] if free else 0.0)
        demand[terms[rest]] = np.maximum(demand[terms[rest]], shares[rest] / left)
    return demand


def common_subsequence(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence; term 0 equals nothing. Bit-parallel."""
    masks: dict[int, int] = {}
    for place, term in enumerate(item.tolist()):
        masks[term] = masks.get(term, 0) | 1 << place
    full = (1 << len(item)) - 1
    state = full
    for term in words.tolist():
        if term and (mask := masks.get(term)):
            met = state & mask
            state = ((state + met) | (state - met)) & full
    return len(item) - state.bit_count()


#: Words of windows that are looked at side by side.
_AT_ONCE = 1 << 20
#: Items from which a term is common: its shares are multiplied as a row, those of others added one by one.
_COMMON = 8


def _held(index: Index, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, weights): the weight of each item that the distinct terms of some windows [low, high) hold.

    A word counts if its term did not occur in its window before: if the place where it occurred
    last lies before the window. All windows of a part are looked at side by side.
    """
    used = np.flatnonzero(ids)
    own = ids[used]
    order = np.argsort(own, kind="stable")
    again = own[order][1:] == own[order][:-1]
    last = np.full(len(used), -1)
    last[order[1:][again]] = order[:-1][again]
    first = np.searchsorted(used, low)
    sizes = np.searchsorted(used, high) - first
    upto, n = np.cumsum(sizes), len(index.items)
    start = 0
    while start < len(low):
        end = max(start + 1, int(np.searchsorted(upto, upto[start] - sizes[start] + _AT_ONCE, "right")))
        places = flat_ranges(first[start:end], sizes[start:end])
        row = np.repeat(np.arange(end - start), sizes[start:end])
        fresh = last[places] < first[start:end][row]
        term, row = own[places[fresh]], row[fresh]
        column = index.column[term]
        common = column >= 0
        there = np.zeros((end - start, len(index.common)), np.float32)
        there[row[common], column[common]] = 1
        weights = there @ index.common
        term, row = term[~common], row[~common]
        begins, counts = index.begins[term], index.begins[term + 1] - index.begins[term]
        entries = flat_ranges(begins, counts)
        cells = np.repeat(row, counts) * n + index.holders[entries]
        weights += np.bincount(cells, index.held[entries], (end - start) * n).reshape(-1, n)
        yield start, weights
        start = end


def _weighty(index: Index, ids: np.ndarray, low: np.ndarray, high: np.ndarray, close: np.ndarray) -> Iterator[tuple[int, int]]:
    """The (row, item) pairs of ``close`` whose window of words holds MIN_WEIGHT of the item."""
    for start, weights in _held(index, ids, low, high):
        found = close[start : start + len(weights)] & (weights >= MIN_WEIGHT - 1e-4)
        for k, item in np.argwhere(found).tolist():
            yield start + k, item


def _matches(index: Index, lengths: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int, float, float, bool]]:
    """(text, item, cosine, share, answered) of verified pairs among some texts."""
    starts, owner = _halves(lengths)
    if not len(starts):
        return
    follows = np.append(owner[1:] == owner[:-1], False)
    single = ~follows & np.append(True, owner[1:] != owner[:-1])
    text_ends = np.cumsum(lengths)
    begins, ends = starts, np.minimum(starts + PASSAGE, text_ends[owner])
    # An item may begin before the passage and end behind it.
    reach = max(map(len, index.items))
    low = np.maximum(begins - reach, (text_ends - lengths)[owner])
    high = np.minimum(ends + reach, text_ends[owner])
    sums = np.concatenate(([0.0], np.cumsum(index.demand[ids])))
    near = np.flatnonzero((follows | single) & (sums[high] - sums[low] >= 1 - 1e-6))
    if not len(near):
        return
    # The sums of the halves that are needed, each once; a passage is a half and the next.
    needed = np.unique(np.concatenate((near, near[follows[near]] + 1)))
    sizes = np.minimum(starts[needed] + PASSAGE // 2, text_ends[owner[needed]]) - starts[needed]
    parts = np.add.reduceat(index.basis[ids[flat_ranges(starts[needed], sizes)]], np.cumsum(sizes) - sizes, axis=0)
    at = np.searchsorted(needed, near)
    vectors = parts[at]
    vectors[follows[near]] += parts[at[follows[near]] + 1]
    begins, ends = begins[near], ends[near]
    cosines = vectors @ index.latent.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    best: dict[tuple[int, int], tuple[float, float, bool]] = {}
    for k, item in _weighty(index, ids, low[near], high[near], cosines >= MIN_COSINE):
        text, wanted = int(owner[near[k]]), index.items[item]
        first = max(int(text_ends[text] - lengths[text]), int(begins[k]) - len(wanted))
        words = ids[first : min(int(ends[k]) + len(wanted), int(text_ends[text]))]
        here = set(words.tolist())
        if sum(w for t, w in index.weights[item].items() if t in here) < MIN_WEIGHT:
            continue
        share = common_subsequence(wanted, words) / len(wanted)
        if share < LIKELY:
            continue
        answer = wanted[-ANSWER_WORDS:]
        answered = common_subsequence(answer, words) >= ANSWER_SHARE * len(answer)
        if share >= SURE or answered:
            found = (share, float(cosines[k, item]), answered)
            best[text, item] = max(best.get((text, item), found), found)
    for (text, item), (share, cosine, answered) in sorted(best.items()):
        yield text, item, cosine, share, answered


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The distinct items with terms, in blocks of BLOCK items or BLOCK_CHARS characters at most, or one longer item.

    The driver holds a block, and a range of the sorted benchmark of about that size.
    """
    rows = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).where("text is not null")
    rows = checkpoint(rows.distinct())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # The text takes part in the range, so that items of one id are divided too.
    ranges = rows.repartitionByRange(size // BLOCK_CHARS + 1, "item_id", F.xxhash64("text"))
    block, held = [], 0
    for item_id, text in ranges.sortWithinPartitions("item_id", "text").toLocalIterator():
        if not terms(text):
            continue
        if block and (len(block) == BLOCK or held + len(text) > BLOCK_CHARS):
            yield block
            block, held = [], 0
        block.append((item_id, text))
        held += len(text)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, share, answered): what each document holds of a benchmark.

    All texts are cut into passages of 48 words, half overlapping. A passage that lies
    near an item in the latent space is compared with it word by word: the pair counts if
    the longest common subsequence has four fifths of the item, or half of it and the
    item's answer, its last words; and half of the item's weight in either case, so that
    frequent words alone do not make a match. One row per row of ``docs`` and item, at the best
    passage. Null, empty and short texts have the passages they can; repeated rows are
    found each; an empty table or benchmark gives no rows.
    """
    return _found(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")), benchmark)


def _found(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    # ``rows`` holds a key, of any type, and a text.
    spark, key = rows.sparkSession, rows.columns[0]
    schema = f"{key} {rows.dtypes[0][1]}, item_id bigint, cosine double, share double, answered boolean"
    found = None
    for block in _blocks(benchmark):
        index = new_index(block)
        shared = spark.sparkContext.broadcast(factorise(index, *sketch(rows, index)))
        made = rows.mapInArrow(_search(shared), schema)
        found = made if found is None else found.unionAll(made)
    return spark.createDataFrame([], schema) if found is None else found


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            texts, keys = as_texts(batch.column("text")), batch.column(0)
            rows, made = [], []
            for part in slices(texts, 1 << 18):
                lengths, ids = _term_ids(index, texts[part])
                for text, item, *rest in _matches(index, lengths, ids):
                    rows.append(part.start + text)
                    made.append((index.item_ids[item], *rest))
            if made:
                kinds = [pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
                columns = [keys.take(pa.array(rows)), *(pa.array(c, k) for c, k in zip(zip(*made), kinds))]
                names = [batch.schema.names[0], "item_id", "cosine", "share", "answered"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns.

    A row goes by its own text, told by SHA-256, whatever other rows share its id or have none.
    """
    told = F.sha2(F.col("text").cast("binary"), 256)
    found = _found(docs.select(told.alias("digest"), F.col("text").cast("string")), benchmark)
    hits = size_checked(checkpoint(found.select(F.col("digest").alias("_hit")).distinct()))
    return docs.join(hits, told == hits["_hit"], "left_anti")
