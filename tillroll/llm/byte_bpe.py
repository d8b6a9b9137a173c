"""Byte-level BPE in numpy: many pieces merge at once, each its leftmost lowest-rank pair."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import as_texts, flat_ranges, lists, offsets, over_batches, slices, worker_cache
from tillroll.llm.word_tokens import WordIds

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: Pieces longer than this merge one by one from a heap, whose work does not grow with the square of a length.
LONGEST = 256
#: Columns of the matrices: a piece goes to the first width that holds it.
WIDTHS = [*range(2, 17), 20, 24, 32, 48, 64, 96, 128, 192, LONGEST]
#: Rank of a pair that does not merge.
NONE = np.int32(2**31 - 1)
_PAD = np.int64(-1)

#: White space; a space after any of these makes a run that must be split as a whole.
_BLANKS = "\t\n\x0b\f\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_RUNS = [blank + " " for blank in _BLANKS]


class PairTable:
    """Open hashing from a pair of tokens to the rank of the token they merge to."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys, values = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
        slots = self._slot(keys)
        while len(keys):  # one pair per free slot and round; the others move on
            free = np.flatnonzero(self.keys[slots] == -1)
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]], self.ranks[slots[placed]] = keys[placed], values[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where they do not merge, or where one is padding."""
        keys = left << 32 | right
        found = np.full(keys.shape, NONE, np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys, slots = keys.ravel()[at], None
        slots = self._slot(keys)
        while len(at):
            there = self.keys[slots]
            hit = there == keys
            found.ravel()[at[hit]] = self.ranks[slots[hit]]
            on = ~hit & (there != -1)
            at, keys, slots = at[on], keys[on], (slots[on] + 1) & (1 << self.bits) - 1
        return found


class ByteBpe:
    """Encoder and decoder of a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = PairTable(ranks)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.chunks = WordIds(self.encode_chunks)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece (a match of the pattern)."""
        found: list = [None] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for n in np.flatnonzero(sizes < 2).tolist():
            found[n] = self.byte[list(pieces[n])]
        for n in np.flatnonzero(sizes > LONGEST).tolist():
            found[n] = self._merge_long(pieces[n])
        low = 1
        for width in WIDTHS:
            bucket = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            # Blocks of rows keep a matrix within a few MB.
            for part in np.array_split(bucket, max(1, len(bucket) * width // 500_000)):
                if len(part):
                    self._merge_bucket([pieces[n] for n in part], part, width, found)
        return found

    def _merge_bucket(self, pieces: list[bytes], places: np.ndarray, width: int, found: list) -> None:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = np.full((len(pieces), width), _PAD)
        symbols[np.arange(width) < sizes[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pairs(symbols[:, :-1], symbols[:, 1:])
        while len(places):
            at = ranks.argmin(axis=1)
            every = np.arange(len(places))
            best = ranks[every, at]
            done = best == NONE
            if done.any():  # finished rows leave the matrix
                for n, row, size in zip(places[done].tolist(), symbols[done], sizes[done].tolist()):
                    found[n] = row[:size]
                left = ~done
                places, symbols, ranks, sizes = places[left], symbols[left], ranks[left], sizes[left]
                at, best, every = at[left], best[left], every[: len(places)]
                if not len(places):
                    break
            # Close the gap behind the merged pair; the matrix loses its last column.
            symbols[every, at] = best
            after = np.arange(symbols.shape[1] - 1) > at[:, None]
            symbols = np.where(after, symbols[:, 1:], symbols[:, :-1])
            sizes = sizes - 1
            if ranks.shape[1] == 1:
                ranks = np.full((len(places), 1), NONE)
                symbols = np.hstack((symbols, np.full((len(places), 1), _PAD)))
                continue
            after = np.arange(ranks.shape[1] - 1) >= at[:, None]
            ranks = np.where(after, ranks[:, 1:], ranks[:, :-1])
            # Only the pairs at the merged token are new.
            inside = np.flatnonzero(at < ranks.shape[1])
            ranks[inside, at[inside]] = self.pairs(symbols[inside, at[inside]], symbols[inside, at[inside] + 1])
            inside = np.flatnonzero(at > 0)
            ranks[inside, at[inside] - 1] = self.pairs(symbols[inside, at[inside] - 1], symbols[inside, at[inside]])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        behind, ahead = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        rank = self.ranks.get
        heap = [(r, i, 1, 1) for i in range(len(parts) - 1) if (r := rank(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = ahead[i]
            if not parts[i] or j < 0 or len(parts[i]) != a or len(parts[j]) != b:
                continue  # one of the two has merged since
            parts[i] += parts[j]
            parts[j] = b""
            ahead[i] = ahead[j]
            if ahead[i] >= 0:
                behind[ahead[i]] = i
            for x, y in ((behind[i], i), (i, ahead[i])):
                if x >= 0 and y >= 0 and (r := rank(parts[x] + parts[y])) is not None:
                    heapq.heappush(heap, (r, x, len(parts[x]), len(parts[y])))
        return np.array([self.ranks[p] for p in parts if p], np.int64)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches of text; each is split by the pattern and its pieces merged once."""
        each = [self.pattern.findall(_stretch(chunk)) for chunk in chunks]
        distinct = {piece: n for n, piece in enumerate(dict.fromkeys(chain.from_iterable(each)))}
        ids = self.merge([piece.encode() for piece in distinct])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        starts, flat = np.cumsum(sizes) - sizes, np.concatenate([*ids, np.zeros(0, np.int64)])
        n_pieces = np.fromiter(map(len, each), np.int64, len(each))
        rows = np.fromiter(map(distinct.__getitem__, chain.from_iterable(each)), np.int64, int(n_pieces.sum()))
        before = offsets(sizes[rows])
        ends = np.cumsum(n_pieces)
        return before[ends] - before[ends - n_pieces], flat[flat_ranges(starts[rows], sizes[rows])]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, and all ids."""
        return self.chunks.of([_chunks(text) for text in texts])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        return self.token_bytes[flat_ranges(self.token_starts[ids], self.token_lengths[ids])]


def _chunks(text: str) -> list[str]:
    """Stretches of a text that the pattern splits alike alone and within the text.

    Every match starts at or before a space that no white space precedes, so a text is
    cut at its spaces. A stretch is named by what follows its space; the first of a text
    and a text with longer runs of white space are marked by a space at their end.
    """
    if any(run in text for run in _RUNS):
        return [text + " "]
    first, *others = text.split(" ")
    return [first + " ", *others] if first else others


def _stretch(name: str) -> str:
    return name[:-1] if name.endswith(" ") else " " + name


def load(path: str = RANKS) -> ByteBpe:
    """The encoder of a rank file, made once per process."""
    cache = worker_cache()
    if ("bpe", path) not in cache:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        cache["bpe", path] = ByteBpe(ranks)
    return cache["bpe", path]


def encoded(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, as the tiktoken library gives them.

    Matches of the pattern are encoded separately and special strings are ordinary text.
    Null and empty texts have no ids; repeated rows are encoded alike; an empty table
    gives no rows.
    """
    return _texts(docs).mapInArrow(over_batches(_encoder(path)), "doc_id bigint, ids array<int>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _encoder(path: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        bpe, texts = load(path), as_texts(rows.column("text"))
        made = [bpe.encode(texts[part]) for part in slices(texts)]
        lengths, ids = (np.concatenate(x) for x in zip(*made))
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), lists(lengths, ids.astype(np.int32))], ["doc_id", "ids"])

    return batch


def decoded(tokens: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, ids, bytes): the bytes that the ids stand for; null ids give none."""
    return tokens.mapInArrow(over_batches(_decoder(path)), _DECODED)


def round_trip(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """``decoded(encoded(docs))`` in one Python worker a task instead of two, with one set of tables."""
    encode, decode = _encoder(path), _decoder(path)
    return _texts(docs).mapInArrow(over_batches(lambda rows: decode(encode(rows))), _DECODED)


_DECODED = "doc_id bigint, ids array<int>, bytes binary"


def _decoder(path: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        bpe, ids = load(path), rows.column("ids").fill_null([])
        ends = ids.offsets.to_numpy().astype(np.int64)
        flat = ids.values.to_numpy(zero_copy_only=False)
        made, sizes = [], []
        for part in _parts(ends):
            some = flat[ends[part.start] : ends[part.stop]]
            before = offsets(bpe.token_lengths[some])
            sizes.append(np.diff(before[ends[part.start : part.stop + 1] - ends[part.start]]))
            made.append(bpe.decode(some).tobytes())
        lengths = np.concatenate(sizes)
        buffers = [None, pa.py_buffer(offsets(lengths).astype(np.int32)), pa.py_buffer(b"".join(made))]
        found = pa.Array.from_buffers(pa.binary(), len(lengths), buffers)
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("ids"), found], ["doc_id", "ids", "bytes"])

    return batch


def _parts(ends: np.ndarray, limit: int = 1 << 18) -> Iterable[slice]:
    start = 0
    while start < len(ends) - 1:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, "right")) - 1)
        yield slice(start, stop)
        start = stop


def digests(tokens: DataFrame, *more: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, *more) of decoded tokens."""
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(text, 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
        *more,
    )
