"""Tokens of whole texts by way of their words, each encoded once."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Collection, Iterator
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from tillroll.llm.common import flat_ranges, worker_cache

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Bytes that the words and ids a worker remembers may take, about; beyond, it starts anew.
REMEMBERED = 96 << 20
#: Longer words, in characters, are encoded where they are met and not remembered.
LONGEST = 64
#: What an entry of a word table takes beside its letters and ids.
_ENTRY = 120

#: Words that the tokenizer neither cuts nor drops from: the letters of Latin-1.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch

# Stands between words that are encoded together: a word of its own that no merge crosses.
_MARK = "~"
#: Characters that are encoded together, about.
_TOGETHER = 4096


def tokenizer(path: str):
    """The tokenizer of ``path``, loaded once per process, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    cache = worker_cache()
    if ("tokenizer", path) not in cache:
        cache["tokenizer", path] = Tokenizer.from_file(path)
    return cache["tokenizer", path]


def _together(words: list[str], ends: int) -> Iterator[tuple[int, int]]:
    """Where runs of words begin and end that have about _TOGETHER characters, ``ends`` more a word."""
    start = size = 0
    for n, word in enumerate(words):
        if size > _TOGETHER:
            yield start, n
            start, size = n, 0
        size += len(word) + ends
    if start < len(words):
        yield start, len(words)


def _last(path: str) -> np.ndarray | None:
    """Whether an id is the last of its piece, by its number; None if the tokenizer does not mark these."""
    library, cache = tokenizer(path), worker_cache()
    if ("last", path) not in cache:
        vocabulary, suffix = library.get_vocab(), getattr(library.model, "end_of_word_suffix", None)
        last = np.zeros(max(vocabulary.values()) + 1, bool)
        last[[n for token, n in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        cache["last", path] = last if suffix else None
    return cache["last", path]


def _of_letters(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
    """As :func:`encode`, of words that are one piece each; None if they are not."""
    last = _last(path)
    if last is None:
        return None
    joined = [" ".join(words[i:j]) for i, j in _together(words, 1)]
    found = tokenizer(path).encode_batch_fast(joined, add_special_tokens=False)
    ids = np.concatenate([np.zeros(0, np.int32), *(np.array(each.ids, np.int32) for each in found)])
    ends = np.flatnonzero(last[ids])
    return (np.diff(ends, prepend=-1), ids) if len(ends) == len(words) else None


def _between_marks(library, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`encode`, of any words: a mark stands between them, and their ids are cut
    at those of the mark. Words with the mark in them go alone."""
    (mark,) = library.encode(_MARK, add_special_tokens=False).ids
    parts, start, size = [], 0, 0
    for n, word in enumerate(words):
        if _MARK in word or size > _TOGETHER:
            parts += [(start, n)] if n > start else []
            start, size = n, 0
            if _MARK in word:
                parts.append((n, n + 1))
                start = n + 1
        size += len(word) + 3
    parts += [(start, len(words))] if len(words) > start else []
    joined = [f" {_MARK} ".join(words[i:j]) for i, j in parts]
    lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for (i, j), found in zip(parts, library.encode_batch_fast(joined, add_special_tokens=False)):
        some = np.array(found.ids, np.int32)
        if j - i > 1:
            cuts = np.flatnonzero(some == mark)
            lengths.append(np.diff(cuts, prepend=-1, append=len(some)) - 1)
            some = np.delete(some, cuts)
        else:
            lengths.append(np.array([len(some)]))
        ids.append(some)
    return np.concatenate(lengths), np.concatenate(ids)


def encode(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of ids of each word as the library gives them, without added special
    tokens, and all ids. Words hold no ASCII white space.

    White space ends every merge, so many words are encoded as one text: words of letters
    with a space between them, the others with a mark.
    """
    plain = np.fromiter((_LETTERS(word) is not None for word in words), bool, len(words))
    own = _of_letters(path, [word for word, one in zip(words, plain) if one])
    if own is None:
        return _between_marks(tokenizer(path), words)
    rest = _between_marks(tokenizer(path), [word for word, one in zip(words, plain) if not one])
    order = np.argsort(np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain))))
    lengths, ids = np.concatenate((own[0], rest[0])), np.concatenate((own[1], rest[1]))
    starts = np.cumsum(lengths) - lengths
    return lengths[order], ids[flat_ranges(starts[order], lengths[order])]


def _folds(path: str) -> bool:
    """Whether the tokenizer lower-cases all but its special tokens, which hold "<"."""
    library, cache = tokenizer(path), worker_cache()
    if ("folds", path) not in cache:
        special = library.get_added_tokens_decoder().values()
        alike = library.encode("QX", add_special_tokens=False).ids == library.encode("qx", add_special_tokens=False).ids
        cache["folds", path] = alike and all("<" in token.content for token in special)
    return cache["folds", path]


def folded(texts: pa.Array, path: str) -> pa.Array:
    """``texts`` with fewer distinct words and the same ids: ASCII letters in lower case,
    ASCII marks after a letter, but for the apostrophe, apart from their word.

    The tokenizer lower-cases itself, and no merge crosses from letters to marks. Texts
    that may hold a special token stay as they are.
    """
    if not _folds(path):
        return texts
    apart = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-zß-öø-ÿ])([!-&(-/:;=-@\[-`{-~]+)", r"\1 \2")
    return pc.if_else(pc.match_substring(texts, "<"), texts, apart)


def cut(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of words of each text, and all words, each text's after another's.

    The tokenizer drops white space before it splits and merges, and no special token
    holds any, so the ids of a text are those of its words. Cutting at ASCII white space
    is enough: what other white space a word holds the tokenizer drops itself.
    """
    found = pc.ascii_split_whitespace(texts)
    return pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64), found.flatten()


def split(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """As :func:`cut`, the words by their numbers among the distinct ones."""
    n_words, words = cut(texts)
    return n_words, words.dictionary_encode()


def text_slices(column: pa.Array, limit: int = 1 << 22) -> Iterator[pa.Array]:
    """The texts of a column, null as empty, in slices of about ``limit`` bytes; one text at least each."""
    texts = column.cast(pa.large_string()).fill_null("")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // limit
    for at in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(part)) + 1):
        if len(at):
            yield texts.slice(at[0], len(at))


class WordIds:
    """The ids of words met so far: a row number per word, and the ids row after row.

    ``encoder`` gives the number of ids of each word and all ids. Words over LONGEST are
    forgotten after each call, all words once they and their ids take ``limit`` bytes: a
    table holds that and the words of one call at most.
    """

    def __init__(self, encoder: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = REMEMBERED):
        self.encoder, self.limit = encoder, limit
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.words = pa.array([], pa.large_string())  # the first of ``rows``, for Arrow
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.held = 0

    def add(self, new: list[str]) -> None:
        lengths, flat = self.encoder(new)
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, flat.astype(np.int32)))
        self.held += sum(map(len, new)) + _ENTRY * len(new) + 4 * len(flat)

    def _forget(self, long: list[str]) -> None:
        """Drops the words ``long``, the last that were added."""
        kept = len(self.rows) - len(long)
        for word in long:
            del self.rows[word]
        self.words = self.words[:kept]
        n = int(self.starts[kept])
        self.held -= sum(map(len, long)) + _ENTRY * len(long) + 4 * (len(self.ids) - n)
        self.starts, self.lengths, self.ids = self.starts[:kept].copy(), self.lengths[:kept].copy(), self.ids[:n].copy()

    def _known(self, distinct: Collection[str]) -> list[str]:
        """Adds what is new of ``distinct``; gives the words to forget after use."""
        new = [word for word in distinct if word not in self.rows]
        if new and self.held > self.limit:
            self.clear()
            new = list(distinct)
        long = [word for word in new if len(word) > LONGEST]
        if new:
            self.add([word for word in new if len(word) <= LONGEST] + long)
        return long

    def _gather(self, n_words: np.ndarray, rows: np.ndarray, long: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[rows]
        ids = self.ids[flat_ranges(self.starts[rows], lengths)]
        before = np.concatenate(([0], np.cumsum(lengths)))
        ends = np.cumsum(n_words)
        if long:
            self._forget(long)
        return before[ends] - before[ends - n_words], ids

    def of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, given as its words, and all ids."""
        long = self._known(set(chain.from_iterable(texts)))
        n_words = np.fromiter(map(len, texts), np.int64, len(texts))
        rows = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(texts)), np.int64, int(n_words.sum()))
        return self._gather(n_words, rows, long)

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each whole text, and all ids: Arrow finds the words known,
        Python only what is new. A null text has none.
        """
        n_words, words = cut(texts.cast(pa.large_string()))
        if len(self.words) < len(self.rows):
            added = pa.array(islice(self.rows, len(self.words), None), pa.large_string())
            self.words = pa.concat_arrays([self.words, added])
        found = pc.index_in(words, value_set=self.words)
        if found.null_count and self.held > self.limit:
            self.clear()
            found = pa.nulls(len(words), pa.int32())
        rows = found.fill_null(-1).to_numpy().astype(np.int64)
        long = []
        if found.null_count:
            new = words.filter(found.is_null()).dictionary_encode()
            distinct = new.dictionary.to_pylist()
            long = self._known(distinct)
            numbers = np.fromiter(map(self.rows.__getitem__, distinct), np.int64, len(distinct))
            rows[rows < 0] = numbers[new.indices.to_numpy()]
        return self._gather(n_words, rows, long)

    def lengths_of(self, distinct: list[str]) -> np.ndarray:
        """The number of ids of each of these words."""
        long = self._known(distinct)
        rows = np.fromiter(map(self.rows.__getitem__, distinct), np.int64, len(distinct))
        lengths = self.lengths[rows]
        if long:
            self._forget(long)
        return lengths


def word_ids(path: str) -> WordIds:
    """The word table of ``path`` of this worker."""
    cache = worker_cache()
    if ("words", path) not in cache:
        cache["words", path] = WordIds(lambda new: encode(path, new))
    return cache["words", path]
