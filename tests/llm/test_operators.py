"""The operators on small tables, against brute force and the libraries they stand for."""

from __future__ import annotations

import base64
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import (
    byte_bpe,
    decontaminate,
    graph,
    nb_svm,
    pii,
    preference,
    quality_rules,
    range_coder,
    sharding,
    simhash,
    token_counts,
    token_output,
    word_tokens,
)
from tillroll.llm.common import prepare

BENCHMARK = [
    (1, "the quick brown fox jumps over the lazy dog while seven wizards brew a strange green potion at noon"),
    (2, "granite mountains rise above silent valleys where winter rivers carry old stories to the distant sea"),
    (3, None),
    (4, ""),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, n bigint, id bigint, spans string, fp bigint"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8))) for _ in range(n)]
    lines = [" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, n, 12)]
    return "\n".join(lines)


def texts() -> list[str | None]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    long = prose(2, 30_000)
    return [
        None, "", " \n\t ", base, base, " ".join(near), base + " More", prose(3, 20), long, "The " * 200,
        "a*** b$$$ c%%% d&&& " * 40, prose(4, 90) + "\n" + BENCHMARK[0][1] + "\n" + prose(5, 60),
        prose(6, 80) + " granite mountains rise beyond silent valleys where winter rivers bring old stories to the distant sea "
        + prose(7, 70), "Write to Ann.Lee@mail.example.com or ANN.LEE@MAIL.EXAMPLE.COM, call +1 (643) 555-5742. 19.37.233.111!!",
        'token = "' + "ab12" * 10 + '" 4111111111111111 and Mr. John Smith, Frau Müller 5555555555554444.',
        "<|endoftext|> İstanbul ΣΑΣ é ½ 中文 🙂 \x1c it's  double  spaces 　 here", "x" * 3000, "!" * 700,
        base, prose(8, 100) + "\n" + "\n".join(["Click here now."] * 3 + [f"n{k} | m{k} | top{k}" for k in range(9)]),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(n, t, "en", "s", len(t or ""), "row", 7, 8, "spans", 9) for n, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, "", None, None, None, None, None, None, None, None)]
    rows += [(None, prose(9, 70), None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).checkpoint() if spark.sparkContext.getCheckpointDir() else spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(BENCHMARK, "item_id bigint, text string")


def pairs(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# 1 and 4: tokens of the word vocabulary


def library_ids(texts):
    tokenizer = Tokenizer.from_file(word_tokens.VOCABULARY)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_give_the_ids_of_their_text():
    rng, alphabet = random.Random(5), "ab  \n\t\x1c\x1f\x85\xa0　'sléÉ²½٣中é́🙂ß.,!?<|endoftext|>09ΣİÅ_-"
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    some += ["<|startoftext|>x<|endoftext|> y", "a<|endoftext|> <|endoftext|>b"]
    some += [f"A{b} B{a}.{b}, {a}{b}. x{a},\n{b}" for a in alphabet for b in alphabet] + ["a ~ b~ ~c ~~", "~", "QX. qx, <|ENDOFTEXT|> Q."]
    texts = word_tokens.folded(pa.array(some, pa.large_string()), word_tokens.VOCABULARY)
    lengths, ids = word_tokens.word_ids(word_tokens.VOCABULARY).of_texts(texts)
    expected = library_ids(some)
    assert lengths.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_full_word_tables_start_anew():
    table = word_tokens.WordIds(lambda new: (np.array([len(w) > 0 for w in new], int), np.array([len(w) for w in new if w])), limit=300)
    for some in (["a", "bb", "ccc"], ["dddd", "a", "x" * 99], ["x" * 99, "bb", "y" * 98, "eeeee"], ["x" * 99]):
        lengths, ids = table.of([some])
        assert ids.tolist() == [len(w) for w in some] and lengths.tolist() == [len(some)]
        found = table.of_texts(pa.array([" ".join(some), ""]))
        assert found[1].tolist() == [len(w) for w in some] and found[0].tolist() == [len(some), 0]
        assert len(table.rows) <= 4 and max(map(len, table.rows), default=0) <= 5
        assert len(table.rows) == len(table.starts) == len(table.lengths) and len(table.ids) == table.lengths.sum()


def test_each_new_word_is_encoded_once():
    """Words that differ in capitals or in marks share their letters' ids; known words do not reach the encoder again."""
    asked = []

    def encoder(new):
        asked.extend(new)
        return word_tokens.encode(word_tokens.VOCABULARY, new)

    table, some = word_tokens.WordIds(encoder), ["The house### theory,***", "the.%%% HOUSE, theory!\nhouse\tThe$$$", "it's THE\u3000house~"]
    for _ in range(2):
        ids = table.of_texts(word_tokens.folded(pa.array(some), word_tokens.VOCABULARY))[1]
        assert ids.tolist() == [i for e in library_ids(some) for i in e]
    assert len(asked) == len(set(asked))
    assert {"the", "house", "theory", "###", ",***", ".%%%", "$$$"} <= set(asked) and not {"house###", "the."} & set(asked)


def test_word_tables_are_bounded_by_bytes():
    """Texts without spaces, and many words: what a worker holds stays near its limit."""
    rng = random.Random(3)
    table = word_tokens.WordIds(lambda new: word_tokens.encode(word_tokens.VOCABULARY, new), limit=1 << 20)
    han = ["".join(chr(0x4E00 + rng.randrange(20_000)) for _ in range(1000)) for _ in range(60)]
    some = [*han, " ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(20_000)), "z" * 100_000]
    expected = library_ids(some)
    for text, ids in zip(some, expected):
        assert table.of_texts(pa.array([text], pa.large_string()))[1].tolist() == ids
    table.of([["a"]])
    assert table.held < 1 << 20 and sum(map(len, table.rows)) < 1 << 20


def test_length_table():
    words = ["a", "bb", "ü", "x" * 60]
    table = token_counts.LengthTable(words, np.array([1, 2, 3, 4]))
    held, lengths = table.find(pa.array(["ü", "c", "x" * 60, "a", ""]))
    assert held.tolist() == [True, False, True, True, False] and lengths.tolist() == [3, 0, 4, 1, 0]
    assert token_counts.LengthTable([], np.zeros(0)).find(pa.array(["a"]))[0].tolist() == [False]


def test_token_counts(docs):
    found = rows_of(token_counts.token_counts(docs, limit=50, n=8))
    ids = library_ids([t for _, t in pairs(docs)])
    expected = [(d, len(t.encode()), len(i), len(i) > 50) for (d, t), i in zip(pairs(docs), ids)]
    assert found == sorted(expected, key=repr)


def test_token_counts_merge_many_summaries(docs, monkeypatch):
    monkeypatch.setattr(token_counts, "FAN_IN", 2)
    frequent = token_counts.frequent_words(docs.repartition(9), 1000)
    texts = word_tokens.folded(pa.array([t for _, t in pairs(docs)]), word_tokens.VOCABULARY)
    counts = Counter(w for t in texts.to_pylist() for w in t.split())
    assert [counts[w] for w in frequent[:9]] == [n for _, n in counts.most_common(9)]


def test_token_files(spark, docs):
    found = token_output.written(docs).collect()
    ordered = pairs(docs.orderBy("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))))
    ids = [i + [1] for i in library_ids([t for _, t in ordered])]
    assert [r.doc_id for r in sorted(found, key=lambda r: r.start)] == [d for d, _ in ordered]
    start = 0
    for row, own in zip(sorted(found, key=lambda r: r.start), ids):
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)


def test_token_files_without_ids(spark, nothing, tmp_path):
    """Many rows without an id are not one task's, and none is lost; no rows give no files' rows."""
    rows = spark.range(4000).selectExpr("cast(null as bigint) doc_id", "if(id % 2 = 0, 'same', 'text ' || id) text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_output.write_tokens(rows.repartition(4), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    frames = spark.read.parquet(str(tmp_path / "t")).groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()
    assert len(frames) > 1 and sum(r.n for r in frames) == 4000 and max(r.n for r in frames) < 2000
    found = token_output.read_tokens(spark, str(tmp_path / "t"))
    assert found.agg(F.countDistinct("start")).first()[0] == 4000
    assert token_output.written(nothing).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 255, 256, 257, 1023, 1024, 1025, 20_000])
def test_range_coder_round_trips(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49_409, n), rng.integers(0, 5, n), np.full(n, 7), np.arange(n)):
        packed = range_coder.compress(ids)
        assert (range_coder.decompress(n, *packed) == ids).all()


def test_range_coder_learns_and_detects_damage():
    block = range_coder.BLOCK
    ids = np.tile(np.random.default_rng(0).integers(0, 49_409, 100), 2 * block // 100 + 9)
    sizes, crcs, payload = range_coder.compress(ids)
    assert len(payload) * 8 < len(ids)  # 16 bits each without a model
    # Blocks stand alone: the second decodes without the first.
    words = np.cumsum(sizes) * 4
    alone = range_coder.decompress(block, sizes[1:2], crcs[1:2], payload[words[0] : words[1]])
    assert (alone == ids[block : 2 * block]).all()
    assert (range_coder.decompress(len(ids), sizes, crcs, payload) == ids).all()
    for at in (1, 400, 9000, len(payload) - 3):
        with pytest.raises(ValueError):
            range_coder.decompress(len(ids), sizes, crcs, payload[:at] + bytes([payload[at] ^ 1]) + payload[at + 1 :])


def test_range_coder_refuses_ids_beyond_its_limit():
    for ids in ([3, range_coder.ID_LIMIT], [-1]):
        with pytest.raises(ValueError):
            range_coder.compress(np.array(ids))
    ids = np.array([0, 65_534, 65_535, 65_536, range_coder.ID_LIMIT - 1])
    assert (range_coder.decompress(5, *range_coder.compress(ids)) == ids).all()


def test_range_coder_models_the_ids_of_a_block_only():
    """Ids far apart cost what ids side by side do: a block's tables hold its own ids."""
    ids = np.random.default_rng(1).integers(0, 3, 5000)
    far = np.array([7, 49_000, range_coder.ID_LIMIT - 1])[ids]
    near, packed = range_coder.compress(ids), range_coder.compress(far)
    assert (range_coder.decompress(5000, *packed) == far).all()
    assert len(packed[2]) < len(near[2]) + 32


def test_range_coder_mixes():
    """Fewer bits an id than the entropy of the ids, and than zlib, over whole texts of the test tables."""
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].combine_chunks()
    table = word_tokens.word_ids(word_tokens.VOCABULARY)
    ids = np.concatenate([table.of_texts(some)[1] for some in word_tokens.text_slices(texts.slice(0, 3000))])
    n, share = len(ids), np.unique(ids, return_counts=True)[1] / len(ids)
    bits = 8 * len(range_coder.compress(ids)[2]) / n
    assert bits < -(share * np.log2(share)).sum()
    assert bits < 8 * len(zlib.compress(ids.astype("<u2").tobytes())) / n


# 2: byte-level BPE


def test_bpe_equals_the_library():
    with open(byte_bpe.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng, alphabet = random.Random(1), "ab  \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　'sléÉ²½Ⅷ٣中文́🙂🏽ß.,!?<|endoftext|>09_-"
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    some += [t or "" for t in texts()] + ["ab" * 900, " " * 50, "\n" * 300 + "x"]
    bpe = byte_bpe.load()
    lengths, ids = bpe.encode(some)
    expected = [library.encode_ordinary(t) for t in some]
    assert lengths.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]
    assert bpe.decode(ids).tobytes() == "".join(some).encode()


def test_bpe_tables(docs, nothing):
    found = {(r.doc_id, bytes(r.bytes).decode()) for r in byte_bpe.decoded(byte_bpe.encoded(docs)).collect()}
    assert found == set(pairs(docs))
    assert byte_bpe.digests(byte_bpe.decoded(byte_bpe.encoded(nothing))).count() == 0


# 3: decontamination


def test_common_subsequence_against_a_table():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(1, 6, rng.integers(1, 20)), rng.integers(0, 6, rng.integers(0, 30))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == table[-1, -1]


def test_decontamination_finds_copies_and_paraphrases(docs, benchmark, nothing):
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(11, 1), (12, 2)}
    assert {r.item_id: r.share for r in found}[1] == 1.0 and {r.item_id: r.share for r in found}[2] < 1.0
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2


def test_decontamination_goes_by_row(spark, benchmark):
    """Rows that share an id with a contaminated one, or lack one like it, stay."""
    hit = prose(4, 90) + "\n" + BENCHMARK[0][1] + "\n" + prose(5, 60)
    rows = [(1, hit), (1, prose(6, 80)), (None, hit), (None, prose(7, 80)), (None, None), (2, hit), (3, "")]
    kept = decontaminate.clean(spark.createDataFrame(rows, "doc_id bigint, text string"), benchmark)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((r for r in rows if r[1] != hit), key=repr)


@pytest.mark.parametrize("at_once", [1, 500, 1 << 20])
def test_weights_held_by_windows(monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "_AT_ONCE", at_once)
    rng = random.Random(3)
    words = [f"w{n}" for n in range(60)]
    items = [(n, " ".join(rng.choices(words[: 10 + n], k=25))) for n in range(40)]
    index = decontaminate.new_index(items)
    size = len(index.vocabulary) + 1
    seen = np.array([0, *(rng.randrange(50) for _ in range(size - 1))])
    decontaminate.factorise(index, 100, seen, np.zeros((size, decontaminate.RANK)))
    assert 0 < len(index.common) < size - 1
    ids = np.array([rng.randrange(size) for _ in range(900)], np.int32)
    low = np.array(sorted(rng.randrange(900) for _ in range(70)))
    high = np.minimum(low + np.array([rng.randrange(1, 200) for _ in low]), 900)
    held = np.concatenate([weights for _, weights in decontaminate._held(index, ids, low, high)])
    for row, (a, b) in enumerate(zip(low, high)):
        there = set(ids[a:b].tolist())
        expected = [sum(w for t, w in own.items() if t in there) for own in index.weights]
        assert np.allclose(held[row], expected, atol=1e-5)


def test_decontamination_in_blocks(docs, benchmark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 1)
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert found == {(11, 1), (12, 2)}


def test_benchmark_blocks_are_bounded(spark, monkeypatch):
    """Every item is in one block, by count and by size, items of one id or none too."""
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 600)
    items = [(n % 3 or None, prose(n, 12 + n % 60)) for n in range(90)] + [(1, prose(200, 400)), (2, ""), (2, None), (1, prose(200, 400))]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    blocks = list(decontaminate._blocks(frame))
    assert Counter(sum(blocks, [])) == Counter({(i, t) for i, t in items if t})
    assert all(len(block) == 1 or sum(len(t) for _, t in block) <= 600 for block in blocks)
    assert not list(decontaminate._blocks(frame.limit(0)))


def test_latent_recall_against_brute_force(spark):
    """Planted windows of items, words replaced at random: what word-by-word search finds."""
    rng = random.Random(2)
    items = [(n, prose(100 + n, rng.randrange(15, 60))) for n in range(40)]
    rows, planted = [], set()
    for n in range(300):
        text = prose(1000 + n, rng.randrange(30, 300)).split()
        if n % 3 == 0:
            item = rng.randrange(40)
            words = [w if rng.random() > 0.1 else "other" for w in items[item][1].split()]
            at = rng.randrange(len(text))
            text[at:at] = words
            planted.add((n, item))
        rows.append((n, " ".join(text)))
    schema = "doc_id bigint, text string"
    found = decontaminate.contaminated(
        spark.createDataFrame(rows, schema), spark.createDataFrame(items, "item_id bigint, text string")
    )
    found = {(r.doc_id, r.item_id) for r in found.collect()}

    def terms(text):
        return decontaminate.terms(text)

    exact = set()
    for n, text in rows:
        words = terms(text)
        for i, item in items:
            ids = {w: k + 1 for k, w in enumerate(dict.fromkeys(terms(item)))}
            wanted = np.array([ids[w] for w in terms(item)])
            if decontaminate.common_subsequence(wanted, np.array([ids.get(w, 0) for w in words])) >= 0.8 * len(wanted):
                exact.add((n, i))
    assert len(found & exact) >= 0.9 * len(exact) and found <= planted


def test_copies_are_found_however_large_or_common():
    """One item in a third of the documents, and the same shares among 2,000 times as many."""
    items = [(n, prose(100 + n, 40)) for n in range(20)]
    filler = prose(7, 400).split()
    texts = [" ".join(filler[n : n + 90]) + " " + (items[0][1] if n % 3 == 0 else "") + " " + " ".join(filler[n : n + 90]) for n in range(60)]
    index = decontaminate.new_index(items)
    lengths, ids = decontaminate._term_ids(index, texts)
    seen = np.zeros(len(index.vocabulary) + 1, np.int64)
    for part in np.split(ids, np.cumsum(lengths)[:-1]):
        seen[np.unique(part[part > 0])] += 1
    product = np.zeros((len(seen), decontaminate.RANK))
    for part in np.split(ids, np.cumsum(lengths)[:-1]):
        known = part[part > 0]
        np.add.at(product, known, decontaminate._test_matrix(index)[known].sum(axis=0))
    for scale in (1, 2000, 200000):
        fitted = decontaminate.factorise(decontaminate.new_index(items), len(texts) * scale, seen * scale, product * scale)
        found = {m[:2] for m in decontaminate._matches(fitted, lengths, ids)}
        assert found == {(n, 0) for n in range(0, 60, 3)}


# 5: preference pairs

TURNS = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "and?"), (0, 3, "assistant", "good"),
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "and?"), (1, 3, "assistant", "bad"),
    (2, 0, "user", "alone"), (5, 0, None, None), (5, None, "assistant", ""), (6, 0, "user", "a"), (7, 0, "user", "a"),
    (7, 1, "assistant", "b"), (7, 1, "assistant", "b"), (None, 0, "user", "lost"),
]


def test_preference_pairs(spark):
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id bigint, turn bigint, role string, text string, side string")
    found = {r.pair_id: r for r in preference.preference_rows(turns).collect()}
    assert set(found) == {0, 1, 2, 3}
    assert found[0].n_shared == 3 and found[0].prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n<|user|>\nand?<|end|>\n"
    for side, word in (("chosen", "good"), ("rejected", "bad")):
        text, (start, end) = found[0][side], map(int, found[0][f"{side}_mask"].split("-"))
        assert text[start:end] == word + "<|end|>\n" and text == f"<|assistant|>\n{word}<|end|>\n"
    assert (found[1].rejected_id, found[1].n_shared, found[1].prompt, found[1].rejected) == (None, 0, "", "")
    assert found[3].n_shared == 1 and found[3].chosen == "" and found[3].rejected.count("<|assistant|>") == 2
    assert preference.preference_rows(turns.limit(0)).count() == 0


# 6: shards


def test_schedule_equals_a_heap():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sizes = np.unique(rng.integers(1, 400, rng.integers(1, 40)))
        counts = rng.integers(1, 300, len(sizes)) * (rng.random(len(sizes)) < 0.5) + 1
        taken = sharding.schedule(sizes, counts, 7)
        assert (taken.sum(axis=1) == counts).all()
        heap = [(0, shard) for shard in range(7)]
        for size in sorted(np.repeat(sizes, counts).tolist(), reverse=True):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
        assert sorted((taken * sizes[:, None]).sum(axis=0).tolist()) == sorted(load for load, _ in heap)


def test_shards(docs, nothing):
    found = sharding.sharded(docs).collect()
    assert len(found) == docs.count()
    text_of = defaultdict(set)
    for d, t in pairs(docs):
        text_of[zlib.crc32(t.encode())].add(len(t.encode()) + 8)
    shards = defaultdict(set)
    slots = defaultdict(list)
    for r in found:
        assert r.size in text_of[r.text_crc32] and r.law == "bytes" and r.grown_shard is None
        shards[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded(nothing).count() == 0


# 7: quality


def test_descent_separates():
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    weights = nb_svm.descend(rows, np.array([1, 1, 0, 0]), np.array([2.0, -2.0, 0.1, -0.1]))
    margins = [weights[r] @ np.array([2.0, -2.0, 0.1, -0.1])[r] + weights[-1] for r in rows]
    assert margins[0] > 0 > margins[2] and margins[1] > 0 > margins[3]


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = nb_svm.scored(docs, labels).where("held_out").join(labels, "doc_id")
    right, n = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.count("*")).first()
    assert right > 0.93 and n > 50


def test_quality_of_odd_tables(spark, docs, nothing):
    labels = spark.createDataFrame([(3, 1, 0), (9, 0, 0), (9, 0, 0), (None, 1, 0), (5, None, 0), (10, 0, 0)], "doc_id bigint, quality int, toxic int")
    found = nb_svm.scored(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert {r.score for r in nb_svm.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert nb_svm.scored(nothing, labels).count() == 0


# 8: private data


def test_surrogates_keep_form_and_identity(docs, nothing):
    found = {r.text: r for r in pii.surrogates(docs).collect()}
    changed = {r.doc_id: r.text for r in found.values() if r.n_entities}
    assert set(changed) == {13, 14}
    mail, upper = re.findall(r"\S+@[\w.]+\w", changed[13])
    assert mail.lower() == upper.lower() and upper.isupper() and mail.lower() != "ann.lee@mail.example.com"
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}\. \d+\.\d+\.\d+\.\d+!!$", changed[13])
    cards = re.findall(r"\d{16}", changed[14])
    assert [pii._luhn(c) for c in cards] == [0, 0] and cards[0] != cards[1] and not {"4111111111111111"} & set(cards)
    assert "John" not in changed[14] and re.search(r"Mr\. [A-Z][a-z]+ [A-Z]", changed[14])
    assert {(r.doc_id, r.text or "") for r in found.values() if not r.n_entities} <= set(pairs(docs))
    hidden = pii.hidden(docs)
    assert hidden.columns == docs.columns and hidden.count() == docs.count()
    assert pii.hidden(nothing).count() == 0


def test_surrogates_stay_distinct(spark, monkeypatch):
    """With few surrogates to draw from, collisions are settled in further rounds."""
    monkeypatch.setattr(pii, "surrogate", lambda kind, entity, attempt, key: str((len(entity) + attempt * 3) % 50))
    entities = spark.createDataFrame([("card", "x" * n) for n in range(1, 9)] + [("card", "3"), ("phone", "y")], "kind string, entity string")
    found = pii.assign(entities).collect()
    cards = [r.surrogate for r in found if r.kind == "card"]
    assert len(found) == 10 and len(set(cards)) == 9 and "3" not in cards


def test_surrogates_never_run_out(spark):
    """Scripts without a list of letters, a full private range, and short forms that are all taken."""
    names = ["u:محمد علي", "u:สมชาย", "u:გიორგი", "u:Արամ"]
    full = [f"192.168.{n >> 8}.{n & 255}" for n in range(1 << 16)]
    mails = [f"{c}@x.example.com" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = [("person", n) for n in names] + [("ip", n) for n in [*full, "8.8.8.8", "192.168.01.7"]] + [("email", m) for m in mails]
    rows += [("email", f"{c}@y.example.com") for c in "0123456789"]
    found = pii.assign(spark.createDataFrame(rows, "kind string, entity string")).collect()
    assert len(found) == len(rows) == len({(r.kind, r.surrogate) for r in found})
    assert all(r.surrogate != r.entity.removeprefix("u:") for r in found)
    assert all(r.surrogate.startswith("192.168.") for r in found if r.entity.startswith("192.168.") and r.entity != "192.168.01.7")
    for name in names:
        made = pii.surrogate("person", name, 0)
        assert made != name[2:] and len(made) == len(name[2:]) and pii._letters(name[2]).casefold() == pii._letters(made[0]).casefold()
    for kind, entity in [("ssn", "111-22-3333"), ("phone", "+1 23 45"), ("ip", "192.168.1.1"), ("person", "u:สมชาย")]:
        assert len({pii.surrogate(kind, entity, n) for n in range(pii.WIDE, pii.WIDE + 20)}) == 20


# 9: near-duplicates


def brute_fingerprint(text: str) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(ids, fps):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[a] = b
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(ids[i])
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(ids))]


def test_near_duplicates_against_brute_force(docs, nothing):
    found = rows_of(simhash.near_duplicates(docs))
    ids, texts = zip(*pairs(docs))
    fps = [brute_fingerprint(t) for t in texts]
    expected = zip(ids, [f"{f:016x}" for f in fps], reach(ids, fps))
    assert found == sorted(expected, key=repr)
    assert simhash.near_duplicates(nothing).count() == 0


def test_deduplicated_keeps_one_row_per_group(docs, nothing):
    kept = simhash.deduplicated(docs)
    ids, texts = zip(*pairs(docs))
    fps = [brute_fingerprint(t) for t in texts]
    expected = sorted({c for c in reach(ids, fps) if c is not None})
    named = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert kept.columns == docs.columns and sorted(named) == expected
    nameless = [r.text for r in kept.collect() if r.doc_id is None]
    assert nameless == [prose(9, 70)]
    assert simhash.deduplicated(nothing).count() == 0


def test_deduplicated_keeps_unlinked_texts_of_one_id(spark):
    """Ids that repeat, or are missing, lose no text without a copy."""
    a, b, c, d, e = (prose(40 + n, 60 + 9 * n) for n in range(5))
    rows = [(1, a), (1, b), (1, a), (2, b), (3, c), (2, c), (None, d), (None, d), (None, e), (4, e), (None, a), (3, d)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id int, text string, row int")
    kept = simhash.deduplicated(docs)
    expected = {a: 1, b: 1, c: 2, d: 3, e: 4}
    assert kept.columns == docs.columns
    assert sorted((r.text, r.doc_id) for r in kept.collect()) == sorted(expected.items())
    found = sorted(((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect()))
    assert found == sorted((i or 0, expected[t]) for i, t in rows)


def test_links_of_planted_fingerprints(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for seed in range(12):  # chains and stars
        x = fps[seed]
        for _ in range(15):
            x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.append(x)
            fps.append(fps[seed] ^ 1 << rng.randrange(64))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint").checkpoint()
    found = {r.doc_id: r.component_id for r in simhash.linked(frame).collect()}
    assert [found[n] for n in range(len(fps))] == reach(list(range(len(fps))), fps)


def test_components_of_chains_and_stars(spark):
    links = [(n, n + 1) for n in range(300)] + [(1000, n) for n in range(1001, 1100)] + [(5000, 5000), (None, 3)]
    found = {r.node: r.component_id for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {n: 0 for n in range(301)} | {n: 1000 for n in range(1000, 1100)}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 10: quality rules


def test_quality_rules_against_brute_force(docs, nothing):
    def base(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(words, words[1:], words[2:]))
        repeated = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        n = len(words)
        failed = n < 50 or 100 * len(repeated) > 50 * n
        return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)

    found = rows_of(quality_rules.quality(docs).drop("lost", "kept"))
    assert found == sorted(((d, *base(t)) for d, t in pairs(docs)), key=repr)
    assert quality_rules.quality(nothing).count() == 0


def test_line_first_cleaning(docs, nothing):
    kept = {r.doc_id: r for r in quality_rules.clean(docs).collect()}
    assert set(kept) == {3, 4, 5, 6, 8, 11, 12, 18, 19, None}
    assert kept[3].text == texts()[3] and kept[3].row == "row"
    assert kept[19].text == prose(8, 100) and kept[19].n_chars == len(prose(8, 100))
    assert quality_rules.clean(nothing).count() == 0
