"""The Merkle manifest, against a plain tree over all documents."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import pytest

from tillroll.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, leaf string, n bigint, place int"


def digest(*texts: str) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def said(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """The root, and per node the place in its run and the run's others, level by level."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, grouped = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for at, held in enumerate(below[i : i + 2]):
                for leaf in held:
                    paths[leaf].append((at, [x for k, x in enumerate(run) if k != at]))
            above.append(digest(*run))
            grouped.append(sum(below[i : i + 2], []))
        nodes, below = above, grouped
    return nodes[0], paths


def plain_proofs(docs: list[tuple]) -> list[tuple]:
    trees: dict = {}
    for doc_id, text, lang, source, n_chars, *_ in docs:
        leaf, altered = (
            digest(said(doc_id), said(source), said(lang), said(n), said(text)) if n_chars is not None or n is None else None
            for n in (n_chars, None if n_chars is None else n_chars + 1)
        )
        hit = doc_id is not None and crc32(str(doc_id).encode()) % 7 == 0
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, altered if hit else leaf, doc_id))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    made = [plain_tree([leaf[2] for leaf in sorted(trees[lang])]) for lang in order]
    root, tops = plain_tree([subroot for subroot, _ in made])
    out = []
    for lang, (subroot, paths), top in zip(order, made, tops):
        for (_, _, leaf, end, doc_id), path in zip(sorted(trees[lang]), paths):
            for at, others in path + top:
                run = list(others)
                run.insert(at, end)
                end = digest(*run)
            proof = digest(*(x for _, others in path + top for x in others))
            out.append((doc_id, leaf, subroot, root, proof, end, end == root))
    return sorted(out, key=repr)


def documents(n: int) -> list[tuple]:
    rng = random.Random(n)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "en", "de", "é", "", None]) if i else "one"
        rows.append((i * 3, "words " * rng.randrange(40), lang, rng.choice(["a", "b", None]), rng.choice([1, 9, None])))
    rows += [rows[5]] * 3 + [(15, "another", "en", "a", 4), (15, None, "en", None, None), (15, "", "en", "", 0)]
    rows += [(None, "x", "en", "a", 1), (None, "y", "en", "a", 2), (None, None, None, None, None)]
    rows.append((77, "long " * 100_000, "de", "a", 500_000))
    return [(*r, "tree", "leaf", 1, 2) for r in rows]


@pytest.mark.parametrize("span", [2, 4, 12])
def test_proofs_against_a_plain_tree(spark, span):
    docs = documents(150)
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    found = sorted((tuple(r) for r in merkle.proofs(frame, span).collect()), key=repr)
    assert found == plain_proofs(docs)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17])
def test_small_trees(spark, n):
    docs = [(i, "t", "en", "s", 1) for i in range(n)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted((tuple(r) for r in merkle.proofs(frame, 2).collect()), key=repr) == plain_proofs(docs)


def test_no_documents(spark):
    assert merkle.proofs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_rows_are_spread(spark):
    rows = spark.range(20_000, numPartitions=8).selectExpr(
        "1L as doc_id", "'t' as text", "'en' as lang", "'s' as source", "1L as n_chars"
    )
    placed = merkle.placed(merkle.leaves(rows))
    assert sorted(r.place for r in placed.select("place").collect()) == list(range(20_000))
    per_task = placed.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    assert max(r["count"] for r in per_task) < 10_000


def test_missing_nodes_are_the_least(spark):
    rng = random.Random(5)
    for n in (1, 2, 5, 13, 64, 100):
        nodes = [sha256(str(i).encode()).digest() for i in range(n)]
        levels = [dict(enumerate(level)) for level in merkle._rise(nodes, merkle.height(n))]
        for _ in range(20):
            held = sorted(rng.sample(range(n), rng.randrange(1, n + 1)))
            asked = merkle.missing(held, n)
            fetched = {at: levels[at[0]][at[1]] for at in asked}
            known = merkle.derived({p: nodes[p] for p in held}, n, fetched)
            assert known[-1] == levels[-1]
            for place in held:
                path = merkle.siblings(place, n, known)
                assert merkle.folded(nodes[place], place, path) == levels[-1][0]
            # Exactly the nodes that stand beside a path and above none of the leaves.
            paths = {(level, p >> level) for p in held for level in range(merkle.height(n))}
            beside = {(level, p ^ 1) for level, p in paths if p ^ 1 in levels[level]} - paths
            assert set(asked) == beside and len(asked) == len(beside)
