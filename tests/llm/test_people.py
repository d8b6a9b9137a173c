"""Private data: who is meant by a name, and what is left of it in the texts."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tillroll.llm import pii
from tillroll.llm.people import people

LETTER = (
    "Mr John Smith met Dr John Smith, and Mr Smith left; John Smith said so. Of Dr. Juan Carlos Perez we know that Perez "
    "and Juan Perez are one. Mr O'Brien and Mr J. Smith's dog ran. Call +1 (017) 555-7713 or +1 017 555 7713. "
    "Cards 4111 1111 1111 1111, 4111-1111-1111-1111 and 4111111111111111. Herr Prof. Jan van der Berg: Berg, JAN VAN DER BERG."
)


def entities(text: str) -> list[tuple[str, str]]:
    return [(text[m.start : m.end], m.entity) for m in people(text)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Mr John Smith, Dr John Smith, Mr Smith, John Smith", ["m:john smith"] * 4),
        ("Mr Smith came. Mr John Smith and Mr J. Smith", ["m:john smith"] * 3),
        ("Mr Smith and Mrs Smith", ["m:smith", "f:smith"]),
        ("Mr John Smith, Mr Adam Smith, Mr Smith; John Smith, Mr Smith", ["m:john smith", *["m:adam smith"] * 2, *["m:john smith"] * 2]),
        ("Dr Anna Meyer; Frau Meyer; Herr Meyer", ["f:anna meyer", "f:anna meyer", "m:meyer"]),
        ("Dr. Juan Carlos Perez, Juan Perez, Juan, Perez, PEREZ", ["u:juan carlos perez"] * 5),
        ("Mr Will Green will go. Will came.", ["m:will green"]),
        ("Dr محمد علي ذهب", ["u:محمد علي"]),
        ("Mr Smith\nThe end. Smith’s hat", ["m:smith", "m:smith"]),
        ("John Smith without a title; mr smith; Mr; Mr 5; Mr J. left", []),
    ],
)
def test_mentions(text, expected):
    assert [entity for _, entity in entities(text)] == expected


def test_mentions_of_random_letters():
    """Full names that share no word are never mixed up, however they are mentioned."""
    rng = random.Random(5)
    for _ in range(50):
        names = [(f"Given{chr(65 + n)}a".replace("Given", "Gi" + "xyz"[n % 3]), f"Fam{chr(97 + n)}") for n in range(6)]
        pieces, meant = [], []
        for given, family in names:
            pieces.append(f"Mr {given} {family}")
            meant.append(f"m:{given.lower()} {family.lower()}")
        for _ in range(20):
            given, family = rng.choice(names)
            pieces.append(rng.choice([f"Mr {family}", f"Dr {family}", family, given, f"{given} {family}", f"{given} {family}".upper()]))
            meant.append(f"m:{given.lower()} {family.lower()}")
        assert [entity for _, entity in entities(" met ".join(pieces))] == meant


def test_crowded_texts_take_linear_time():
    started = time.time()
    for text in ["Mr Smith Smith " * 20_000, "Mr John Smith " + "Smith " * 50_000, "Mr A. " * 50_000]:
        people(text)
    assert time.time() - started < 20


def test_letter_keeps_nothing_private(spark):
    docs = spark.createDataFrame([(1, LETTER), (2, "Dr John Smith"), (3, "nothing")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in pii.surrogates(docs).collect()}
    made = found[1].text
    assert found[1].n_entities == 17 and found[3].text == "nothing"
    assert not re.search("John|Smith|Juan|Carlos|Perez|Brien|Berg|JAN|VAN|BERG|5557713|555.7713|4111", made)
    first = re.match(r"Mr (\w+ ([\w'-]+)) met Dr (.+?), and Mr (.+?) left; (.+?) said", made)
    assert first[1] == first[3] == first[5] and first[2] == first[4]
    # Of unknown gender elsewhere, but the only one of the name.
    assert found[2].text == f"Dr {first[1]}"
    assert re.search(rf"Mr O'[A-Z]\w+ and Mr {first[1][0]}\. {re.escape(first[2])}'s dog", made)
    perez = re.search(r"Of Dr\. (\w+) \w+ (\w+) we know that (\w+) and (\w+) (\w+) are", made)
    assert perez[2] == perez[3] == perez[5] and perez[1] == perez[4]
    phones = re.search(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3}) (\d{3}) (\d{4})\.", made)
    assert phones.groups()[:3] == phones.groups()[3:]
    cards = re.search(r"Cards ([\d ]+), ([\d-]+) and (\d+)\.", made).groups()
    assert len({re.sub(r"\D", "", c) for c in cards}) == 1 and pii._luhn(cards[2]) == 0
    berg = re.search(r"Herr Prof\. (\w+) (\w+): (\w+), (\w+ \w+)\.", made)
    assert berg[2] == berg[3] and berg[4] == f"{berg[1]} {berg[2]}".upper()


def test_replacing_against_brute_force(spark):
    """Many entities in one text, repeated rows: equal to replacing span by span from the end."""
    rng = random.Random(3)
    mails = [f"user{n}@host{n % 7}.example.org" for n in range(300)]
    long = " ".join(rng.choice(mails) + " x" for _ in range(20_000))
    docs = spark.createDataFrame([(1, long), (2, long), (3, LETTER), (4, None), (5, "")], "doc_id bigint, text string")
    hidden = {r.doc_id: r.text for r in pii.hidden(docs).collect()}
    spans = {text: pii.detect(text) for text in (long, LETTER)}
    distinct = {(s.kind, s.entity) for found in spans.values() for s in found}
    known = pii.assign(spark.createDataFrame(sorted(distinct), "kind string, entity string")).collect()
    made = {(r.kind, r.entity): r.surrogate for r in known}
    assert len(made) == len(distinct) == len({(k, v) for (k, _), v in made.items()})
    for text, ids in ((long, (1, 2)), (LETTER, (3,))):
        expected = text
        for s in reversed(spans[text]):
            form = None if s.form is None else list(s.form)
            expected = expected[: s.start] + pii.written(text[s.start : s.end], s.kind, made[s.kind, s.entity], form) + expected[s.end :]
        assert all(hidden[i] == expected for i in ids)
    assert hidden[4] is None and hidden[5] == ""


def test_clashing_columns(spark):
    names = ["text", "id", "spans", "known", "entity", "kind", "_0", "made", "n", "n_chars"]
    row = ["Mr John Smith", 1, 2, 3, 4, 5, 6, 7, 8, 13]
    docs = spark.createDataFrame([row], ", ".join(f"{n} {'string' if n == 'text' else 'bigint'}" for n in names))
    found = pii.hidden(docs)
    made = found.first()
    assert found.columns == names and list(made)[1:-1] == row[1:-1] and made.n_chars == len(made.text)
    assert found.select(F.lit(1)).count() == 1 and "Smith" not in made.text
