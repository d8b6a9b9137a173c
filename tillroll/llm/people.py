"""Names of people in a text, and which mentions mean the same person."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

# Titles that a name follows, with the gender they say (m, f, or unknown).
TITLES = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m",
    "Mrs": "f", "Ms": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Sra": "f",
    "Dr": "u", "Prof": "u",
}

# Small words within a family name.
_PARTICLES = frozenset("van von der den ter zu zur de del della di da das do dos du la le el al bin ben ibn y".split())

#: A name ends after so many words, also in a text all in capitals.
LONGEST = 8

_TITLE = re.compile(rf"\b(?:{'|'.join(TITLES)})\b\.?\s+")
#: An initial with its full stop, or a word with the apostrophes and hyphens inside it.
_WORD = re.compile(r"[^\W\d_](?:\.(?=[  ]?[^\W\d_])|(?:[^\W\d_]|['’-](?=[^\W\d_]))*)")
_POSSESSIVE = re.compile(r"['’]s$")


class Unit(NamedTuple):
    """A given name, an initial, or a family name with its particles; ``key`` is what spellings share."""

    start: int
    end: int
    key: str


class Mention(NamedTuple):
    """Where a person is named: which words of the entity are written (-1 - n for the initial of word n)."""

    start: int
    end: int
    entity: str
    form: tuple[int, ...]


def _words(text: str, at: int) -> Iterator[re.Match]:
    """The words from ``at`` on, as long as a single space or nothing (behind a full stop) parts them."""
    while match := _WORD.match(text, at):
        yield match
        at = match.end()
        if text[at : at + 1] in (" ", " "):
            at += 1
        elif not match[0].endswith("."):
            return


def _key(word: str) -> str:
    return _POSSESSIVE.sub("", word).casefold().rstrip(".").replace("’", "'")


def _units(text: str, at: int) -> list[Unit]:
    """The name that begins at ``at``: its capitalised words, at most two in a script without capitals."""
    units: list[Unit] = []
    small = None  # where the particles before the next word began
    for match in _words(text, at):
        word = match[0]
        if word in TITLES or len(units) == LONGEST:
            break
        particle = word.casefold() in _PARTICLES and (word.islower() or len(word) > 1 and word.isupper())
        if word[0].islower() and not particle:
            break
        if particle:
            small = match.start() if small is None else small
            continue
        if not word[0].isupper() and len(units) == 2:
            break
        start = match.start() if small is None else small
        end = match.end() - 2 if _POSSESSIVE.search(word) else match.end()
        key = _key(word) if small is None else "_".join([*text[small : match.start()].casefold().split(), _key(word)])
        units.append(Unit(start, end, key))
        small = None
        if end < match.end():
            break
    while units and len(units[-1].key) == 1 and text[units[-1].start].isupper():  # initials need a name behind them
        units.pop()
    return units


def _short(keys: tuple[str, ...]) -> Iterator[tuple[int, tuple[str, ...]]]:
    """(rank, key): the shorter forms a name may be referred to by, each with the rank of such a form."""
    if len(keys) > 2:
        yield 3, (keys[0], keys[-1])
    if len(keys) > 1:
        if len(keys[0]) > 1:
            yield 2, (keys[0][0], keys[-1])
        yield 1, (keys[-1],)
        if len(keys[0]) > 1:
            yield 0, (keys[0], "")
    if "_" in keys[-1]:
        yield 1, (keys[-1].rsplit("_", 1)[1],)


def _rank(keys: tuple[str, ...]) -> int:
    """How much of a name a form holds: 4 with middle names, 3 given and family name, 2 an initial, 1 one name."""
    if len(keys) == 2 and len(keys[0]) == 1:
        return 2
    return min(len(keys) + 1, 4) if len(keys) > 1 else 1


class _People:
    """The persons of a text, found by the forms of their names and by where they were named."""

    def __init__(self) -> None:
        self.names: list[tuple[str, ...]] = []
        self.genders: list[str] = []
        self.known: dict[tuple, int] = {}
        self.places: dict[tuple, list[tuple[int, int]]] = defaultdict(list)

    def add(self, keys: tuple[str, ...], gender: str) -> int:
        if (keys, gender) not in self.known:
            self.known[keys, gender] = len(self.names)
            self.names.append(keys)
            self.genders.append(gender)
        return self.known[keys, gender]

    def named(self, at: int, person: int) -> None:
        """Note a mention for the forms that its person may be referred to by."""
        for rank, key in {(_rank(self.names[person]), self.names[person]), *_short(self.names[person])}:
            self.places[rank, key, self.genders[person]].append((at, person))

    def settle(self) -> None:
        for places in self.places.values():
            places.sort()

    def nearest(self, rank: int, key: tuple[str, ...], gender: str, at: int) -> int | None:
        """The person last named before ``at`` whom this form may mean, else the first named behind it."""
        before, behind = [], []
        for other in "mfu" if gender == "u" else (gender, "u"):
            places = self.places.get((rank, key, other))
            if places:
                n = bisect_left(places, (at, 0))
                (before if n else behind).append(places[n - 1] if n else places[0])
        return max(before)[1] if before else min(behind)[1] if behind else None


def _form(units: list[Unit], name: tuple[str, ...]) -> tuple[int, ...]:
    """Which words of ``name`` the units are: the family name last, the others from the first on."""
    last = len(name) - 1
    if len(units) == 1:
        given = last and units[0].key == name[0] and units[0].key != name[last]
        return (0,) if given else (last,)
    firsts = []
    for n, unit in enumerate(units[:-1]):
        at = min(n, max(last - 1, 0))
        firsts.append(-1 - at if len(unit.key) == 1 else at)
    return (*firsts, last)


def people(text: str) -> list[Mention]:
    """All mentions of the people whom a text names with a title.

    A name has up to LONGEST capitalised words, with initials, apostrophes, hyphens and
    particles. Mentions under other titles, shortened to the first and last name, an
    initial, the family or the given name, and those without a title, mean the person of a
    fuller name that fits; of several the one last named before. A man and a woman are
    never one person. A single word without title is left alone if the text also has it in
    lower case. Mentions in a text never depend on other texts.
    """
    titled: list[tuple[list[Unit], tuple[str, ...], str]] = []
    at = 0
    while title := _TITLE.search(text, at):
        genders, at = [], title.start()
        while more := _TITLE.match(text, at):  # Herr Dr. ...
            genders.append(TITLES[more[0].rstrip().rstrip(".")])
            at = more.end()
        if units := _units(text, at):
            gender = next((g for g in genders if g != "u"), "u")
            titled.append((units, tuple(u.key for u in units), gender))
            at = units[-1].end
    if not titled:
        return []
    found = _People()
    by_rank: dict[int, list] = defaultdict(list)
    for mention in titled:
        by_rank[_rank(mention[1])].append(mention)
    owners: list[tuple[list[Unit], int]] = []
    taken = {units[0].start: units[-1].end for units, _, _ in titled}
    for rank in (4, 3, 2, 1):
        if rank == 1:  # whom a family name means, full names without title say as well
            owners += _untitled(text, found, taken, 2)
        genders = defaultdict(set)
        for _, keys, gender in by_rank[rank]:
            genders[keys].add(gender)
        made = []
        for units, keys, gender in by_rank[rank]:
            person = found.nearest(rank, keys, gender, units[0].start)
            if person is not None and {gender, found.genders[person]} == {"m", "f"}:
                person = None  # known to be a man or a woman since
            if person is None:
                said = genders[keys] - {"u"}
                person = found.add(keys, gender if gender != "u" or len(said) != 1 else min(said))
            elif found.genders[person] == "u":
                found.genders[person] = gender
            made.append((units, person))
        for units, person in made:
            found.named(units[0].start, person)
        found.settle()
        owners += made
    owners += _untitled(text, found, taken, 1)
    mentions = []
    for units, person in owners:
        name = found.names[person]
        entity = f"{found.genders[person]}:{' '.join(name)}"
        mentions.append(Mention(units[0].start, units[-1].end, entity, _form(units, name)))
    return sorted(mentions)


def _untitled(text: str, found: _People, taken: dict[int, int], least: int) -> list[tuple[list[Unit], int]]:
    """(units, person) of the mentions of ``least`` words or more without a title, the longest first at each place.

    They are noted in ``found`` and ``taken``.
    """
    firsts = {key[0].split("_")[0] for _, key, _ in found.places}
    words = list(_WORD.finditer(text))
    plain = {m[0] for m in words if m[0][0].islower()}
    made, until = [], 0
    for match in words:
        start = match.start()
        if start < until:
            continue
        if start in taken:
            until = taken[start]
            continue
        if _key(match[0]) not in firsts or match[0][0].islower() and match[0] not in _PARTICLES:
            continue
        units = _units(text, start)
        while len(units) >= least:
            keys = tuple(u.key for u in units)
            person = None
            if len(units) > 1 or keys[0] not in plain:
                person = found.nearest(_rank(keys), keys, "u", start)
                if person is None and len(units) == 1:
                    person = found.nearest(0, (keys[0], ""), "u", start)
            if person is not None:
                made.append((units, person))
                until = units[-1].end
                break
            units = units[:-1]
    for units, person in made:
        taken[units[0].start] = units[-1].end
        found.named(units[0].start, person)
    found.settle()
    return made
