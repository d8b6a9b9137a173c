"""Private data: detected entities get keyed surrogates of the same type and form."""

from __future__ import annotations

import hashlib
import hmac
import random
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import slices
from tillroll.llm.people import TITLES, people
from tillroll.session import checkpoint

#: Key of the surrogates: the same key gives the same surrogates. Set your own in production.
KEY = b"tillroll surrogates"

#: From this attempt on a surrogate may leave its form: it gets longer with every attempt.
WIDE = 12
#: From so many distinct addresses on, 192.168.x.y is permuted as a whole.
CROWDED = 8192

EMAIL, TOKEN, CARD, PHONE, IP, SSN, IBAN, PERSON = "email token card phone ip ssn iban person".split()

# Names that surrogates are made of, by gender; unknown takes either list.
_GIVEN = {
    "m": "Adam Bruno Carl Daniel Erik Felix Georg Hugo Ivan Jonas Karim Louis Martin Noel Oscar Paul Quentin Robert "
    "Simon Thomas Ulrich Victor Walter Xavier Yann Zeno".split(),
    "f": "Anna Berta Clara Diana Elena Flora Greta Helena Irene Julia Karin Laura Maria Nora Olivia Paula Rosa Sara "
    "Tanja Ursula Vera Wanda Xenia Yvonne Zoe".split(),
}
# Family names are a beginning, a middle and an end.
_FAMILY = (
    "Ab Ba Bor Cas Dan Eb Fal Gar Han Ib Jor Kal Lam Mar Nor Ol Pel Quin Ros Sal Tor Ul Vel Wen Zim".split(),
    "be di fa ga ke li lo ma me mi na ni no pe ra re ri ro sa se si ta te ti to va ve vi za zi".split(),
    "ck d ger hl k l ler lt m mann n nd nger ns r rd rt s sen ss st t tt x y z".split(),
)

# Country codes of two digits; 1 and 7 have one, all others three.
_TWO_DIGITS = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98".split()
)

_LOCAL = r"[^\W_](?:[\w.+-]*[^\W_])?"
_PATTERNS = [
    (EMAIL, re.compile(rf"(?<![\w.+-]){_LOCAL}@[^\W_][\w-]*(?:\.[^\W_][\w-]*)*\.[^\W\d_]{{2,}}"), "@"),
    (TOKEN, re.compile(r"(?<![0-9A-Za-z])(?=[0-9A-Za-z]*\d)(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?:AKIA|ASIA)[0-9A-Z]{16})(?![0-9A-Za-z])"), None),
    (IBAN, re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"), None),
    (IP, re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)(?![A-Za-z_])"), "."),
    (SSN, re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), "-"),
    (PHONE, re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]\d{3,4}[ .-]\d{4}(?![\w-])|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])"), None),
    (CARD, re.compile(r"(?<![0-9A-Za-z])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?)(?![0-9A-Za-z])"), None),
]
# Every kind but addresses and names holds a digit.
_DIGIT = re.compile("[0-9]")
_CLOUD = ("AKIA", "ASIA")

#: What separates the digits of a number; its mentions are one entity however it is written.
_SEPARATORS = str.maketrans("", "", " .()-")
_NUMBERS = {CARD, PHONE, SSN, IBAN}

#: An entity's mention: where it is, and how it is written.
_FIELDS = [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("entity", pa.string()), ("form", pa.list_(pa.int32()))]
_SPANS = T.ArrayType(
    T.StructType()
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("kind", T.StringType())
    .add("entity", T.StringType())
    .add("form", T.ArrayType(T.IntegerType()))
)
_ARROW_SPANS = pa.list_(pa.struct(_FIELDS))


class Span(NamedTuple):
    """A mention of an entity; ``form`` says which words of a person's name are written, and is None for others."""

    start: int
    end: int
    kind: str
    entity: str
    form: tuple[int, ...] | None


def detect(text: str) -> list[Span]:
    """The mentions of entities, in order and apart.

    Where two overlap, the one whose pattern is listed first stays; names come last.
    ``entity`` is what mentions of one entity share: e-mail addresses and hexadecimal tokens
    in lower case, other numbers without what separates their digits, persons by their
    fullest name in the text and the gender of their titles (see :mod:`people`).
    """
    found: list[Span] = []
    taken = bytearray(len(text))

    def add(start: int, end: int, kind: str, entity: str, form: tuple[int, ...] | None) -> None:
        if not any(taken[start:end]):
            taken[start:end] = b"\1" * (end - start)
            found.append(Span(start, end, kind, entity, form))

    digits = _DIGIT.search(text) is not None
    for kind, pattern, needed in _PATTERNS:
        if (needed is None or needed in text) and (digits or kind == EMAIL):
            for match in pattern.finditer(text):
                entity = match[0]
                if kind in _NUMBERS:
                    entity = entity.translate(_SEPARATORS)
                elif kind == EMAIL or kind == TOKEN and not entity.startswith(_CLOUD):
                    entity = entity.lower()
                add(match.start(), match.end(), kind, entity, None)
    if any(title in text for title in TITLES):
        for mention in people(text):
            add(mention.start, mention.end, PERSON, mention.entity, mention.form)
    return sorted(found)


def written(mention: str, kind: str, made: str, form: list[int] | None) -> str:
    """The surrogate ``made`` in the form of a mention: its separators, shortening and capitals."""
    if kind == PERSON:
        words = made.split(" ")
        made = " ".join(words[n] if n >= 0 else words[-1 - n][0] + "." for n in form)
    elif kind in _NUMBERS:
        digits = iter(made)
        made = "".join(next(digits, "") if c.isalnum() or c == "+" else c for c in mention) + "".join(digits)
    elif kind == IP or mention.startswith(_CLOUD):
        return made
    letters = [c for c in mention if c.isalpha()]
    return made.upper() if len(letters) > 1 and mention.isupper() else made


class _Stream:
    """Numbers that the key, the entity and the attempt determine."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{entity}\0{attempt}".encode(), hashlib.sha256).digest()
        self.value, self.block = int.from_bytes(self.seed), 0

    def below(self, n: int) -> int:
        if self.value < n << 64:
            self.block += 1
            self.value = int.from_bytes(hashlib.sha256(self.seed + self.block.to_bytes(8)).digest())
        self.value, drawn = divmod(self.value, n)
        return drawn


# First and last letters of alphabets, so that a letter is replaced by one of its script and case.
_ALPHABETS = ["az", "AZ", "àö", "øþ", "ÀÖ", "ØÞ", "αρ", "ΑΡ", "ая", "АЯ", "את", "あん", "アン", "一鿋", "가힣"]
_RANGES = [(ord(a), ord(b)) for a, b in _ALPHABETS]


@lru_cache(4096)
def _letters(char: str) -> str:
    """The letters near ``char`` of its script and category."""
    script, category, block = unicodedata.name(char, "").split(" ")[0], unicodedata.category(char), ord(char) & ~0xFF
    near = map(chr, range(block, block + 256))
    return "".join(c for c in near if unicodedata.category(c) == category and unicodedata.name(c, "").split(" ")[0] == script)


def _like(text: str, numbers: _Stream) -> str:
    """``text`` with each letter replaced by one of its script and case, each digit by a digit."""
    made = []
    for char in text:
        code = ord(char)
        if "0" <= char <= "9":
            char = str(numbers.below(10))
        else:
            for low, high in _RANGES:
                if low <= code <= high:
                    char = chr(low + numbers.below(high - low + 1))
                    break
            else:
                if char.isalnum() and (letters := _letters(char)):
                    char = letters[numbers.below(len(letters))]
        made.append(char)
    return "".join(made)


def _luhn(digits: str) -> int:
    double = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in double)) % 10


def surrogate(kind: str, entity: str, attempt: int, key: bytes = KEY) -> str:
    """The replacement of an entity: same type, length, punctuation, script and case.

    Country codes, the first digit of a card, a valid check digit, private address ranges
    and the gender of a name are kept. Further attempts draw others; names grow longer with
    them, so that no number of people uses up the lists. Some forms have few surrogates: from
    attempt WIDE on all grow, by digits, letters or names, and addresses leave their range.
    """
    numbers = _Stream(key, kind, entity, attempt)
    more = "0" * (attempt - WIDE + 1)
    if more and kind not in (IP, PERSON):
        local, at, domain = surrogate(kind, entity, 0, key).partition("@")
        return local + _like(more, numbers) + at + domain
    if kind == EMAIL:
        local, _, domain = entity.partition("@")
        host, _, top = domain.rpartition(".")
        # One domain has one surrogate, whoever writes from it.
        return f"{_like(local, numbers)}@{_like(host, _Stream(key, 'domain', domain, 0))}.{top}"
    if kind == TOKEN:
        if entity.startswith(_CLOUD):
            return entity[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[numbers.below(32)] for _ in entity[4:])
        return "".join("0123456789abcdef"[numbers.below(16)] for _ in entity)
    if kind == CARD:
        made = entity[0] + _like(entity[1:], numbers)
        digits = [c for c in made if c.isdigit()]
        if _luhn("".join(c for c in entity if c.isdigit())) == 0:
            rest = _luhn("".join([*digits[:-1], "0"]))
            made = made[:-1] + str(-rest % 10)
        return made
    if kind == IP:
        parts = entity.split(".")
        keep = 0 if more else 1 if parts[0] in ("10", "127") else 2 if parts[:2] == ["192", "168"] else 0
        drawn = [str(1 + numbers.below(254)) for _ in parts]
        return ".".join(parts[:keep] + drawn[keep:])
    if kind == PHONE:
        country = 0
        if entity.startswith("+"):
            country = 2 if entity[1] in "17" else 3 if entity[1:3] in _TWO_DIGITS else 4
        tail = _like(entity[country:], numbers)
        return entity[:country] + re.sub(r"[0-9]", lambda m: str(2 + int(m[0]) % 8), tail, count=1)
    if kind == IBAN:
        return entity[:2] + _like(entity[2:], numbers)
    if kind == PERSON:
        return _person(entity, numbers, attempt)
    return _like(entity, numbers)


def _person(entity: str, numbers: _Stream, attempt: int) -> str:
    """A name with as many words: given names of the gender, and a family name, which longer attempts make double."""
    gender, _, name = entity.partition(":")
    words = name.split(" ")
    if attempt < WIDE and any(ord(c) > 0x24F for c in name if c != "’"):  # another script: letters of that script
        return " ".join(w[:1].upper() + w[1:] for w in _like(name.replace("_", " "), numbers).split(" ")[-len(words) :])
    given = _GIVEN.get(gender) or _GIVEN["m"] + _GIVEN["f"]
    family = "-".join("".join(part[numbers.below(len(part))] for part in _FAMILY) for _ in range(1 + attempt // 2))
    if words[-1][1:2] == "'" and len(words[-1]) > 2:  # O'Brien
        family = f"{words[-1][:2].upper()}{family}"
    return " ".join([*(given[numbers.below(len(given))] for _ in words[1:]), family])


@lru_cache(4)
def _cycle(key: bytes) -> dict[int, int]:
    """A keyed permutation of 16-bit numbers that leaves none in place."""
    order = list(range(1 << 16))
    random.Random(hmac.new(key, b"192.168", hashlib.sha256).digest()).shuffle(order)
    return dict(zip(order, order[1:] + order[:1]))


def _permuted(entity: str, key: bytes) -> str:
    third, fourth = map(int, entity.split(".")[2:])
    new = _cycle(key)[third << 8 | fourth]
    return f"192.168.{new >> 8}.{new & 255}"


def assign(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity) rows: no two entities share a
    surrogate, and none is an entity of the corpus itself. Only the range 192.168.x.y may be
    too small for that: with CROWDED addresses or more, each gets another of the range by a
    permutation, which may be one of the corpus.

    Every entity proposes; of those that propose the same, or something taken or real,
    only the smallest free one stays, and the others try again. The tables are joined as
    a whole in Spark; a second round sees only collisions.
    """

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("entity")
            made = [_permuted(e, key) for e in names.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), names, pa.array(made, pa.string())], ["kind", "entity", "surrogate"])

    def propose(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds, names = batch.column("kind"), batch.column("entity")
                made = [surrogate(k, e, attempt, key) for k, e in zip(kinds.to_pylist(), names.to_pylist())]
                yield pa.RecordBatch.from_arrays([kinds, names, pa.array(made, pa.string())], ["kind", "entity", "surrogate"])

        return run

    entities = checkpoint(entities)
    # Persons are told in lower case.
    told = F.when(F.col("kind") == PERSON, F.lower("surrogate")).otherwise(F.col("surrogate"))
    real = entities.select("kind", F.when(F.col("kind") == PERSON, F.expr("substr(entity, 3)")).otherwise(F.col("entity")).alias("told"))
    pending, accepted, attempt = entities, None, 0
    # Leading zeros would give an address two spellings; they are drawn like any other.
    private = (F.col("kind") == IP) & F.col("entity").rlike(r"^192\.168\.(0|[1-9]\d*)\.(0|[1-9]\d*)$")
    if entities.where(private).count() >= CROWDED:
        accepted = checkpoint(entities.where(private).mapInArrow(permute, "kind string, entity string, surrogate string"))
        pending = checkpoint(entities.where(~private))
    while True:
        proposed = checkpoint(pending.mapInArrow(propose(attempt), "kind string, entity string, surrogate string"))
        best = proposed.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        best = best.withColumn("told", told).join(real, ["kind", "told"], "left_anti")
        if accepted is not None:
            best = best.join(accepted, ["kind", "surrogate"], "left_anti")
        best = best.select("kind", "entity", "surrogate")
        accepted = checkpoint(best if accepted is None else accepted.unionAll(best))
        pending = checkpoint(pending.join(accepted, ["kind", "entity"], "left_anti"))
        attempt += 1
        if pending.isEmpty():
            return accepted


def _spread(docs: DataFrame, keep: bool, schema: T.StructType):
    """Rows with entities and their spans (``keep``), or the rows without any.

    Both halves detect: to store the texts without entities, most of all, costs more.
    """
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            spans: list = []
            for part in slices([t or "" for t in texts]):
                spans += [detect(t) if t else [] for t in texts[part]]
            rows = [n for n, found in enumerate(spans) if bool(found) == keep]
            if not rows:
                continue
            columns = list(batch.take(pa.array(rows)).columns)
            if keep:
                named = [[s._asdict() for s in spans[n]] for n in rows]
                columns.append(pa.array(named, _ARROW_SPANS))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def _written(place: str, schema: T.StructType):
    """The texts of the column ``place``, with spans and the surrogates of their entities, made anew: in one pass over each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, sizes = [], []
            for text, spans, known in zip(*(batch.column(n).to_pylist() for n in (place, "spans", "known"))):
                new = {(k["kind"], k["entity"]): k["surrogate"] for k in known}
                pieces, at = [], 0
                for s in spans:
                    mention = text[s["start"] : s["end"]]
                    pieces += [text[at : s["start"]], written(mention, s["kind"], new[s["kind"], s["entity"]], s["form"])]
                    at = s["end"]
                made.append("".join([*pieces, text[at:]]))
                sizes.append(len(spans))
            columns = [batch.column(n) for n in batch.schema.names if n not in ("id", "spans", "known")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.string()), pa.array(sizes, pa.int64())], schema.names)

    return run


def _one_person(entities: DataFrame) -> DataFrame:
    """(kind, entity, same) of distinct entities: a person of unknown gender is the man or the woman of that
    name if the corpus has only one of them, so both get one surrogate."""
    name = F.when(F.col("kind") == PERSON, F.expr("substr(entity, 3)")).alias("name")
    gender = F.when(F.col("kind") == PERSON, F.expr("substr(entity, 1, 1)"))
    men, women = (F.max(gender == g).alias(g) for g in "mf")
    unknown = entities.where(gender == "u").select("kind", "entity", name)
    told = entities.where(gender != "u").groupBy(name).agg(men, women).where("m <> f")
    same = F.concat(F.when(F.col("m"), "m:").otherwise("f:"), "name")
    moved = unknown.join(told, "name").select("kind", "entity", same.alias("same"))
    return entities.join(moved, ["kind", "entity"], "left").select("kind", "entity", F.coalesce("same", "entity").alias("same"))


def _replaced(docs: DataFrame, key: bytes) -> tuple[list[str], DataFrame]:
    """The documents with entities: their columns under other names, ``made``, the new
    text, and ``n``, the number of its entities."""
    # Numbers instead of names while rows are in Spark's hands: names may clash.
    names = [f"_{n}" for n in range(len(docs.columns))]
    given = [T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)]
    found = _spread(docs, True, T.StructType([*given, T.StructField("spans", _SPANS)]))
    found = checkpoint(found.withColumn("id", F.monotonically_increasing_id()))
    each = found.select("id", F.inline(F.array_distinct(F.transform("spans", lambda s: F.struct(s["kind"], s["entity"])))))
    each = each.toDF("id", "kind", "entity")
    entities = checkpoint(_one_person(each.select("kind", "entity").distinct()))
    known = assign(entities.select("kind", F.col("same").alias("entity")).distinct(), key)
    known = entities.join(known.withColumnRenamed("entity", "same"), ["kind", "same"]).drop("same")
    pairs = each.join(known, ["kind", "entity"]).groupBy("id").agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("known"))
    schema = T.StructType([*given, T.StructField("made", T.StringType()), T.StructField("n", T.LongType())])
    joined = found.join(pairs, "id").select(*names, "spans", "known")
    return names, joined.mapInArrow(_written(names[docs.columns.index("text")], schema), schema)


def hidden(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with every entity replaced, ``n_chars`` set anew where a text has changed.

    All columns are kept, whatever their names. Null and empty texts have no entities.
    Repeated rows and repeated mentions get the same surrogates, each in the form of its
    mention: an entity has one in the whole corpus. An empty table gives no rows.
    """
    names, changed = _replaced(docs, key)
    made = {"text": F.col("made"), "n_chars": F.length("made").cast("bigint")}
    columns = [made.get(c, F.col(n)).alias(c) for n, c in zip(names, docs.columns)]
    return _spread(docs, False, docs.schema).unionAll(changed.select(*columns))


def surrogates(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """(doc_id, n_entities, text) per row of ``docs``; see :func:`hidden`."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    _, changed = _replaced(docs, key)
    plain = _spread(docs, False, docs.schema).select("doc_id", F.lit(0).cast("bigint").alias("n_entities"), "text")
    return plain.unionAll(changed.select(F.col("_0").alias("doc_id"), F.col("n").alias("n_entities"), F.col("made").alias("text")))
