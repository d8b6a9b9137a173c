"""Line-first cleaning: judge every line, drop the bad ones, reject what loses too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A line fails with more symbols, exclamation marks or separators than these shares of its characters.
MAX_SYMBOLS = 0.04
MAX_EXCLAMATIONS = 0.06
MAX_SEPARATORS = 0.05
#: Lines of so many characters are boilerplate where they come again in the same text.
DUPLICATE_CHARS = 15
#: A document is rejected if its failing lines hold more than this share of its characters.
MAX_LOST = 0.5

SYMBOLS = "[#*$%&|<>]"
NOT_BLANK = "[^\\x20\\x09-\\x0D]"
#: Phrases of notices that are not content; a line of few characters that holds one fails.
NOTICES = "(?i)(cookie policy|privacy policy|terms of (use|service)|all rights reserved|click here|sign up now)"
NOTICE_CHARS = 100


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _line(line: Column) -> Column:
    """Verdict on one line: its characters, and whether it stays."""
    size = F.length(line)
    fails = (
        (_count(line, SYMBOLS) > MAX_SYMBOLS * size)
        | (_count(line, "!") > MAX_EXCLAMATIONS * size)
        | (_count(line, "[|»›]") > MAX_SEPARATORS * size)
        | ((size <= NOTICE_CHARS) & line.rlike(NOTICES))
    )
    return F.struct(line.alias("line"), size.alias("chars"), (~fails).alias("stays"))


def _repeated(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` to rows with ``words``.

    Windows are compared by 64-bit hashes; their sorted order brings equal ones together
    and a word counts once, whichever of its windows repeat.
    """
    w = F.col("words")
    hashed = F.transform(w, lambda word, i: F.xxhash64(word, F.get(w, i + 1), F.get(w, i + 2)))
    windows = F.slice(hashed, 1, F.greatest(F.size(w) - 2, F.lit(0)))
    rows = rows.withColumn("windows", F.when(F.size("words") >= 3, windows).otherwise(F.slice(hashed, 1, 0)))
    # Most texts repeat no window; only the others are sorted.
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("sorted", F.when(some, F.sort_array(placed)).otherwise(F.slice(placed, 1, 0)))
    s = F.col("sorted")

    def twice(x, i):
        before = F.when(i > 0, F.get(s, i - 1)["h"])
        return (before.eqNullSafe(x["h"])) | (F.get(s, i + 1)["h"].eqNullSafe(x["h"]))

    rows = rows.withColumn("places", F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"])))
    p = F.col("places")
    fresh = F.transform(p, lambda x, i: F.when(i > 0, F.least(F.lit(3), x - F.get(p, i - 1))).otherwise(3))
    total = F.aggregate(fresh, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", total).drop("windows", "sorted", "places")


def measure(rows: DataFrame) -> DataFrame:
    """Add the base counts and the cleaned text to rows with a column ``text``.

    Added are n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint),
    base_failed, lost (share of characters in failing lines), clean_text and kept.
    Failing lines are those with too many symbols, exclamation marks or separators,
    notices, and later copies of a line of 15 characters or more. A text whose lines all
    stay is returned as it is; otherwise failing and blank lines are dropped. Null and
    empty texts have no words, so they fail and clean to "". Rows are independent:
    repeated rows get equal results.
    """
    text = F.coalesce("text", F.lit(""))
    rows = rows.withColumns({"words": _words(text), "lines": F.split(text, "\n")})
    rows = _repeated(rows)
    full = F.filter("lines", lambda x: x.rlike(NOT_BLANK))
    chars = F.length(F.array_join("words", "")).cast("bigint")
    rows = rows.withColumns({"n_words": F.size("words").cast("bigint"), "word_chars": chars, "lines": full}).drop("words")
    # A short line is made unique by its number, so that only longer ones fall together.
    numbered = lambda x, i: F.when(F.length(x) < DUPLICATE_CHARS, F.concat(x, F.lit("\n"), i.cast("string"))).otherwise(x)
    first = F.transform(F.array_distinct(F.transform("lines", numbered)), lambda x: F.substring_index(x, "\n", 1))
    rows = rows.withColumns(
        {
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
            "n_lines": F.size("lines"),
            "total": F.length(F.array_join("lines", "")),
            "verdicts": F.transform(first, _line),
        }
    )
    stays = F.filter("verdicts", lambda x: x["stays"])
    symbols = _count(text, SYMBOLS).cast("bigint")
    rows = rows.withColumns({"stay": stays, "n_symbols": symbols}).drop("lines", "verdicts")
    left = F.aggregate("stay", F.lit(0).cast("bigint"), lambda a, x: a + x["chars"])
    rows = rows.withColumns(
        {
            "lost": F.when(F.col("total") > 0, 1 - left / F.col("total")).otherwise(0.0),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
            "clean_text": F.when(F.size("stay") == F.col("n_lines"), text).otherwise(
                F.array_join(F.transform("stay", lambda x: x["line"]), "\n")
            ),
        }
    )
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= MAX_LOST)).drop("stay", "n_lines", "total")


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, lost and kept."""
    measured = measure(docs.select("doc_id", "text"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost", "kept"
    )


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents with their failing lines dropped and ``n_chars`` set anew.

    All other columns are passed on as they are, whatever their names.
    """
    measured = measure(docs.select(F.struct("*").alias("row"), "text"))
    # Moved below the measures the filter would spell each of them out once per use. It
    # does not move below the number of the row, which it therefore names.
    measured = measured.withColumn("n", F.monotonically_increasing_id()).where("kept and n >= 0")
    changed = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("bigint")}
    return measured.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
