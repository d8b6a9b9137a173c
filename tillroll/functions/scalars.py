"""Column expressions over one scan row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.constants import WEEKDAYS


def signed_department(department: Column, scan_count: Column) -> Column:
    """Department name, with a leading ``-`` on returned lines; null stays null."""
    return F.when(scan_count < 0, F.concat(F.lit("-"), department)).otherwise(department)


def weekday_ordinal(weekday: Column) -> Column:
    """Monday 0 to Sunday 6; null stays null, any other text fails the query."""
    position = F.array_position(F.array(*[F.lit(day) for day in WEEKDAYS]), weekday)
    unknown = F.raise_error(F.concat(F.lit("unknown weekday: "), weekday)).cast("int")
    return F.when(weekday.isNull(), F.lit(None).cast("int")).when(position > 0, (position - 1).cast("int")).otherwise(unknown)


def is_mon_to_fri(ordinal: Column) -> Column:
    return (ordinal < 5).cast("int")


def fineline_feature(fineline: Column) -> Column:
    return F.concat(F.lit("FLN_"), fineline.cast("string"))


def upc_feature(upc: Column) -> Column:
    return F.concat(F.lit("UPC_"), upc.cast("string"))


def label_item(trip_type: Column) -> Column:
    """The trip type as a basket item: its negative, as text."""
    return (-trip_type).cast("string")


def quoted(text: Column) -> Column:
    """A text value as shown in a listing of factors; null shows as ``nan``."""
    quote = F.when(text.contains("'") & ~text.contains('"'), F.lit('"')).otherwise(F.lit("'"))
    return F.coalesce(F.concat(quote, text, quote), F.lit("nan"))


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin 1 to ``bins`` of [low, high]; the last bin is closed.

    A range of no width is widened by a half on each side.
    """
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low)
    return F.least(F.floor((value - start) * F.lit(bins) / width) + 1, F.lit(bins)).cast("int")


def bin_edge(edge: Column, low: Column, high: Column, bins: int) -> Column:
    """Edge 0 to ``bins`` of the same bins."""
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low)
    return start + edge * width / F.lit(bins)


def shuffle_key(visit: Column, seed: int) -> Column:
    """A position in a reproducible random order: 60 bits of a digest of seed and visit."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), visit.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
