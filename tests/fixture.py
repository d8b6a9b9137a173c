"""A small scan log with every trap: returns, zero counts, nulls, ties, a visit without departments."""

from __future__ import annotations

SCHEMA = (
    "visit_number bigint, trip_type int, weekday string, upc bigint, scan_count bigint, "
    "department string, fineline int"
)

TRAIN = [
    (1, 3, "Monday", 4011, 2, "PRODUCE", 5501),
    (1, 3, "Monday", 999, 1, "DAIRY", 10),
    (1, 3, "Monday", 999, -1, "DAIRY", 10),
    (2, 3, "Saturday", 4011, 1, "PRODUCE", 5501),
    (2, 3, "Saturday", 999, 2, "DAIRY", 10),
    (2, 3, "Saturday", None, 1, None, None),
    (3, 8, "Sunday", None, -1, "PHARMACY RX", None),
    (4, 5, "Friday", 77, 0, "TOYS", 7),
    (6, 3, "Sunday", None, 1, None, None),
]

TEST = [
    (5, None, "Monday", 4011, 3, "PRODUCE", 5501),
    (7, None, "Tuesday", None, 1, "ACCESSORIES", None),
    (7, None, "Tuesday", None, 1, "DAIRY", None),
    (7, None, "Tuesday", None, 1, "PRODUCE", None),
]

CATEGORIES = [
    ("PRODUCE", "Food"), ("DAIRY", "Food"),
    ("PRODUCE", "Non_Discretionary"), ("DAIRY", "Non_Discretionary"),
    ("TOYS", "Hobbies"),
]


def rows(frame, *columns):
    """Sorted tuples of a DataFrame, arrays as tuples."""
    picked = frame.select(*columns) if columns else frame
    as_tuple = [tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in picked.collect()]
    return sorted(as_tuple, key=repr)
