"""Search predicates: literal, case-insensitive substring tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def contains_ci(col: str, needle: str, regex: bool = False) -> Column:
    """Case-insensitive test of ``needle`` inside ``col``; literal unless ``regex``.

    ``%``, ``_`` and regex metacharacters are plain characters in literal mode.
    A null field gives null (callers decide how null counts).
    """
    if regex:
        return F.col(col).rlike("(?i)" + needle)
    return F.lower(F.col(col)).contains(F.lit(needle.lower()))


def all_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds, F.lit(True))
