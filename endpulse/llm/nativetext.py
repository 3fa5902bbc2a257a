"""Words of a text as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; lower() does the same where all is ASCII, and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD), "")
