"""Shared pieces of the training-data operators: the word rule, and which rows train."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of characters other than space and U+0009 to U+000D.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def training_row(doc_id: Column) -> Column:
    """False for the fifth of all documents that is held out."""
    return F.crc32(doc_id.cast("string")) % 5 != 0
