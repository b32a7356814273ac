"""Words and held-out rows as the contracts of the operators define them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of anything but these characters: space, and tab to carriage return.
BREAKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor
