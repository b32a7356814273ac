"""String expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a chat message is split and trimmed on, and the longest
# word taken for a ticker.
BLANK = (
    r"[ \t\n\r\f\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
TICKER_MAX_LENGTH = 5


def ticker_of(value: Column | str) -> Column:
    """Tickers are stored and compared in upper case."""
    return F.upper(F.col(value) if isinstance(value, str) else value)


def clip(text: Column, length: int) -> Column:
    """The first `length` characters, unmarked."""
    return F.substring(text, 1, length)


def clip_marked(text: Column, length: int) -> Column:
    """Cut to `length` characters, with dots only where something was cut."""
    return F.when(F.length(text) > length, F.concat(clip(text, length), F.lit("..."))).otherwise(text)


def snippet(text: Column, length: int) -> Column:
    """The first `length` characters and dots, always."""
    return F.concat(clip(text, length), F.lit("..."))


def strip_blanks(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def first_capital_word(text: Column) -> Column:
    """The first short word written in capitals only, or null."""
    words = F.split(text, f"{BLANK}+")
    capital = F.filter(
        words,
        lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) <= TICKER_MAX_LENGTH),
    )
    return F.try_element_at(capital, F.lit(1))
