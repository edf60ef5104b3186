"""Word splitting as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The white space that ends a word: blank, and tab to carriage return.
BLANKS = "\t\n\x0b\x0c\r"
#: What ends an alphanumeric word: all of ASCII but digits and small letters.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def blank_words(text: Column) -> Column:
    """The runs of anything but white space. Null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(spaced, " "), "")


def alnum_words(text: Column) -> Column:
    """Lower-cased runs of digits, letters and non-ASCII characters. Null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_ALNUM), "")


def windowed(values: Column, size: int, of: Callable[..., Column], kind: str) -> Column:
    """``of`` over each run of ``size`` neighbours; an empty ``array<kind>`` if too short.

    ``values`` must be a plain column: a computed one would be computed per element.
    """
    starts = F.sequence(F.lit(0), F.size(values) - size)
    each = F.transform(starts, lambda i: of(*[F.get(values, i + j) for j in range(size)]))
    return F.when(F.size(values) >= size, each).otherwise(F.array().cast(f"array<{kind}>"))


def hashes(words: Column) -> Column:
    """A 64-bit hash of each word."""
    return F.transform(words, lambda w: F.xxhash64(w))
