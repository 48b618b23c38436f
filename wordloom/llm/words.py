"""Column expressions shared by the operators: case, words and let-bindings."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two word classes of the contracts, as the characters between words.
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
NOT_ALNUM_CHARS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and only those, in lower case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _split(text: Column, between: str) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, between))


def space_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return _split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS)), SPACE)


def alnum_words(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters of the lower-cased text; null has none."""
    text = F.coalesce(text, F.lit(""))
    # (pure ASCII, the usual case, needs no table of characters)
    lower = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(lower_ascii(text))
    return _split(F.btrim(lower, F.lit(NOT_ALNUM_CHARS)), NOT_ALNUM)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]
