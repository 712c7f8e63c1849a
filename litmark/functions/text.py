"""Text expressions: trimming, null tokens, column names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from litmark.fixed_values import NULL_TOKENS, WHITESPACE


def strip(c: Column) -> Column:
    """Remove every kind of white space at both ends (plain ``trim`` only removes blanks).

    Most values start and end with a printable ASCII character; those skip the search through the white-space set.
    """
    first, last = F.ascii(c), F.ascii(F.substring(c, -1, 1))
    settled = first.between(33, 126) & last.between(33, 126)
    return F.when(settled, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def clean(c: Column) -> Column:
    """Stripped text, NULL when it is one of the null tokens. Strips twice: see ``cleaning.clean_text`` for whole tables."""
    return drop_tokens(strip(c))


def drop_tokens(c: Column) -> Column:
    """NULL for the null tokens."""
    return F.when(~c.isin(NULL_TOKENS), c)


def blank(c: Column) -> Column:
    """True for NULL and for text made of blanks only."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def snake_name(name: str) -> str:
    """Lower snake case; each run of other characters (accents too) becomes one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def lower_name(name: str) -> str:
    return name.strip().lower()


def one_line(c: Column, length: int = 1000) -> Column:
    """Message without line breaks, at most ``length`` characters."""
    return F.substring(F.translate(c, "\n", " "), 1, length)
