"""Text cleaning expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space, and the four ASCII separators.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def remove_chars(text: Column, chars: str) -> Column:
    """Delete every occurrence of each character of `chars`."""
    return F.translate(text, chars, "")


def relabel(text: Column, patterns: tuple[str, ...], label: str) -> Column:
    """Replace whatever matches one of the regular expressions by `label`, wherever it stands."""
    return F.regexp_replace(text, "|".join(patterns), label)


def nth_part(text: Column, separator: str, index: int, limit: int = -1) -> Column:
    """Part `index` (from 0) of `text` split at a literal separator; null if there is none.

    `F.get` is used rather than `[index]`, which raises under ANSI mode when out of bounds.
    """
    return F.get(F.split(text, re.escape(separator), limit), F.lit(index))


def trim_blank_edges(text: Column) -> Column:
    """Strip all white space, tabs included, from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def trim_leading_spaces(text: Column) -> Column:
    """Strip spaces, but not tabs, from the start."""
    return F.ltrim(text)
