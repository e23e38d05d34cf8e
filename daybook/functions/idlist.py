"""Columns of pasted identifier lists: split, normalise, format.

One row holds one list, so a table of lists is processed where it lies; no
row meets another and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_WIDTH = 12
# Whitespace of any script (with the four separator control characters that
# count as whitespace there), comma, semicolon.
_SEPARATORS = "(?U)[\\s\\x1c-\\x1f,;]+"
# The opening and closing text of each output mode.
_WRAPPERS = {"quoted": ("'", "'"), "bracketed": ("('", "')"), "plain": ("", "")}


def parse_ids(c: Column) -> Column:
    """Text to an array of identifiers, order and repeats kept."""
    return F.filter(F.split(c, _SEPARATORS), lambda token: token != "")


def strip_zeros(c: Column) -> Column:
    """Drop leading zeros; all zeros become a single ``0``."""
    return F.regexp_replace(c, "^0+(?=.)", "")


def pad_zeros(c: Column, width: int) -> Column:
    """Zero-pad to `width`, never cutting; a sign stays in front."""
    signed = c.rlike("^[+-]")
    sign = F.when(signed, F.substring(c, 1, 1)).otherwise("")
    digits = F.regexp_replace(c, "^[+-]", "")
    padded = F.concat(sign, F.lpad(digits, F.lit(width) - F.length(sign), F.lit("0")))
    return F.when(F.length(c) >= width, c).otherwise(padded)


def _width(value) -> int:
    try:
        return int(value)
    except (TypeError, ValueError):
        return DEFAULT_WIDTH


def format_ids(
    c: Column, mode: str = "quoted", strip: bool = False, pad: bool = False, width=DEFAULT_WIDTH
) -> Column:
    """Text of identifiers to one formatted list.

    `mode` is ``quoted``, ``bracketed`` or ``plain`` (any other value means
    plain). With both flags set, zeros are stripped before padding. A width
    that is not a number means 12.
    """
    digits = _width(width)
    opening, closing = _WRAPPERS.get(mode, _WRAPPERS["plain"])

    def one(token: Column) -> Column:
        if strip:
            token = strip_zeros(token)
        if pad:
            token = pad_zeros(token, digits)
        return F.concat(F.lit(opening), token, F.lit(closing))

    return F.array_join(F.transform(parse_ids(c), one), ", ")
