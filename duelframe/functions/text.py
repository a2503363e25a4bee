"""Text functions that behave alike for every script and session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space of all scripts, by code point.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_SPACE = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(c, F.lit(WHITE))


def strip_set(c: Column, chars: str) -> Column:
    return F.btrim(c, F.lit(chars))


def collapse(c: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(c, rf"(?U){_SPACE}+", " ")


def non_empty(c: Column) -> Column:
    """Null for an empty text. The lambda names c once, where nullif would compute it twice."""
    return F.get(F.filter(F.array(c), lambda x: x != ""), F.lit(0))


def holds(c: Column, pattern: str, flags: str = "iU") -> Column:
    """Whether the pattern is found; false for a null."""
    return F.coalesce(c.rlike(f"(?{flags}){pattern}"), F.lit(False))


def replace(c: Column, pattern: str, by: str = "", flags: str = "idU") -> Column:
    return F.regexp_replace(c, f"(?{flags}){pattern}", by)


def split_first(c: Column, pattern: str, flags: str = "iU") -> Column:
    """An array of two at most, parted by the first match."""
    return F.split(c, f"(?{flags}){pattern}", 2)
