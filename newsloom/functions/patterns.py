"""Regular-expression pieces and string helpers shared by the text functions.

Java's ``\\w``, ``\\d`` and ``\\s`` are ASCII classes, so the Unicode classes are written out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGIT = r"\p{Nd}"
WORD = r"[\p{L}\p{N}_\x{0900}-\x{097F}]"
BLANK = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
_BLANK_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def strip(col: Column) -> Column:
    """Trim Unicode white space on both sides, not only blanks."""
    return F.trim(col, F.lit(_BLANK_CHARACTERS))


def rewrite_matches(col: Column, pattern: str, rewrite: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``rewrite(match)``; a null result keeps the match.

    The text between the matches comes from ``split``, the matches from ``regexp_extract_all``,
    and the two lists are woven together again. There is always one gap more than there are matches.
    """
    gaps = F.split(col, pattern, -1)
    matches = F.regexp_extract_all(col, F.lit(pattern), 0)
    changed = F.transform(matches, lambda m: F.coalesce(rewrite(m), m))
    return F.array_join(F.zip_with(gaps, changed, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
