"""String functions (STR-1..7), all JVM-side column expressions.

Regex patterns here use only syntax that Java and RE2 read the same way
(``\\x{hhhh}`` escapes, ``\\Q..\\E`` quoting), so the DuckDB oracle can share them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsmart.functions.columns import as_col


def _char_class(codepoints: list[int]) -> str:
    """Compact ``[...]`` class from sorted code points, runs folded to ranges."""
    parts: list[str] = []
    i = 0
    while i < len(codepoints):
        j = i
        while j + 1 < len(codepoints) and codepoints[j + 1] == codepoints[j] + 1:
            j += 1
        lo, hi = codepoints[i], codepoints[j]
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
        i = j + 1
    return "[" + "".join(parts) + "]"


# Whitespace as Python's ``str.split()`` sees it (the rule: ``str.isspace``). It
# includes the information separators U+001C..U+001F, which Java's ``(?U)\s`` lacks.
WHITESPACE_CODEPOINTS = [cp for cp in range(0x110000) if chr(cp).isspace()]
WHITESPACE_RUN = _char_class(WHITESPACE_CODEPOINTS) + "+"
_WHITESPACE = "".join(chr(cp) for cp in WHITESPACE_CODEPOINTS)


def split_on_whitespace(col: str | Column) -> Column:
    """Tokens between single whitespace characters (runs leave empty tokens).

    Every whitespace character is first translated to a space, so the split is on a
    one-character literal, which skips the regex engine; same tokens as splitting on
    ``WHITESPACE_RUN`` once empties are dropped."""
    return F.split(F.translate(as_col(col), _WHITESPACE, " " * len(_WHITESPACE)), " ")


def quote_literal(pattern: str) -> str:
    """Regex that matches ``pattern`` literally (Java and RE2 both read ``\\Q..\\E``)."""
    if "\\E" in pattern:
        # \Q..\E cannot hold \E; fall back to per-character escaping.
        return re.sub(r"([^\w])", r"\\\1", pattern)
    return "\\Q" + pattern + "\\E"


def _lowered_pattern(pattern: str | Column, literal: bool) -> Column:
    """Lower-case the pattern text first, then quote it when literal."""
    if isinstance(pattern, Column):
        low = F.lower(pattern)
        return F.concat(F.lit("\\Q"), low, F.lit("\\E")) if literal else low
    low = pattern.lower()
    return F.lit(quote_literal(low) if literal else low)


def count_matches(col: str | Column, pattern: str | Column, literal: bool = False,
                  lowered: bool = False) -> Column:
    """STR-4: non-overlapping matches of ``pattern`` in ``lower(col)``; the pattern is
    lower-cased too. Null text gives null. ``lowered=True``: ``col`` is already lower
    case (lets callers lower a text once for several patterns)."""
    text = as_col(col) if lowered else F.lower(as_col(col))
    return F.regexp_count(text, _lowered_pattern(pattern, literal))


def contains_match(col: str | Column, pattern: str | Column, literal: bool = False,
                   lowered: bool = False) -> Column:
    """STR-5: does ``lower(col)`` contain ``pattern`` (regex unless ``literal``)."""
    text = as_col(col) if lowered else F.lower(as_col(col))
    return F.regexp(text, _lowered_pattern(pattern, literal))


def date_prefix(col: str | Column) -> Column:
    """STR-6: the date part of an ISO string (text before the first ``T``)."""
    return F.substring_index(as_col(col), "T", 1)


# Host of an http(s)/ftp URL, lower-cased; the same regex runs in DuckDB.
HOST_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#@]+@)?([^/:?#]+)"


def url_host(col: str | Column) -> Column:
    host = F.regexp_extract(as_col(col), HOST_PATTERN, 2)
    return F.when(host == "", F.lit(None)).otherwise(F.lower(host))
