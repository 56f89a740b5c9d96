"""String column expressions (all row-local, codegen-friendly, no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder spellings treated as missing text, matched
# exactly and case-sensitively after stripping.
DEFAULT_MISSING_VALUES = ("", " ", "NA", "N/A", "na", "n/a", "NULL", "null",
                          "None", "none", "NaN", "nan", "-", "?",
                          "unknown", "UNKNOWN")

# Python's str.strip() removes every Unicode whitespace character; Spark's
# trim() removes only blanks.  (?U) makes \s Unicode-aware in Java regex.
_EDGE_SPACE = r"(?U)^\s+|\s+$"
_ANY_SPACE = r"(?U)\s+"


def strip(col: Column) -> Column:
    return F.regexp_replace(col, _EDGE_SPACE, "")


def normalize_spaces(col: Column) -> Column:
    return F.regexp_replace(col, _ANY_SPACE, " ")


def title_case(col: Column) -> Column:
    """Python ``str.title()``: upper-case a letter that follows a non-letter,
    lower-case every other letter.

    ``initcap`` only capitalises after blanks, so the string is split just
    before every letter that follows a non-letter; each piece then starts
    with the letter to capitalise (or is the leading non-letter run).
    """
    pieces = F.split(col, r"(?<=\P{L})(?=\p{L})")
    cased = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                                   F.lower(F.substring(p, 2, 1 << 30))))
    return F.array_join(cased, "")


def is_missing_token(col: Column, tokens: Sequence[str] = DEFAULT_MISSING_VALUES) -> Column:
    return col.isin(list(tokens))


def format_pct(col: Column, digits: int = 1) -> Column:
    """``"12.3%"``"""
    return F.format_string(f"%.{digits}f%%", col)


def format_ratio(col: Column, digits: int = 2) -> Column:
    """``"5.06:1"``"""
    return F.format_string(f"%.{digits}f:1", col)


def add_commas(col: Column) -> Column:
    """Thousands separator and two decimals, e.g. ``1,234.50``."""
    return F.format_number(col, 2)
