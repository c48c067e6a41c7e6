"""Missing-value predicates. The token sets are fixed values of the data contract."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean "missing" after trimming and lower-casing.
M9 = ("", "nan", "none", "null", "n/a", "na", "--", "unknown", "not available")
M8 = ("", "nan", "none", "null", "n/a", "na", "--", "unknown")
M5 = ("", "nan", "none", "null", "na", "n/a")
M4 = ("", "nan", "none", "null", "nat")
# Tokens of the test tables (TESTDATA.md).
TABLE_TOKENS = ("empty", *M9)


@lru_cache
def _pattern(tokens: tuple[str, ...]) -> str:
    """A text of one token in any case between white space; other text is left at its first letters.

    The Kelvin sign is the one other character whose lower case is an ASCII letter.
    """
    letter = lambda c: f"[{c}{c.upper()}{'\\u212A' * (c == 'k')}]" if c.isalpha() else re.escape(c)
    return r"(?U)^\s*(?:" + "|".join("".join(map(letter, t)) for t in tokens) + r")\s*\z"


def is_missing(col: Column, tokens: tuple[str, ...] = M9) -> Column:
    """True when the value is null or one of `tokens`; never null itself."""
    return col.isNull() | col.cast("string").rlike(_pattern(tokens))


def present(col: Column, tokens: tuple[str, ...] = M9) -> Column:
    """The value, or null when it is missing."""
    return F.when(~is_missing(col, tokens), col)
