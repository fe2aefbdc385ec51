"""Small text helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character a line strip removes (Unicode white space plus
# the four ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java regex class.
SPACE = (
    r"[\t\n\x0B\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
# Joins regex groups inside one string; patterns used with `capture` never match it.
_SEP = "\u0001"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space at both ends."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def capture(c: Column | str, pattern: str, groups: int) -> Column:
    """All groups of a whole-text match as one array, NULL without a match.

    One matcher run yields every group (``regexp_extract`` would run the
    pattern once per group).  ``pattern`` must cover the whole text and only
    its last group may match U+0001.
    """
    c = col(c)
    joined = F.regexp_replace(
        c, pattern, _SEP + _SEP.join(f"${i}" for i in range(1, groups + 1))
    )
    matched = lambda p: (F.get(p, F.lit(0)) == "") & (F.size(p) == groups + 1)
    values = let(
        F.split(joined, _SEP, groups + 1),
        lambda p: F.when(matched(p), F.slice(p, 2, groups)),
    )
    # Text that holds the separator itself could look like a match.
    return F.when(~F.startswith(c, F.lit(_SEP)) | c.rlike(pattern), values)


def first_group(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Group of the first match, NULL without a match.

    ``regexp_extract`` gives '' for "no match"; telling the two apart would run
    the pattern twice.
    """
    return F.get(F.regexp_extract_all(col(c), F.lit(pattern), F.lit(group)), F.lit(0))
