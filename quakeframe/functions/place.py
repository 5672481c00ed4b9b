"""Region from the free-text place of an event.

Each step mentions the one before only once. Nested tests that repeat a step would double its
work with every level, also in filters that the optimizer moves below the projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOWHERE = "Unknown"

# Blanks of a regular expression, all blanks of ASCII and those of other scripts.
BLANKS = " \t\n\x0b\f\r"
ASCII_BLANKS = BLANKS + "\x1c\x1d\x1e\x1f"
WIDE_BLANKS = (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The last "of" that is followed by a blank and something more; the atomic group keeps an earlier
# one from being tried when only blanks follow.
_UP_TO_OF = r"^(?>.*\bof\s+(?=.))(\S.*)$"
_SUFFIX = r"\s+region$"


def _after_comma(place: Column) -> Column:
    return F.when(F.contains(place, F.lit(",")), F.substring_index(place, ",", -1))


def _replaced(place: Column, word: str, text: Column, pattern: str, by: str) -> Column:
    """A regular expression costs far more than a search, so places without the word skip it."""
    return F.when(F.contains(place, F.lit(word)), F.regexp_replace(text, pattern, by)).otherwise(text)


def _named(text: Column) -> Column:
    """Never null, so that joins and filters on a region need no test for it."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NOWHERE))


def catalogue_region(place: Column) -> Column:
    """After the last comma, else after a lower-case ``of``, else the place.

    The suffix is removed before trimming: a place of only " region" has no name left.
    """
    tail = F.ltrim(_after_comma(place), F.lit(BLANKS))
    found = F.coalesce(F.nullif(tail, F.lit("")), _replaced(place, "of", place, _UP_TO_OF, "$1"))
    return _named(F.trim(_replaced(F.lower(place), "region", found, "(?i)" + _SUFFIX, "")))


def _strip(text: Column, place: Column) -> Column:
    """Trimming by a set with characters beyond ASCII is slow, so only such places do it."""
    ascii_only = F.length(place) == F.octet_length(place)
    return F.when(ascii_only, F.trim(text, F.lit(ASCII_BLANKS))).otherwise(
        F.trim(text, F.lit(ASCII_BLANKS + WIDE_BLANKS))
    )


def live_region(place: Column) -> Column:
    """As above with ``of`` in any case; blanks of any kind go before the suffix does."""
    tail = _strip(_after_comma(place), place)
    rest = _replaced(F.lower(place), "of", place, "(?iU)" + _UP_TO_OF, "$1")
    found = F.coalesce(F.nullif(tail, F.lit("")), _strip(rest, place))
    return _named(_replaced(F.lower(place), "region", found, "(?iU)" + _SUFFIX, ""))
