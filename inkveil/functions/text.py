"""String expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITESPACE)) == ""


def norm_label(token: Column) -> Column:
    """A token as it is compared with labels: it always ends in a colon."""
    return F.when(token.endswith(":"), token).otherwise(F.concat(token, F.lit(":")))


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    """Case-insensitive search for any of a short list of configured terms."""
    lowered = {t.lower() for t in terms}
    shortest = sorted(t for t in lowered if not any(o in t for o in lowered - {t}))
    return reduce(lambda a, b: a | b, [F.lower(text).contains(t) for t in shortest], F.lit(False))


def url_decode(key: Column) -> Column:
    """Form decoding: '+' is a blank, %XX a byte; a '%' without two hex digits stays as it is."""
    return F.try_url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))
