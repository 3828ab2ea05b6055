"""Text expressions: Unicode strip and the word-count token estimate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Unicode counts as white space for stripping.
# Spark's own trim removes only U+0020.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d"
    "\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same as an SQL literal.
WHITESPACE_SQL = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "'"

# A token of the rough estimate is a run of anything but ASCII white space.
TOKEN_PATTERN = r"[^ \t\n\r\f]+"


def strip(col: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def estimate_tokens(text: Column) -> Column:
    """Rough token count: number of white-space separated words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN_PATTERN)), F.lit(0)).cast("bigint")


def tokens(text: Column) -> Column:
    """The words counted by :func:`estimate_tokens`, as an array."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))
