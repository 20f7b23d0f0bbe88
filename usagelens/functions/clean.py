"""Column expressions that turn wire text into typed, null-safe values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagelens.schemas import UNKNOWN

# Every character that counts as white space in Unicode text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The texts that mean "true".
TRUE_TEXTS = ["true", "1", "yes"]
# How an infinite number may be written.
INFINITY_TEXTS = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]


def strip(c: Column) -> Column:
    """Text without surrounding white space."""
    return F.trim(c.cast("string"), F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Text without surrounding white space; null becomes the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def clean_wire_text(name: str) -> Column:
    """``clean_text`` for a column of raw events, where it runs on every row.

    Texts of printable ASCII need no more than the plain trim, which is many times
    faster than one for a set of characters. The column is referred to three times,
    so this is not for long expressions.
    """
    text = F.col(name).cast("string")
    stripped = F.when(text.rlike("[^ -~]"), strip(text)).otherwise(F.trim(text))
    return F.coalesce(stripped, F.lit(""))


def or_unknown(c: Column) -> Column:
    """Clean text, with ``Unknown`` for null and blank."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(UNKNOWN))


def clean_number(c: Column) -> Column:
    """A double, or null where the text is not a plain decimal number.

    The cast ignores blanks around a number. It also takes Java spellings such as
    ``1.0d`` and ``0x1p3``; those are the only numbers with a letter d, f or p, apart
    from the infinities, so they are refused.
    """
    text = c.cast("string")
    java = text.rlike("[dDfFpP]") & ~F.lower(F.trim(text)).isin(INFINITY_TEXTS)
    number = F.when(java, F.lit(None)).otherwise(text).try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def clean_bool(c: Column) -> Column:
    """True for a known "true" text, false for everything else, null included."""
    return F.coalesce(F.lower(strip(c)).isin(TRUE_TEXTS), F.lit(False))


def clean_timestamp(c: Column) -> Column:
    """An ISO-8601 date or date-time as an instant, or null.

    Accepted are ``yyyy-MM-dd``, with a time after a ``T`` or a blank, with fractions, with an
    offset or zone or without; without one the time is UTC, whatever the session's zone. Other
    forms are null, a bare time of day among them: the cast would put today's date on it.
    """
    text = F.trim(c.cast("string"))
    dated = (F.length(text) >= 10) & (F.substring(text, 5, 1) == "-")
    # Almost every time ends in Z; the rest is looked at more closely.
    zoned = text.endswith("Z") | text.rlike(r"[T ][0-9:.]+ ?([+-][0-9]|[A-Za-z])")
    whole = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z"))).when(
        zoned, text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(dated, whole).try_cast("timestamp")
