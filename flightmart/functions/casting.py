"""ANSI-safe conversions that keep the lenient meaning of the old casts.

The source jobs were written for a runtime where ``CAST('NA' AS INT)`` is
NULL and ``CAST('95.5' AS INT)`` is 95.  With ANSI mode on (the default
today) the first raises and ``try_cast`` turns the second into NULL.  The
expressions below reproduce the lenient result exactly, with built-in
functions only, under either mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import col_of
from .sqltext import ident, to_int_sql

# Characters the lenient string-to-number cast strips from both ends:
# ASCII control characters, space and DEL.
EDGE_BLANKS = r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$"
# Text the lenient cast accepts as an integer: optional sign, digits, and an
# optional fractional part that is dropped ("95.5" -> 95, ".5" -> 0).
INT_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]*)$"


def to_int(c: str | Column) -> Column:
    """Integer value of ``c`` with lenient-cast semantics; NULL if not a number.

    Out-of-range values give NULL, as before.  Works on any input type
    because it goes through the string form.

    Text that starts with a digit or a sign (nearly all values) goes
    straight to ``try_cast``; everything else (tokens, padding, ``.5``) takes
    the regular-expression rules.  Checking the first character first keeps
    tokens such as ``NA`` away from ``try_cast``: under ANSI rules it rejects
    text by raising and catching an exception, ~20 us per value, where the
    first-character test costs nanoseconds and the rules well under 1 us.
    """
    if isinstance(c, str):
        return F.expr(to_int_sql(ident(c), EDGE_BLANKS, INT_TEXT))
    s = col_of(c).cast("string")
    text = F.regexp_replace(s, EDGE_BLANKS, "")
    whole = F.regexp_replace(text, r"[.].*$", "")
    value = F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int"))
    first = F.ascii(s)
    starts_like_int = first.between(48, 57) | first.isin(43, 45)
    return F.coalesce(F.when(starts_like_int, s.try_cast("int")), F.when(text.rlike(INT_TEXT), value))


def to_int_text(c: str | Column) -> Column:
    """``to_int`` rendered back to text (NULL stays NULL)."""
    return to_int(c).cast("string")


def _starts_with_number_field(pattern: str) -> bool:
    """Whether text matching ``pattern`` must begin with a digit (e.g. ``MM/dd/yyyy``)."""
    if pattern[:3] in ("MMM", "LLL"):
        return False  # month names
    return pattern[:1] in ("y", "M", "L", "d", "D", "H", "h", "k", "K", "m", "s")


def parse_date(c: str | Column, pattern: str = "MM/dd/yyyy") -> Column:
    """Date parsed with ``pattern``; text that does not fit gives NULL.

    When the pattern starts with a number field, text that does not start
    with a digit (``None``, ``NA``) is answered NULL without calling the
    parser, which would reject it by throwing and catching an exception.
    """
    s = col_of(c).cast("string")
    parsed = F.try_to_date(s, pattern)
    if _starts_with_number_field(pattern):
        return F.when(F.ascii(s).between(48, 57), parsed)
    return parsed


def date_from_parts(
    year: str | Column,
    month: str | Column,
    day: str | Column,
    skip_null_parts: bool = False,
) -> Column:
    """Date built as ``yyyy-MM-dd`` text from integer parts.

    Month and day are left-padded to two characters.  By default any NULL
    part gives a NULL date.  ``skip_null_parts=True`` keeps the older
    behaviour of joining only the present parts, where a missing day turns
    ``2008-01`` into 2008-01-01.
    """
    parts = [
        col_of(year).cast("string"),
        F.lpad(col_of(month).cast("string"), 2, "0"),
        F.lpad(col_of(day).cast("string"), 2, "0"),
    ]
    if skip_null_parts:
        text = F.concat_ws("-", *parts)
    else:
        text = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2])
    return text.try_cast("date")
