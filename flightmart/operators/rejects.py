"""Casts with a ledger: what a lenient cast could not read, kept with its row.

A lenient cast turns text it cannot read into NULL, and afterwards nobody can
tell a gap in the source from a value that was lost.  ``cast_with_rejects``
casts as ``cast_columns`` and ``parse_dates`` do and, in the same pass, puts every
present text that came out NULL into one array column.  Written once, that
frame gives both outputs: the typed rows, and the ledger of rejects.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import EDGE_BLANKS, INT_TEXT, parse_date, to_int
from ..functions.missing import MISSING_TOKENS, is_missing
from ..functions.sqltext import ident

REJECTS = "__rejects"
#: Bits of a reject's reason: text of blanks alone, not a number or a date,
#: a number outside the type's range, a date of the right form that is none.
BLANK, MALFORMED, OUT_OF_RANGE, NO_SUCH_DATE = 1, 2, 4, 8


def _int_reason(c: Column) -> Column:
    text = F.regexp_replace(c, EDGE_BLANKS, "")
    return (
        F.when(text == "", BLANK | MALFORMED)
        .when(text.rlike(INT_TEXT), OUT_OF_RANGE)
        .otherwise(MALFORMED)
    )


def _date_reason(c: Column, pattern: str) -> Column:
    shape = "^" + "".join("[0-9]" if ch.isalpha() else "\\" + ch for ch in pattern) + "$"
    return F.when(F.trim(c) == "", BLANK | MALFORMED).when(c.rlike(shape), NO_SUCH_DATE).otherwise(MALFORMED)


def cast_with_rejects(
    df: DataFrame,
    ints: Iterable[str] = (),
    dates: Mapping[str, str] | None = None,
    tokens: Sequence[str] = MISSING_TOKENS,
) -> DataFrame:
    """``df`` with text columns cast and an array column ``__rejects`` of
    ``(column, raw, reason)`` for the row's present values that became NULL.

    A value is present if it is neither NULL nor one of ``tokens``.  ``dates``
    maps columns to patterns of numeric fields.  One projection, no shuffle.
    """
    text = lambda name: F.expr(ident(name)).cast("string")
    typed = {c: to_int(c) for c in ints}
    reasons = {c: _int_reason(text(c)) for c in typed}
    for c, pattern in (dates or {}).items():
        typed[c] = parse_date(c, pattern)
        reasons[c] = _date_reason(text(c), pattern)
    entries = [
        F.when(
            ~is_missing(c, tokens) & value.isNull(),
            F.struct(F.lit(c).alias("column"), text(c).alias("raw"), reasons[c].cast("int").alias("reason")),
        )
        for c, value in typed.items()
    ]
    none = F.array().cast("array<struct<column:string,raw:string,reason:int>>")
    found = F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else none
    # The ledger column first: it reads the raw text, the casts replace it.
    return df.withColumns({REJECTS: found, **typed})


def typed_rows(cast: DataFrame) -> DataFrame:
    """The typed rows of a (staged) ``cast_with_rejects`` frame."""
    return cast.drop(REJECTS)


def reject_ledger(cast: DataFrame, key: Sequence[str]) -> DataFrame:
    """``(key..., column, raw, reason)``: a row per reject.  Of a staged frame
    only the key columns and the rejects are read."""
    keys = [F.expr(ident(k)) for k in key]
    return cast.where(F.size(REJECTS) > 0).select(*keys, F.inline(REJECTS))


def reject_counts(cast: DataFrame) -> DataFrame:
    """``(column, reason, rejects)`` over a ``cast_with_rejects`` frame."""
    return cast.select(F.inline(REJECTS)).groupBy("column", "reason").agg(F.count(F.lit(1)).alias("rejects"))
