"""Column predicates for the missing-value model.

A value is *missing* when it is SQL NULL or equals one of a small set of
text tokens.  Matching is exact (case-sensitive, no trimming).  Token sets
are a parameter because some columns legitimately hold a token as a value
(the carrier code ``NA``).

Every function here builds a plain ``Column`` expression, so predicates
stay inside whole-stage codegen and, when applied directly to a scanned
string column, are pushed to the Parquet reader by Catalyst.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sqltext import ident, is_missing_sql

# Fixed values that must equal the reference's for identical results:
# the four text tokens that mean "missing", the extra tail-number token,
# and the label that replaces a missing tail number.
MISSING_TOKENS: tuple[str, ...] = ("null", "NULL", "NA", "NaN")
UNKNOWN_TAIL_TOKEN = "UNKNOW"
UNKNOWN_TAIL_LABEL = "Unknown Tail Number"


def col_of(c: str | Column) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: str | Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """True when ``c`` is NULL or equals one of ``tokens``; never NULL.

    Non-string columns are compared through their string form, which is
    what the lenient (ANSI-off) ``IN`` coercion did: a NaN double matches
    the ``NaN`` token, an int never matches.  On a string column the cast
    is removed by the optimizer, so the predicate still reaches the scan.
    """
    if isinstance(c, str):
        return F.expr(is_missing_sql(ident(c), tokens))
    if not tokens:
        return c.isNull()
    return c.isNull() | c.cast("string").isin(list(tokens))


def is_missing_num(c: str | Column) -> Column:
    """NaN-or-NULL test for floating point columns."""
    c = col_of(c)
    return F.isnan(c) | c.isNull()


def any_of(conds: Iterable[Column]) -> Column:
    """Fold predicates into one OR; an empty list is FALSE."""
    conds = list(conds)
    return reduce(or_, conds) if conds else F.lit(False)


def all_of(conds: Iterable[Column]) -> Column:
    """Fold predicates into one AND; an empty list is TRUE."""
    conds = list(conds)
    return reduce(and_, conds) if conds else F.lit(True)


def any_missing(cols: Iterable[str | Column], tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """True when any of ``cols`` is missing."""
    return any_of(is_missing(c, tokens) for c in cols)
