"""Cleaning and derivation operators.

All operators are ``DataFrame -> DataFrame`` (usable with ``df.transform``)
and add only Project nodes: no shuffle, no Python, one codegen stage.
Operators that replace several columns do it in one ``withColumns`` so
every new value is computed from the *input* row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import date_from_parts, parse_date, to_int
from ..functions.missing import (
    MISSING_TOKENS,
    UNKNOWN_TAIL_LABEL,
    UNKNOWN_TAIL_TOKEN,
    any_missing,
    col_of,
    is_missing,
)
from ..functions.casting import EDGE_BLANKS, INT_TEXT
from ..functions.sqltext import ident, to_int_sql
from ..functions.text import strip_non_ascii as strip_expr

_INT_MIN = -(2**31)
_INT_SPAN = 2**32


def fill_missing(
    df: DataFrame,
    fallbacks: Mapping[str, str | Column] | None = None,
    constants: Mapping[str, object] | None = None,
    tokens: Sequence[str] = MISSING_TOKENS,
) -> DataFrame:
    """Replace missing values in one pass.

    ``fallbacks`` maps a column to another column (name or expression)
    whose value is taken when the first is missing; ``constants`` maps a
    column to a literal.  All replacements read the input row.
    """
    exprs: dict[str, Column] = {}
    for name, source in (fallbacks or {}).items():
        exprs[name] = F.when(is_missing(name, tokens), col_of(source)).otherwise(F.col(name))
    for name, value in (constants or {}).items():
        exprs[name] = F.when(is_missing(name, tokens), F.lit(value)).otherwise(F.col(name))
    return df.withColumns(exprs) if exprs else df


def fill_from(
    df: DataFrame, fallbacks: Mapping[str, str | Column], tokens: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """Fill each missing column from its fallback column."""
    return fill_missing(df, fallbacks=fallbacks, tokens=tokens)


def fill_const(
    df: DataFrame, constants: Mapping[str, object], tokens: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """Fill each missing column with a constant."""
    return fill_missing(df, constants=constants, tokens=tokens)


def fill_expr(
    df: DataFrame, col: str, expr: Column, tokens: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """Fill a missing ``col`` with an arbitrary expression of the row."""
    return df.withColumn(col, F.when(is_missing(col, tokens), expr).otherwise(F.col(col)))


def int_difference(first: str | Column, *rest: str | Column) -> Column:
    """``first - rest[0] - rest[1] ...`` over lenient integers, as an int.

    Operands that are not numbers make the result NULL.  Overflow wraps
    around like 32-bit arithmetic did before ANSI mode instead of raising:
    the difference is taken in 64 bits and folded back into int range.
    """
    names = (first, *rest)
    if all(isinstance(c, str) for c in names):
        parts = [f"CAST({to_int_sql(ident(c), EDGE_BLANKS, INT_TEXT)} AS BIGINT)" for c in names]
        total = " - ".join(parts)
        return F.expr(f"CAST(pmod(({total}) - ({_INT_MIN}), {_INT_SPAN}) + ({_INT_MIN}) AS INT)")
    total = to_int(first).cast("long")
    for c in rest:
        total = total - to_int(c).cast("long")
    wrapped = F.pmod(total - F.lit(_INT_MIN), F.lit(_INT_SPAN)) + F.lit(_INT_MIN)
    return wrapped.cast("int")


def relabel_missing(
    df: DataFrame,
    col: str,
    label: str = UNKNOWN_TAIL_LABEL,
    extra_tokens: Sequence[str] = (UNKNOWN_TAIL_TOKEN,),
    tokens: Sequence[str] = MISSING_TOKENS,
) -> DataFrame:
    """Replace missing values (and ``extra_tokens``) of ``col`` by ``label``."""
    cond = is_missing(col, tuple(tokens) + tuple(extra_tokens))
    return df.withColumn(col, F.when(cond, F.lit(label)).otherwise(F.col(col)))


def strip_non_ascii(df: DataFrame, col: str) -> DataFrame:
    """Remove characters outside printable ASCII from ``col``."""
    return df.withColumn(col, strip_expr(col))


def flag_missing(
    df: DataFrame, name: str, cols: Iterable[str], tokens: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """Add int column ``name``: 1 if any of ``cols`` is missing, else 0."""
    return df.withColumn(name, F.when(any_missing(cols, tokens), F.lit(1)).otherwise(F.lit(0)))


def cast_columns(df: DataFrame, cols: Iterable[str], to: str = "int") -> DataFrame:
    """Cast many columns in one projection; text that is not a value gives NULL.

    ``int`` keeps the lenient meaning ("95.5" -> 95, "NA" -> NULL); other
    targets use ``try_cast``.
    """
    cols = list(cols)
    if to == "int":
        exprs = {c: to_int(c) for c in cols}
    else:
        exprs = {c: F.col(c).try_cast(to) for c in cols}
    return df.withColumns(exprs)


def parse_dates(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Parse text columns to dates, one pattern per column; bad text gives NULL."""
    return df.withColumns({c: parse_date(c, p) for c, p in patterns.items()})


def assemble_date(
    df: DataFrame,
    name: str,
    year: str,
    month: str,
    day: str,
    skip_null_parts: bool = False,
) -> DataFrame:
    """Add date column ``name`` built from year, month and day columns."""
    return df.withColumn(name, date_from_parts(year, month, day, skip_null_parts))
