"""Row filters built from the missing-value predicates.

Each filter is a single ``Filter`` node over plain column expressions, so
Catalyst merges consecutive filters, simplifies the negated OR chains and
pushes ``IsNotNull`` / ``NOT IN`` to the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from ..functions.missing import MISSING_TOKENS, any_missing, col_of, is_missing


def require_not_null(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose ``col`` is not NULL; text tokens are kept."""
    return df.filter(col_of(col).isNotNull())


def require_present(
    df: DataFrame, cols: Iterable[str], tokens: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """Drop every row where any of ``cols`` is missing (NULL or a token)."""
    return df.filter(~any_missing(cols, tokens))


def rows_missing(df: DataFrame, col: str, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Keep only rows where ``col`` is missing (for inspection)."""
    return df.filter(is_missing(col, tokens))


def rows_with_values(df: DataFrame, col: str, values: Iterable[object]) -> DataFrame:
    """Keep rows whose ``col`` equals one of ``values`` (an OR of equalities)."""
    return df.filter(col_of(col).isin(list(values)))
