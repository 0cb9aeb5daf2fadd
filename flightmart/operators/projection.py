"""Column-set operators: drop, rename, select.  All are metadata-only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop ``cols``; names that are absent are ignored.

    Dropped columns never reach the scan (Catalyst prunes them).
    """
    return df.drop(*list(cols))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns, case-only renames included; absent names are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def select_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep only ``cols`` in the given order."""
    return df.select(*list(cols))
