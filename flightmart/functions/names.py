"""Column names without regard to case, whatever ``spark.sql.caseSensitive`` says."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def by_lower(columns: Iterable[str]) -> dict[str, str]:
    """Lower-case name -> name; two names that differ only in case are an error."""
    found: dict[str, str] = {}
    for c in columns:
        if c.lower() in found:
            raise ValueError(f"column names differ only in case: {found[c.lower()]!r}, {c!r}")
        found[c.lower()] = c
    return found


def resolve_names(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The frame's own spelling of each of ``names``; absent names raise."""
    own, names = by_lower(df.columns), list(names)
    absent = [n for n in names if n.lower() not in own]
    if absent:
        raise ValueError(f"columns not in frame: {absent}")
    return [own[n.lower()] for n in names]


def canonical_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` with those of its columns that match ``names`` spelled as there; others stay."""
    wanted = by_lower(names)
    by_lower(df.columns)
    spelled = [wanted.get(c.lower(), c) for c in df.columns]
    return df if spelled == df.columns else df.toDF(*spelled)
