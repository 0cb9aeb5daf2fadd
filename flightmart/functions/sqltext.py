"""Spark SQL text for expressions over named columns.

Building a large expression with the Column API costs one or more JVM
round trips per node (and per ``isin`` literal); the same expression
written as SQL text is parsed in one call by ``F.expr`` into the identical
Catalyst tree.  The operators use these builders when they are given
column names, which keeps driver-side planning of wide jobs fast.
"""

from __future__ import annotations

from collections.abc import Sequence


def ident(name: str) -> str:
    """A column name as a quoted identifier (taken literally, dots included)."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string literal with Spark's default (backslash) escaping."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_missing_sql(q: str, tokens: Sequence[str]) -> str:
    if not tokens:
        return f"({q} IS NULL)"
    toks = ", ".join(literal(t) for t in tokens)
    return f"({q} IS NULL OR CAST({q} AS STRING) IN ({toks}))"


def to_int_sql(q: str, edge_blanks: str, int_text: str) -> str:
    s = f"CAST({q} AS STRING)"
    text = f"regexp_replace({s}, {literal(edge_blanks)}, '')"
    whole = f"regexp_replace({text}, '[.].*$', '')"
    starts_like_int = f"(ascii({s}) BETWEEN 48 AND 57 OR ascii({s}) IN (43, 45))"
    return (
        f"coalesce(CASE WHEN {starts_like_int} THEN try_cast({s} AS INT) END, "
        f"CASE WHEN {text} RLIKE {literal(int_text)} THEN "
        f"CASE WHEN {whole} IN ('', '+', '-') THEN 0 ELSE try_cast({whole} AS INT) END END)"
    )


def any_missing_sql(names: Sequence[str], tokens: Sequence[str]) -> str:
    return "(" + " OR ".join(is_missing_sql(ident(n), tokens) for n in names) + ")"
