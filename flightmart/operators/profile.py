"""Profiling and inspection: audits, counts, peeks.

Every audit is a single aggregation pass.  Global audits compute one
partial row per task and merge them in one tiny final task, so their cost
is one scan whatever the data size; grouped ones use Spark's partial
(map-side) aggregation before the shuffle, which collapses a hot key to
one row per task before anything moves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import MISSING_TOKENS, all_of, col_of, is_missing, is_missing_num
from ..functions.sqltext import ident, is_missing_sql, literal


def missing_audit(
    df: DataFrame,
    cols: Iterable[str] | None = None,
    tokens: Sequence[str] = MISSING_TOKENS,
    tokens_by_col: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row: for each column, how many values are missing (bigint).

    ``tokens_by_col`` overrides the token set for single columns, e.g. to
    keep a legitimate ``NA`` code from being counted.
    """
    cols = list(df.columns if cols is None else cols)
    per_col = tokens_by_col or {}
    return df.select(
        [F.count_if(is_missing(c, per_col.get(c, tokens))).alias(c) for c in cols]
    )


def staged_audit(
    df: DataFrame,
    stages: Sequence[tuple[str, Column | str | None, Sequence[str], Mapping[str, str | Column] | None]],
    tokens: Sequence[str] = MISSING_TOKENS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Missing counts at several steps of a pipeline, in one pass.

    Instead of auditing, cleaning and auditing again (a scan each time),
    every stage is described on the *same* input rows:
    ``(name, keep, columns, values)`` where ``keep`` is the predicate (a
    Column or SQL text) of the rows still present at that stage (``None``:
    all rows), ``columns`` the columns the stage has, and ``values`` maps a
    column to the column (name or expression) holding its value at that
    stage (default: the column itself).

    Returns long rows ``(stage, column, missing)``; with ``by`` columns, such
    rows for each of their values (after these columns), which add up:
    ``merge_audits`` over them is the audit of all rows.

    Plan: the rows are grouped by the distinct keep predicates (a handful
    of groups, pre-aggregated in every task before a tiny shuffle), each
    distinct value is counted once per group, and the stage counts are sums
    over the groups a stage keeps.  Predicates and values shared by stages
    are evaluated once.
    """
    keeps: dict[str, str] = {}  # keep text -> group column alias
    keep_cols: list[Column] = []
    counts: dict[str, str] = {}  # value key -> count column alias
    count_cols: list[Column] = []
    cells: list[tuple[str, str, str | None, str]] = []  # (stage, column, keep alias, count alias)
    for name, keep, cols, values in stages:
        keep_alias = None
        if keep is not None:
            text = keep if isinstance(keep, str) else str(keep)
            if text not in keeps:
                keeps[text] = keep_alias = f"__keep{len(keeps)}"
                pred = F.expr(keep) if isinstance(keep, str) else keep
                keep_cols.append(F.coalesce(pred, F.lit(False)).alias(keep_alias))
            keep_alias = keeps[text]
        for c in cols:
            v = (values or {}).get(c, c)
            key = v if isinstance(v, str) else str(v)
            if key not in counts:
                counts[key] = alias = f"__miss{len(counts)}"
                if isinstance(v, str):
                    count_cols.append(F.expr(f"count_if({is_missing_sql(ident(v), tokens)}) AS {alias}"))
                else:
                    count_cols.append(F.count_if(is_missing(v, tokens)).alias(alias))
            cells.append((name, c, keep_alias, counts[key]))
    by = [ident(c) for c in by]
    groups = df.groupBy(*map(F.expr, by), *keep_cols).agg(*count_cols)
    sums = [
        f"coalesce(sum({m if k is None else f'CASE WHEN {k} THEN {m} END'}), 0L) AS __cell{i}"
        for i, (_, _, k, m) in enumerate(cells)
    ]
    rows = ", ".join(f"{literal(st)}, {literal(c)}, __cell{i}" for i, (st, c, _, _) in enumerate(cells))
    totals = groups.groupBy(*map(F.expr, by)).agg(*map(F.expr, sums)) if by else groups.selectExpr(*sums)
    return totals.selectExpr(*by, f"stack({len(cells)}, {rows}) AS (stage, `column`, missing)")


def merge_audits(states: DataFrame) -> DataFrame:
    """``(stage, column, missing)`` of all rows, from the rows of a
    ``staged_audit`` by file (or any part): sums, no look at the data."""
    return states.groupBy("stage", "column").agg(F.sum("missing").alias("missing"))


def nan_audit(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row: for each floating point column, the NaN-or-NULL count."""
    return df.select([F.count_if(is_missing_num(c)).alias(c) for c in cols])


def flag_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of ``col`` (columns ``col``, ``count``)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def step_counts(
    df: DataFrame, steps: Sequence[tuple[str, Column]], initial: str = "rows_in"
) -> DataFrame:
    """Row accounting across a chain of filters, in one pass.

    ``steps`` is ``[(name, predicate), ...]`` applied cumulatively; the
    result has one bigint column for the input and one per step with the
    number of rows still kept after it.
    """
    out = [F.count(F.lit(1)).alias(initial)]
    kept: list[Column] = []
    for name, cond in steps:
        kept.append(F.coalesce(cond, F.lit(False)))
        out.append(F.count_if(all_of(kept)).alias(name))
    return df.select(out)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Row count as a one-row DataFrame."""
    return df.select(F.count(F.lit(1)).alias(name))


def non_null_count(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Non-NULL count of ``col`` as a one-row DataFrame."""
    return df.select(F.count(col_of(col)).alias(name or f"count_{col}"))


def key_profile(df: DataFrame, col: str, approx_rsd: float | None = None) -> DataFrame:
    """Is ``col`` a key?  rows, non-NULL, distinct and duplicate counts.

    ``count_distinct`` is planned as a two-level aggregate: a partial
    de-duplication per task, a shuffle on the key, then a merge, so a hot
    key costs one row per task rather than one per occurrence.  On a key
    with billions of values that shuffle still moves every distinct value;
    ``approx_rsd`` (e.g. 0.01) switches to a HyperLogLog++ estimate whose
    fixed-size sketches are the only thing shuffled.
    """
    c = col_of(col)
    distinct = F.count_distinct(c) if approx_rsd is None else F.approx_count_distinct(c, approx_rsd)
    return df.select(
        F.count(F.lit(1)).alias("rows"),
        F.count(c).alias("non_null"),
        distinct.alias("distinct"),
    ).withColumn("duplicates", F.col("non_null") - F.col("distinct"))


def peek(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the choice is deterministic (top-n)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_profile(df: DataFrame) -> DataFrame:
    """(name, type, filled): per column its type and count of non-NULL values, in one pass."""
    counts = df.agg(*[F.count(F.expr(ident(f.name))).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    rows = [
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("filled"))
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_rows(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, nullable) per column, read from the plan metadata."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
