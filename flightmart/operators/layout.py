"""Z-order keys: rows that are near in several columns get near keys.

Sorting a table by one column after another only helps filters on the first;
sorted by the interleaved bits of the columns' quantile ranks, each file
covers a narrow range of every one of them, so the files' minima and maxima
let a reader skip most files whichever column it filters on.

Ranks come from cut points in a bounded sample (``sample_rows`` values are
drawn, as for any range partitioning); the sample shapes the layout only,
never which rows there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident


def cut_points(
    df: DataFrame, cols: Sequence[str], bits: int = 6, sample_rows: int = 100_000, seed: int = 7, rows: int | None = None
) -> dict[str, list[Any]]:
    """Per column at most ``2**bits - 1`` rising values that cut a sample of
    the frame's rows into parts of equal size; fewer if values repeat."""
    rows = df.count() if rows is None else rows
    values = df.select(*[F.expr(ident(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    if rows > sample_rows:
        values = values.sample(sample_rows / rows, seed)
    parts, drawn = 2**bits, values.collect()
    cuts = {}
    for i, c in enumerate(cols):
        own = sorted(r[i] for r in drawn if r[i] is not None)
        cuts[c] = sorted({own[len(own) * k // parts] for k in range(1, parts)} - {own[0]}) if own else []
    return cuts


def quantile_rank(c: Column, cuts: Sequence[Any], least: int = 0) -> Column:
    """How many of the rising ``cuts`` are at or below ``c`` (NULL: none), by
    a tree of comparisons: as many per row as the ranks have bits."""
    if not cuts:
        return F.lit(least)
    mid = len(cuts) // 2
    above = quantile_rank(c, cuts[mid + 1 :], least + mid + 1)
    return F.when(c >= F.lit(cuts[mid]), above).otherwise(quantile_rank(c, cuts[:mid], least))


def with_zorder_key(df: DataFrame, cuts: Mapping[str, Sequence[Any]], name: str = "__zorder", bits: int = 6) -> DataFrame:
    """Add the interleaved ranks of the columns of ``cuts`` as one bigint.

    The ranks of a column with few values are spread over all its bits, so
    that its first bits, which weigh most, cut it into even parts too.
    """
    if len(cuts) * bits > 62:
        raise ValueError(f"{len(cuts)} columns of {bits} bits do not fit one key")
    spread = lambda own: F.lit(2**bits).cast("long") / F.lit(len(own) + 1)
    ranks = {f"{name}_{i}": F.floor(quantile_rank(F.expr(ident(c)), list(own)) * spread(own)).cast("int") for i, (c, own) in enumerate(cuts.items())}
    k = len(ranks)
    key = F.lit(0).cast("long")
    for i, rank in enumerate(ranks):
        for b in range(bits):
            bit = F.shiftright(F.col(rank), b).bitwiseAND(F.lit(1)).cast("long")
            key = key + F.shiftleft(bit, b * k + k - 1 - i)
    return df.withColumns(ranks).withColumn(name, key).drop(*ranks)


def file_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per file of a file-based frame its rows and, per column, the least and
    largest value: what a reader can skip files by."""
    ends = [f(F.expr(ident(c))).alias(f"{c}_{n}") for c in cols for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)
