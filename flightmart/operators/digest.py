"""Order-free digests of a frame's rows.

A digest is the number of rows and two sums over the rows of 64-bit hashes of
all their columns (hashed with NULLs marked and with different seeds), so it
does not depend on the order of rows, files or tasks, adds up over parts of
a table, and differs, but for a chance of about 2^-64 and less, where any
value does.  Sums are decimals: they neither overflow nor round.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import ident


def _hashable(field: T.StructField) -> Column:
    c = F.expr(ident(field.name))
    return F.to_json(F.struct(c)) if "map<" in field.dataType.simpleString() else c


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A 64-bit hash of all columns; a NULL differs from every value and shifts nothing."""
    values = [_hashable(f) for f in df.schema.fields]
    nulls = F.concat(F.lit("."), *[F.when(v.isNull(), F.lit("1")).otherwise(F.lit("0")) for v in values])
    return F.xxhash64(F.lit(seed), nulls, *values)


def digest_columns(df: DataFrame) -> list[Column]:
    """The aggregates ``rows``, ``digest_a`` and ``digest_b``, also for ``df.observe``."""
    sums = [F.coalesce(F.sum(row_hash(df, s).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")) for s in (0, 1)]
    return [F.count(F.lit(1)).alias("rows"), sums[0].alias("digest_a"), sums[1].alias("digest_b")]


def content_digest(df: DataFrame) -> DataFrame:
    """One row ``(rows, digest_a, digest_b)``: equal for frames of the same
    columns exactly if they hold the same rows the same number of times."""
    return df.agg(*digest_columns(df))


def digest_of(df: DataFrame) -> dict:
    return content_digest(df).first().asDict()


def observed(seen: Observation, df: DataFrame) -> dict:
    """What ``seen`` observed while a frame with the rows of ``df`` was written.
    A plan that is known to be empty drops its observation; its digest is
    then that of ``df``, which costs nothing."""
    try:
        return seen.get
    except Py4JJavaError:
        found = digest_of(df)
        if found["rows"]:
            raise
        return found
