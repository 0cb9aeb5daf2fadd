"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Words are maximal runs of characters other than these six ASCII spaces.
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"
#: Bits of a bitmap of ids, in all and per page.
FILTER_BITS, PAGE_BITS = 1 << 26, 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends
    there, so a lost executor costs a re-read and not a recomputation."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Freed memory goes back to the machine, which the C library and Arrow put off."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def giving_back(of: Callable[[Iterable], Iterator[pd.DataFrame]]) -> Callable[[Iterable], Iterator[pd.DataFrame]]:
    """``of`` for a worker that serves many stages: what earlier ones let go of, such
    as a broadcast, goes back before ``of`` begins, and its own when it ends."""

    @wraps(of)
    def run(batches: Iterable) -> Iterator[pd.DataFrame]:
        give_back()
        try:
            yield from of(batches)
        finally:
            give_back()

    return run


def likely(rows: DataFrame, ids: DataFrame, id: str, name: str) -> DataFrame:
    """``rows`` with boolean ``name``: true if ``id`` is in ``ids``, and for a few
    others.  A bitmap of hashed ids is broadcast, at ``FILTER_BITS`` bits at most
    whatever the number of ids; the rows are not shuffled."""
    bit = F.pmod(F.xxhash64(quoted(id)), F.lit(FILTER_BITS))
    page, at = F.floor(bit / PAGE_BITS).alias("__page"), (bit % PAGE_BITS).alias("__at")
    pages = ids.select(page, at).groupBy("__page").agg(F.bitmap_construct_agg("__at").alias("__bits"))
    held = F.expr("getbit(cast(conv(hex(substring(__bits, cast(__at div 8 as int) + 1, 1)), 16, 10) as int), cast(__at % 8 as int)) = 1")
    found = rows.select("*", page, at).join(F.broadcast(pages), "__page", "left")
    return found.select(*[F.col(quoted(c)) for c in rows.columns], F.coalesce(held, F.lit(False)).alias(name))


def matched(rows: DataFrame, few: DataFrame, id: str) -> DataFrame:
    """``rows`` left joined with ``few`` by ``id``; rows that a bitmap of ``few``'s
    ids keeps out are not shuffled.  ``few`` is read twice: give it stored."""
    seen = likely(rows, few.select(id), id, "__may")
    more = [c for c in few.columns if c != id]
    sure = seen.where("not __may").select(*rows.columns, *[F.lit(None).cast(few.schema[c].dataType).alias(c) for c in more])
    return sure.union(seen.where("__may").join(few, id, "left").select(*rows.columns, *more))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(col: str | Column) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
