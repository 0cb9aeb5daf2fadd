"""Keys at scale: mergeable distinct counts per file, and which keys repeat.

``key_sketches`` keeps, per file, counts and a theta sketch of a key.  Sketches
merge, so the distinct count of any set of files needs no second look at
their rows, and a file that lands again replaces its own sketch alone.

``duplicate_keys`` lists the keys that stand in more than one row, exactly.
Shuffling every distinct key for that is the cost; keys can be long texts, and
nearly all of them stand once.  So 64-bit hashes are counted first, and keys
move only where their hash was seen twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident


def _key(cols: Sequence[str]) -> list[Column]:
    return [F.expr(ident(c)) for c in cols]


def key_sketches(df: DataFrame, key: str, by: Sequence[str], lg_entries: int = 14) -> DataFrame:
    """Per value of ``by``: ``rows``, ``non_null`` and a theta ``sketch`` of the
    key's values; exact up to ``2**lg_entries`` distinct values, then within
    about ``2 / sqrt(2**lg_entries)`` of them."""
    k = F.expr(ident(key))
    return df.groupBy(*_key(by)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(k).alias("non_null"),
        F.theta_sketch_agg(k.cast("string"), lg_entries).alias("sketch"),
    )


def merged_key_profile(sketches: DataFrame, lg_entries: int = 14) -> DataFrame:
    """One row as of ``key_profile`` over the rows of all merged sketches."""
    merged = sketches.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("non_null"), F.lit(0)).alias("non_null"),
        F.theta_union_agg("sketch", lg_entries).alias("sketch"),
    )
    distinct = F.coalesce(F.theta_sketch_estimate("sketch"), F.lit(0)).cast("long")
    return merged.select("rows", "non_null", distinct.alias("distinct")).withColumn(
        "duplicates", F.col("non_null") - F.col("distinct")
    )


def duplicate_keys(df: DataFrame, key: str | Sequence[str], least: int = 2) -> DataFrame:
    """``(key..., rows)`` for every key without NULLs that stands in at least
    ``least`` rows.

    Phase one counts 64-bit hashes of the keys (combined in each task, so a
    hot key sends one number per task) and keeps those seen often enough;
    phase two takes the rows whose hash is among these and counts the keys
    themselves, so two keys of one hash are told apart.  The kept hashes are
    joined without a hint: the planner broadcasts them if they are few.
    """
    cols = [key] if isinstance(key, str) else list(key)
    rows = df.select(*_key(cols)).where(reduce(and_, (k.isNotNull() for k in _key(cols))))
    hashed = rows.withColumn("__hash", F.xxhash64(*_key(cols)))
    seen = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least).select("__hash")
    return (
        hashed.join(seen, "__hash", "left_semi")
        .groupBy(*_key(cols))
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") >= least)
    )
