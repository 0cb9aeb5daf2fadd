"""Line de-duplication by site-relative frequency, in DataFrame operations.

Pages are grouped by host.  A line's ratio is the number of the host's pages
that contain it, divided by the number of the host's pages; lines above the
ratio are boilerplate of that site and go from its pages.

Only hashes of lines are counted, once per page and with partial sums before
the shuffle, so one host with most of the pages is spread like any other.
What is left are a host's boilerplate lines: at most (mean lines per page) /
ratio of them, whatever the host's size.  They join the pages by host; the
page side of that join can be split when one host is hot.

Edge cases: a null text stays null and counts as a page without lines; a null host names no
site, so its pages stay as they are; blank lines are never boilerplate; a
line that repeats in a page counts once and goes everywhere in the page; a
page of boilerplate alone becomes empty and stays; hosts with fewer than
``min_pages`` pages with a line keep it.  Columns other than the text are
left alone; the result columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import stored


def _hash(line: Column) -> Column:
    return F.xxhash64(line)


def boilerplate_lines(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, min_pages: int = 10) -> DataFrame:
    """(host, line_hash, n_pages, host_pages) of lines above the ratio."""
    at = F.col(f"`{host}`")
    own = pages.where(at.isNotNull()).select(at.alias("host"), F.col(f"`{text}`").alias("text"))
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), _hash))
    counts = (
        own.select("host", F.explode(lines).alias("line_hash"))
        .groupBy("host", "line_hash")
        .agg(F.count("*").alias("n_pages"))
        .where(F.col("n_pages") >= min_pages)
    )
    totals = own.groupBy("host").agg(F.count("*").alias("host_pages"))
    return counts.join(totals, "host").where(F.col("n_pages") > F.col("host_pages") * ratio)


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, min_pages: int = 10) -> DataFrame:
    """``pages`` with cleaned text and ``n_dropped_lines`` (long) added."""
    found = boilerplate_lines(pages, host, text, ratio, min_pages)
    # Written first: its size is then known, so a small one is broadcast, and beyond
    # that the join reads two plain shuffles, of which the hot host's pages can be split.
    lists = stored(found.groupBy(F.col("host").alias("__host")).agg(F.collect_list("line_hash").alias("__bad")), "site-lines")
    at, bad = F.col(f"`{text}`"), F.coalesce("__bad", F.array().cast("array<bigint>"))
    lines = F.split(at, "\n")
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(bad, _hash(x)))
    joined = pages.drop("n_dropped_lines").join(lists, F.col(f"`{host}`") == F.col("__host"), "left")
    cleaned = joined.withColumn("__kept", F.when(F.size(bad) > 0, kept))
    cut = F.col("__kept").isNotNull() & (F.size("__kept") < F.size(lines))
    return (
        cleaned.withColumn("n_dropped_lines", F.when(cut, (F.size(lines) - F.size("__kept")).cast("long")).otherwise(F.lit(0).cast("long")))
        .withColumn(text, F.when(cut, F.array_join("__kept", "\n")).otherwise(at))
        .drop("__host", "__bad", "__kept")
    )
