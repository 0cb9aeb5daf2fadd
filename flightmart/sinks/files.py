"""Sinks: staging Parquet and published tables, always overwritten whole.

Writes go through Spark's commit protocol, so a lost executor only means
its task is retried; a half-written attempt never becomes visible.  An
overwritten path's old rows go when its write stage starts, so a job that
fails in that stage leaves the path without rows: rerun it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.digest import digest_columns, digest_of, observed
from ..operators.layout import cut_points, with_zorder_key
from ..session import settings


#: About so many estimated bytes of a frame go to one partition when it is evened out.
EVEN_BYTES = 128 << 20
#: Rows are dealt out as they come, without a sort (and its spill) of every
#: partition first; over files, whose order is fixed, a retried task deals alike,
#: and over a shuffle Spark then runs the whole stage again.
DEAL = {"spark.sql.execution.sortBeforeRepartition": "false"}


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size, from its files' sizes; 0 if it has none."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def even_partitions(df: DataFrame, n: int) -> DataFrame:
    """Round-robin ``df`` into ``n`` equal partitions (a full shuffle), or more if
    these would hold more than ``EVEN_BYTES`` each, so that no task grows with the input.

    Only worth it when the input splits are badly uneven (e.g. one
    unsplittable compressed file); a splittable scan is already balanced.
    """
    return df.repartition(max(n, min(-(-estimated_bytes(df) // EVEN_BYTES), 10_000)))


def write_stage(df: DataFrame, path: str, n: int | None = None) -> None:
    """Overwrite a Parquet staging folder, optionally evened to ``n`` files or more."""
    out = df if n is None else even_partitions(df, n)
    with settings(df.sparkSession, DEAL):
        out.write.mode("overwrite").parquet(path)


def stage_and_verify(
    df: DataFrame, path: str, n: int | None = None, verify: str = "rows"
) -> tuple[DataFrame, int]:
    """Stage ``df`` as Parquet, re-read it and check nothing was lost.

    What is checked is observed while writing (no extra pass: the metrics
    ride along the write job, in its final stage, so retried tasks are
    counted once).  ``verify="rows"`` compares row counts, which Parquet
    answers from footers; ``verify="content"`` compares digests of all values
    too, for one scan of the stage, so a changed cell is found even if no row
    is missing.  Returns the re-read frame, whose lineage starts at the staged
    files, and the row count.
    """
    if verify not in ("rows", "content"):
        raise ValueError("verify must be 'rows' or 'content'")
    out = df if n is None else even_partitions(df, n)
    seen = Observation("stage_rows")
    checks = digest_columns(out) if verify == "content" else [F.count(F.lit(1)).alias("rows")]
    with settings(df.sparkSession, DEAL):
        out.observe(seen, *checks).write.mode("overwrite").parquet(path)
    written = observed(seen, df)
    staged = df.sparkSession.read.parquet(path)
    stored = digest_of(staged.select(*out.columns)) if verify == "content" else {"rows": staged.count()}
    if stored["rows"] != written["rows"]:
        raise RuntimeError(f"staged {stored['rows']} rows at {path}, but {written['rows']} were written")
    if verify == "content" and stored != written:
        raise RuntimeError(f"the rows staged at {path} are not those that were written: {stored} for {written}")
    return staged, stored["rows"]


def publish(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    fmt: str = "parquet",
    as_table: bool = False,
    rebalance: bool = True,
) -> None:
    """Overwrite a published table (a path, or a catalog table with ``as_table``).

    With ``partition_by`` the rows are first rebalanced on the partition
    columns: a hash shuffle whose partitions adaptive execution merges
    when small and splits when skewed, so every partition value lands in
    few files of sensible size, and a value holding a third of all rows is
    spread over many tasks.  ``cluster_by`` columns then order rows inside
    each file, so Parquet min/max statistics let readers skip row groups.
    """
    partition_by, cluster_by = list(partition_by), list(cluster_by)
    out = df
    if rebalance:
        out = out.hint("rebalance", *partition_by)
    if partition_by or cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    # Whole, whatever the session's partition overwrite mode.
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.save(target)


def publish_zordered(
    df: DataFrame,
    target: str,
    cluster_by: Sequence[str],
    files: int | None = None,
    bits: int = 6,
    sample_rows: int = 100_000,
) -> None:
    """Overwrite a published path, clustered by several columns across all files.

    Rows are dealt to files by ranges of their Z-order key over ``cluster_by``
    (one exchange), so that a filter on any one of these columns can skip most
    files; ``files`` fixes their number, else adaptive execution sizes them.
    Within a range, ties are split by a hash of the row, so one combination
    of values that holds a third of all rows still goes to many tasks.  ``df``
    is read more than once (sample, ranges, write): give it staged.
    """
    cluster_by = list(cluster_by)
    keyed = with_zorder_key(df, cut_points(df, cluster_by, bits, sample_rows), "__zorder", bits)
    spread = keyed.withColumn("__spread", F.xxhash64(*[F.expr(f"`{c}`") for c in df.columns]))
    by = ["__zorder", "__spread"]
    dealt = spread.repartitionByRange(files, *by) if files else spread.repartitionByRange(*by)
    dealt = dealt.sortWithinPartitions("__zorder", *cluster_by).drop(*by)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
