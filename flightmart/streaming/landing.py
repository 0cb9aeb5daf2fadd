"""Incremental landing with Structured Streaming.

The batch landing re-reads every yearly file on each run.  As a stream,
the file source remembers (in its checkpoint) which files it has already
staged, so a run picks up only newly arrived files, and the Parquet file
sink commits each micro-batch exactly once: a run killed half-way, or an
executor lost mid-batch, resumes from the checkpoint without duplicating
or dropping rows.  ``availableNow`` processes everything present, in
bounded micro-batches, and then stops, so the job is still scheduled like
a batch job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.projection import drop_columns
from ..plans.jobs import DROPPED_COLUMNS
from ..sources.files import string_schema


def landing_stream(
    spark: SparkSession,
    source: str,
    columns: Sequence[str],
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Streaming frame over header CSV files (plain or bz2) under ``source``.

    A stream cannot infer its schema per batch, so the column names are
    given; every column is read as text, like the batch reader.
    """
    reader = spark.readStream.option("header", True).option("enforceSchema", False).schema(string_schema(columns))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return drop_columns(reader.csv(source), DROPPED_COLUMNS)


def land_incrementally(
    spark: SparkSession,
    source: str,
    columns: Sequence[str],
    stage_path: str,
    checkpoint: str | None = None,
    max_files_per_batch: int | None = None,
) -> None:
    """Append every not-yet-staged source file to the Parquet stage, then stop.

    ``checkpoint`` must live in shared storage and stay with ``stage_path``
    for the life of the stage; by default it is the folder of the stage's
    name with ``_checkpoint`` beside it, so that every later run finds it.
    A file whose header differs from ``columns`` fails the run.
    """
    checkpoint = checkpoint or f"{stage_path.rstrip('/')}_checkpoint"
    query = (
        landing_stream(spark, source, columns, max_files_per_batch)
        .writeStream.format("parquet")
        .option("path", stage_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
