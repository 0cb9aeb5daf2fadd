"""Incremental publishing: new files to the dates they touch.

Each micro-batch of newly arrived files is cleaned and merged into the
published table as one new version: dates that the batch does not touch are
neither read nor written.  The version's ledger holds the batch, so one that
runs again (the job died after publishing, before the checkpoint said so)
changes nothing, and readers see whole batches only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..plans.jobs import CLUSTER_COLUMNS, PARTITION_COLUMNS, clean_flights
from ..sinks.snapshots import publish_increment
from .landing import landing_stream


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a stream keeps as long as its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def publish_incrementally(
    spark: SparkSession,
    source: str,
    columns: Sequence[str],
    root: str,
    checkpoint: str | None = None,
    max_files_per_batch: int | None = None,
    transform: Callable[[DataFrame], DataFrame] = clean_flights,
    partition_by: Sequence[str] = tuple(PARTITION_COLUMNS),
    cluster_by: Sequence[str] = tuple(CLUSTER_COLUMNS),
) -> int:
    """Publish every file under ``source`` that is not in the table yet, then
    stop; the number of versions published.

    ``checkpoint`` says which files the table has, and must stay with it (by
    default it is ``root``'s ``_checkpoint``): with another one, all files
    would count as new.
    """
    checkpoint = checkpoint or f"{root.rstrip('/')}/_checkpoint"
    published = []

    def merge(batch: DataFrame, number: int) -> None:
        of = stream_id(spark, checkpoint)
        version = publish_increment(transform(batch), root, partition_by, cluster_by, stream=of, batch=number)
        if version is not None:
            published.append(version)

    query = (
        landing_stream(spark, source, columns, max_files_per_batch)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(published)
