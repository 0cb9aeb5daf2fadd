"""Sinks: staging and publishing."""

from .files import DEAL, even_partitions, publish, publish_zordered, stage_and_verify, write_stage
from .snapshots import (
    ConflictError,
    expire_snapshots,
    publish_increment,
    publish_snapshot,
    read_snapshot,
    snapshot_record,
    snapshot_versions,
)

__all__ = [
    "DEAL",
    "ConflictError",
    "even_partitions",
    "expire_snapshots",
    "publish",
    "publish_increment",
    "publish_snapshot",
    "publish_zordered",
    "read_snapshot",
    "snapshot_record",
    "snapshot_versions",
    "stage_and_verify",
    "write_stage",
]
