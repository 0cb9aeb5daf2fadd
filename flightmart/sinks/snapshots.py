"""Atomic publishing: versions of a table behind one small record.

A version's rows are written to folders of their own, never over those of
another version; then one record (``_versions/<number>.json``) that names
the live folders appears by a rename.  Readers take the record of the highest
number, so they see the version before or the version after a publish and
never a part of either.  A job killed at any point leaves the last record, and
so the last version, as it was; what it had written is unreachable.

A record lists folders and partitions, so a version may share them with the
one before: ``publish_increment`` writes only the partitions that new rows
fall into.  Its ledger holds the last batch of each stream, by which a batch
that comes again is left out.  The record grows with the number of partitions,
not of rows.

Two writers that start from one version race for the next number; the rename
does not replace a record, so the later one raises ``ConflictError`` and can
publish again.  This takes a file system whose rename is atomic and keeps an
existing target (HDFS, local, ABFS); on others let one job write a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StringType, StructType

from ..operators.digest import digest_columns, digest_of, observed
from .files import publish

FOLDER = "__snapshot"


class ConflictError(RuntimeError):
    """Another job has published the next version first."""


class _Store:
    """The few file system calls that records need, on the session's file systems."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]).rstrip("/"))

    def found(self, pattern: str) -> list[str]:
        """Paths below the root that match a pattern, relative to it."""
        base = self.fs.makeQualified(self.path("")).toString()
        hits = self.fs.globStatus(self.path(pattern)) or []
        return sorted(h.getPath().toString().removeprefix(base).lstrip("/") for h in hits)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Whether ``name`` was absent and now holds ``text``: written aside, then renamed."""
        aside = self.path("_versions", f".{uuid.uuid4().hex}")
        stream = self.fs.create(aside, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        hadoop = self.jvm.org.apache.hadoop.fs
        try:
            files = hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf)
            files.rename(aside, self.path(name), self.gateway.new_array(hadoop.Options.Rename, 0))
        except Py4JJavaError as exc:
            if "FileAlreadyExistsException" not in str(exc.java_exception.toString()):
                raise
            self.fs.delete(aside, False)
            return False
        return True


def _name(version: int) -> str:
    return f"_versions/{version:012d}.json"


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, rising; none if nothing was published."""
    return [int(n.rsplit("/", 1)[1].removesuffix(".json")) for n in _Store(spark, root).found("_versions/*.json")]


def snapshot_record(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """A version's record (the last one's by default): number, schema, live
    partitions per folder, rows and digest of what it wrote, ledger."""
    versions = snapshot_versions(spark, root)
    if version is None and not versions:
        return None
    if version is not None and version not in versions:
        raise ValueError(f"no version {version} at {root}")
    return json.loads(_Store(spark, root).read(_name(versions[-1] if version is None else version)))


def _read(spark: SparkSession, root: str, schema: StructType, live: dict[str, list[str]]) -> DataFrame:
    """The rows of the live partitions; a folder without a list is live as a whole."""
    data = f"{root.rstrip('/')}/data"
    paths = [f"{data}/{folder}/{part}".rstrip("/") for folder, parts in live.items() for part in parts]
    if not paths:
        return spark.createDataFrame([], schema)
    # The folder's name is a partition column, so that folders of several versions are read in one scan.
    wide = StructType([*schema.fields]).add(FOLDER, StringType())
    return spark.read.schema(wide).option("basePath", data).parquet(*paths).select(*[f"`{n}`" for n in schema.names])


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of ``version``, by default the last one.  The frame stays
    on that version whatever is published while it is used."""
    record = snapshot_record(spark, root, version)
    if record is None:
        raise FileNotFoundError(f"nothing published at {root}")
    return _read(spark, root, StructType.fromJson(record["schema"]), record["live"])


def _write(df: DataFrame, root: str, partition_by: Sequence[str], cluster_by: Sequence[str], rebalance: bool, verify: bool) -> tuple[str, list[str], dict]:
    """Rows to a new folder: its name, its partitions, what was written."""
    spark, folder = df.sparkSession, f"{FOLDER}={uuid.uuid4().hex}"
    target = f"{root.rstrip('/')}/data/{folder}"
    seen = Observation("snapshot")
    publish(df.observe(seen, *digest_columns(df)), target, partition_by, cluster_by, rebalance=rebalance)
    wrote = {k: str(v) for k, v in observed(seen, df).items()}
    parts = [""]
    if partition_by:
        parts = [p.split(f"{folder}/", 1)[1] for p in _Store(spark, root).found(f"data/{folder}/" + "/".join(["*=*"] * len(partition_by)))]
    if verify:
        stored = {k: str(v) for k, v in digest_of(_read(spark, root, df.schema, {folder: parts})).items()}
        if stored != wrote:
            raise RuntimeError(f"read back {stored} at {target}, but {wrote} was written")
    return folder, parts, wrote


def _commit(spark: SparkSession, root: str, parent: dict | None, record: dict) -> int:
    version = (parent["version"] if parent else 0) + 1
    text = json.dumps(record | {"version": version, "parent": parent and parent["version"]}, sort_keys=True)
    if not _Store(spark, root).create(_name(version), text):
        raise ConflictError(f"version {version} at {root} was published by another job")
    return version


def publish_snapshot(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    rebalance: bool = True,
    verify: bool = False,
) -> int:
    """Publish ``df`` as the whole next version of the table at ``root``; its number.

    Files are laid out as by ``publish``.  With ``verify`` the written rows
    are read back and their digest compared before the version appears.
    """
    spark = df.sparkSession
    parent = snapshot_record(spark, root)
    folder, parts, wrote = _write(df, root, partition_by, cluster_by, rebalance, verify)
    return _commit(spark, root, parent, {
        "schema": df.schema.jsonValue(), "partition_by": list(partition_by), "live": {folder: parts}, "wrote": wrote,
        "ledger": (parent or {}).get("ledger", {}),
    })


def _without(live: dict[str, list[str]], parts: Iterable[str]) -> dict[str, list[str]]:
    gone = set(parts)
    kept = {folder: [p for p in own if p not in gone] for folder, own in live.items()}
    return {folder: own for folder, own in kept.items() if own}


def publish_increment(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    stream: str | None = None,
    batch: int | None = None,
    replace: bool = False,
    verify: bool = False,
) -> int | None:
    """Add ``df``'s rows to the partitions they fall into, as the next version.

    Partitions that the table does not have yet are written once; those it
    has are written anew with old and new rows together, so that they keep
    few, clustered files (``replace=True``: with the new rows alone).  No
    other partition is read or written.  ``stream`` and ``batch`` name a batch
    whose numbers rise: one that the ledger has seen changes nothing and
    returns None, so a batch can be given again after a failure.
    """
    spark, partition_by = df.sparkSession, list(partition_by)
    if not partition_by:
        raise ValueError("an increment needs partition columns")
    parent = snapshot_record(spark, root)
    ledger = dict((parent or {}).get("ledger", {}))
    if stream is not None:
        if batch is None:
            raise ValueError("a stream's batch needs a number")
        if batch <= ledger.get(stream, -1):
            return None
        ledger[stream] = batch
    live = parent["live"] if parent else {}
    if parent and (parent["partition_by"] != partition_by or StructType.fromJson(parent["schema"]).names != df.columns):
        raise ValueError("the increment's columns or partition columns are not the table's")
    folder, parts, wrote = _write(df, root, partition_by, cluster_by, True, verify)
    had = {p for own in live.values() for p in own}
    both = [p for p in parts if p in had]
    after = _without(live, parts) | {folder: parts}
    if both and not replace:
        of = set(both)
        old = {f: [p for p in own if p in of] for f, own in (live | {folder: parts}).items()}
        rows = _read(spark, root, df.schema, {f: own for f, own in old.items() if own})
        merged, rebuilt, _ = _write(rows, root, partition_by, cluster_by, True, verify)
        after = _without(live | {folder: parts}, both) | {merged: rebuilt}
    return _commit(spark, root, parent, {
        "schema": df.schema.jsonValue(), "partition_by": partition_by, "live": {f: own for f, own in after.items() if own}, "wrote": wrote,
        "ledger": ledger,
    })


def expire_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget all but the last ``keep`` versions; the data folders removed.

    Only folders that forgotten records name and no kept record does are
    removed, so a write under way is never touched; frames that still read a
    forgotten version fail.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    store, versions = _Store(spark, root), snapshot_versions(spark, root)
    records = {v: json.loads(store.read(_name(v))) for v in versions}
    folders = lambda chosen: reduce(set.union, (set(records[v]["live"]) for v in chosen), set())
    old, kept = versions[:-keep], versions[-keep:]
    gone = sorted(folders(old) - folders(kept))
    for v in old:
        store.fs.delete(store.path(_name(v)), False)
    for folder in gone:
        store.fs.delete(store.path("data", folder), True)
    return gone
