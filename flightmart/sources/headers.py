"""CSV files whose headers drift: columns bound by name, file by file.

Yearly files come with columns in another order, renamed in case, added or
left out.  The headers of all files are read by one job (the first line of
each file, nothing more); files of one header are then read together with
that header, and every wanted column is taken by its name, so there are as
many scans as there are different headers, and the driver holds one header
per file.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.names import by_lower
from ..functions.sqltext import ident
from .files import string_schema

if TYPE_CHECKING:
    import pyarrow as pa

DRIFT = "file string, column string, drift string, wanted_at int, found_at int"
#: One split per file, whatever its size, and one file per task.
_WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(2**50), "spark.sql.files.openCostInBytes": str(2**50)}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def header_map(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """File -> names in its header line, for all non-empty files under ``paths``.

    A task opens one file and stops after its first lines.  Blank cells become
    ``_c<position>``, as the CSV reader names them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield batch.slice(0, 1)
                return

    with _settings(spark, _WHOLE_FILES):
        found = lines.mapInArrow(first, "value string, file string").collect()
    names = {unquote(r.file): next(csv.reader([r.value.removeprefix("\ufeff")])) for r in found}
    return {f: [n.strip() or f"_c{i}" for i, n in enumerate(own)] for f, own in sorted(names.items())}


def _bound(own: Sequence[str], columns: Sequence[str]) -> dict[str, str]:
    """Wanted column -> the header's own spelling, where the header has it."""
    spelled = by_lower(own)
    return {c: spelled[c.lower()] for c in columns if c.lower() in spelled}


def header_drift(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per file and column that is not where ``columns`` has it:
    ``moved``, ``respelled``, ``absent`` or ``extra``, with both positions from 0."""
    rows = []
    for file, own in header_map(spark, paths).items():
        bound = _bound(own, columns)
        for at, c in enumerate(columns):
            if c not in bound:
                rows.append((file, c, "absent", at, None))
            elif own[at : at + 1] != [bound[c]]:
                rows.append((file, c, "moved", at, own.index(bound[c])))
            elif bound[c] != c:
                rows.append((file, c, "respelled", at, at))
        rows += [(file, n, "extra", None, i) for i, n in enumerate(own) if n not in bound.values()]
    return spark.createDataFrame(rows, DRIFT)


def read_csv_by_name(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    on_absent: str = "null",
    on_extra: str = "drop",
    schema: StructType | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Header CSV files as one frame of ``columns``, each bound by name in
    every file (in any case).

    ``on_absent="null"`` gives a column that a file lacks as NULL of its type
    (``"fail"`` raises), ``on_extra="drop"`` leaves out columns not asked for
    (``"fail"`` raises).  Columns are strings, or of the types ``schema`` gives.
    ``file_column`` adds the path each row came from (encoded as in
    ``_metadata.file_path``).  Two names in one header
    that differ only in case raise.
    """
    if on_absent not in ("null", "fail") or on_extra not in ("drop", "fail"):
        raise ValueError("on_absent is 'null' or 'fail', on_extra 'drop' or 'fail'")
    wanted = schema if schema is not None else string_schema(columns)
    types = {f.name: f.dataType for f in wanted.fields}
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, own in header_map(spark, paths).items():
        bound = _bound(own, columns)
        absent, extra = [c for c in columns if c not in bound], [n for n in own if n not in bound.values()]
        if (absent and on_absent == "fail") or (extra and on_extra == "fail"):
            raise ValueError(f"{file}: columns absent {absent}, not asked for {extra}")
        by_header[tuple(own)].append(re.sub(r"([\\[\]{}*?])", r"\\\1", file))  # no pattern, a name
    parts = []
    for own, files in by_header.items():
        bound = {name: c for c, name in _bound(own, columns).items()}
        read = StructType([StructField(n, types[bound[n]] if n in bound else StringType()) for n in own])
        # The schema is the header of exactly these files, so binding it by position is by name.
        df = spark.read.option("header", True).schema(read).csv(files)
        take = {c: n for n, c in bound.items()}
        values = [F.expr(ident(take[c])).alias(c) if c in take else F.lit(None).cast(types[c]).alias(c) for c in columns]
        parts.append(df.select(*values, *([F.col("_metadata.file_path").alias(file_column)] if file_column else [])))
    if not parts:
        empty = StructType([wanted[c] for c in columns])
        return spark.createDataFrame([], empty.add(file_column, "string") if file_column else empty)
    return reduce(DataFrame.union, parts)
