"""File sources: yearly CSV sets, lookup CSVs, staged Parquet.

CSV (plain or ``.bz2``) is read by Spark's splittable text reader, so one
large file is cut into many tasks; nothing is decompressed or parsed on
the driver.  The only driver-side work is listing a short list of paths.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

log = logging.getLogger(__name__)


def year_paths(
    root: str, first: int = 2000, last: int = 2008, pattern: str = "{year}_data.csv"
) -> list[str]:
    """Paths of the yearly files ``first`` .. ``last`` inclusive."""
    root = root.rstrip("/")
    return [f"{root}/{pattern.format(year=y)}" for y in range(first, last + 1)]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (a file, folder or glob) matches anything.

    Uses the Hadoop file system of the session, so it works for every
    scheme the cluster can read (hdfs, s3a, gs, abfs, file).  Without a
    JVM gateway (Spark Connect) it asks the file-source listing instead,
    which fails analysis for a path that does not exist.
    """
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:
        return _listable(spark, path)
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    matches = hpath.getFileSystem(conf).globStatus(hpath)
    return matches is not None and len(matches) > 0


def _listable(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return False
        raise


def resolve_sources(
    spark: SparkSession, paths: Sequence[str], on_missing: str = "fail"
) -> list[str]:
    """Check that source paths exist.

    ``on_missing="fail"`` raises on the first absent path;
    ``"skip"`` drops absent paths with a warning (and raises if none is left).
    """
    if on_missing not in ("fail", "skip"):
        raise ValueError("on_missing must be 'fail' or 'skip'")
    present = []
    for p in paths:
        if path_exists(spark, p):
            present.append(p)
        elif on_missing == "fail":
            raise FileNotFoundError(p)
        else:
            log.warning("skipped absent source %s", p)
    if not present:
        raise FileNotFoundError(f"none of {len(paths)} source paths exists")
    return present


def source_state(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """File count, bytes and a hash of names, sizes and times of the files under
    ``paths``: it changes when a source does.  Contents are not read."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length", "modificationTime")
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    found = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(mark, F.lit(0))).first()
    return [str(v) for v in found]


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line of the first file under ``path``."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_csv_strings(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    strict_header: bool = True,
) -> DataFrame:
    """Read header CSV files as one frame with every column a string.

    The header of the first file (or ``columns``) fixes the names.  With
    ``strict_header`` every file's header must carry the same names in
    the same order, otherwise the read fails instead of silently binding
    columns by position.  ``.bz2`` / ``.gz`` files are decoded on the fly.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if columns is None:
        columns = csv_header(spark, paths[0])
    return (
        spark.read.option("header", True)
        .option("enforceSchema", not strict_header)
        .schema(string_schema(columns))
        .csv(paths)
    )


def read_csv_inferred(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None
) -> DataFrame:
    """Read a header CSV with inferred types, or with ``schema`` when given.

    Inference costs a full extra pass over the file; for large or recurring
    inputs pass the schema.  Blank header cells become ``_c<position>``.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Read a staged Parquet folder."""
    return spark.read.parquet(path)
