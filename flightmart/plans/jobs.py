"""The jobs: operators composed into one plan per published table.

``clean_*`` functions are pure ``DataFrame -> DataFrame`` transforms (one
narrow stage each: filters and projections, no shuffle).  ``*_job``
functions add the reads and writes around them.

Order matters in ``clean_flights`` and is kept as in the original jobs:
rows without taxi times or scheduled elapsed time are dropped first; the
tail-number label is set before non-ASCII characters are stripped; the
``MissingData`` flag records the gaps *before* they are filled; actual
elapsed time is filled before air time is derived from it; all fills act
on text and the integer casts come after them; the date is built from the
cast integers.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import MISSING_TOKENS
from ..functions.names import canonical_names
from ..functions.sqltext import any_missing_sql, ident
from ..operators.clean import (
    assemble_date,
    cast_columns,
    fill_expr,
    fill_missing,
    flag_missing,
    int_difference,
    parse_dates,
    relabel_missing,
    strip_non_ascii,
)
from ..operators.filters import require_not_null, require_present
from ..operators.override import override_by_key
from ..operators.profile import staged_audit
from ..operators.projection import drop_columns, rename
from ..session import compile_wide_stages
from ..sinks.files import publish, stage_and_verify
from ..sinks.snapshots import publish_increment, publish_snapshot
from ..sources.files import (
    csv_header,
    path_exists,
    read_csv_inferred,
    read_csv_strings,
    read_stage,
    resolve_sources,
    source_state,
    year_paths,
)
from ..sources.headers import read_csv_by_name

# ---------------------------------------------------------------------------
# Fixed values that must equal the original jobs' for identical results.
# ---------------------------------------------------------------------------
FIRST_YEAR, LAST_YEAR = 2000, 2008
YEAR_FILE_PATTERN = "{year}_data.csv"
DROPPED_COLUMNS = [
    "CancellationCode", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]
REQUIRED_TAXI = ["TaxiIn", "TaxiOut"]
REQUIRED_SCHEDULE = ["CRSElapsedTime"]
TAIL_COLUMN = "TailNum"
FLAG_NAME = "MissingData"
FLAG_COLUMNS = ["DepTime", "ArrTime", "ActualElapsedTime", "AirTime", "ArrDelay", "DepDelay"]
FILL_FROM = {
    "DepTime": "CRSDepTime",
    "ArrTime": "CRSArrTime",
    "ActualElapsedTime": "CRSElapsedTime",
}
FILL_ZERO = {"DepDelay": "0", "ArrDelay": "0"}
INT_COLUMNS = [
    "Year", "Month", "DayofMonth", "DayOfWeek",
    "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
    "FlightNum", "ActualElapsedTime", "CRSElapsedTime",
    "AirTime", "ArrDelay", "DepDelay", "Distance",
    "TaxiIn", "TaxiOut", "Cancelled", "Diverted",
]
DATE_NAME = "FlightDate"
PARTITION_COLUMNS = ["FlightDate"]
CLUSTER_COLUMNS = ["Origin", "Dest", "UniqueCarrier"]
AIRPORT_RENAMES = {"iata": "IATA", "lat": "latitude", "long": "longitude"}
AIRPORT_CITY_STATE = {
    "CLD": ("San Diego", "CA"),
    "HHH": ("Hilton Head Island", "SC"),
    "MIB": ("Minot", "ND"),
    "MQT": ("Marquette", "MI"),
    "RCA": ("Rapid City", "SD"),
    "RDR": ("Grand Forks", "ND"),
    "ROP": ("Mueang Prachinburi", "PC"),
    "ROR": ("Airai", "PW350"),
    "SCE": ("State College", "PA"),
    "SKA": ("Spokane", "WA"),
    "SPN": ("San Jose", "TI"),
    "YAP": ("Colonia", "FMYAP"),
}
PLANE_TYPE_COLUMN = "type"
PLANE_DATE_PATTERNS = {"issue_date": "MM/dd/yyyy"}
PLANE_INT_COLUMNS = ["year"]
VARIABLE_KEY = "Variable descriptions"
VARIABLE_RENAMES = {"_c1": "Name", "_c2": "Description"}
# ---------------------------------------------------------------------------
#: The flight columns that a step looks up; headers may spell them in any case.
FLIGHT_NAMES = list(dict.fromkeys(
    [*INT_COLUMNS, *CLUSTER_COLUMNS, TAIL_COLUMN, *DROPPED_COLUMNS]
))


def air_time_fill():
    """Air time derived as actual elapsed time minus taxi-in and taxi-out, as text."""
    return int_difference("ActualElapsedTime", "TaxiIn", "TaxiOut").cast("string")


def clean_flights(
    df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS, skip_null_date_parts: bool = False
) -> DataFrame:
    """Raw (all-string) flight rows -> the 25-column typed fact."""
    compile_wide_stages(df.sparkSession)
    df = canonical_names(df, FLIGHT_NAMES)
    df = drop_columns(df, DROPPED_COLUMNS)
    df = require_present(df, REQUIRED_TAXI, tokens)
    df = require_present(df, REQUIRED_SCHEDULE, tokens)
    df = relabel_missing(df, TAIL_COLUMN, tokens=tokens)
    df = strip_non_ascii(df, TAIL_COLUMN)
    df = flag_missing(df, FLAG_NAME, FLAG_COLUMNS, tokens)
    df = fill_missing(df, fallbacks=FILL_FROM, constants=FILL_ZERO, tokens=tokens)
    df = fill_expr(df, "AirTime", air_time_fill(), tokens)
    df = cast_columns(df, INT_COLUMNS, "int")
    return assemble_date(df, DATE_NAME, "Year", "Month", "DayofMonth", skip_null_date_parts)


def flights_audit_trail(
    df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS, by: Sequence[str] = ()
) -> DataFrame:
    """The fact job's missing-value audits, all in one pass over the raw rows.

    Four audits: the raw (staged) rows, after the taxi-time filter, after
    the tail-number / flag / fill steps, and after the air-time fill --
    the points where the interactive job stopped to look.  Each is
    computed on the same input rows through keep predicates and the
    values each column has at that point, so one scan replaces four.
    Returns ``(stage, column, missing)`` rows; with ``by`` (columns that are
    not audited, such as the file a row came from) these for each of their
    values, to be kept and added up by ``merge_audits``.
    """
    compile_wide_stages(df.sparkSession)
    base = drop_columns(canonical_names(df, FLIGHT_NAMES), DROPPED_COLUMNS)
    cols = [c for c in base.columns if c not in by]
    raw = {c: f"__raw_{c}" for c in cols}
    work = base.select(*base.columns, *[F.col(c).alias(a) for c, a in raw.items()])
    work = relabel_missing(work, TAIL_COLUMN, tokens=tokens)
    work = strip_non_ascii(work, TAIL_COLUMN)
    work = flag_missing(work, FLAG_NAME, FLAG_COLUMNS, tokens)
    work = fill_missing(work, fallbacks=FILL_FROM, constants=FILL_ZERO, tokens=tokens)
    work = work.withColumn("__filled_AirTime", F.col("AirTime"))
    work = fill_expr(work, "AirTime", air_time_fill(), tokens)
    # columns the steps rewrite; every other column still holds its raw value
    changed = {TAIL_COLUMN, *FILL_FROM, *FILL_ZERO, "AirTime", FLAG_NAME}
    filled = {**raw, **{c: c for c in changed}, "AirTime": "__filled_AirTime"}
    aired = {**filled, "AirTime": "AirTime"}
    taxi_ok = f"NOT {any_missing_sql([raw[c] for c in REQUIRED_TAXI], tokens)}"
    kept = f"{taxi_ok} AND NOT {any_missing_sql([raw[c] for c in REQUIRED_SCHEDULE], tokens)}"
    later = cols + [FLAG_NAME]
    return staged_audit(
        work,
        [
            ("raw", None, cols, raw),
            ("after_taxi_filter", taxi_ok, cols, raw),
            ("after_fills", kept, later, filled),
            ("after_air_time", kept, later, aired),
        ],
        tokens,
        by,
    )


def refresh_audits(spark: SparkSession, raw: DataFrame, root: str, file_column: str) -> int:
    """Bring the audit table at ``root`` up to date with the files that ``raw``
    holds rows of; the version published.

    The table has the audit trail of every file, a partition each.  A file
    that landed again replaces its own state and no other is read, so the
    audit of everything that ever landed (``merge_audits`` over the table)
    costs a scan of the new files alone.
    """
    return publish_increment(flights_audit_trail(raw, by=[file_column]), root, [file_column], replace=True)


def planes_audit_trail(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Planes audit before and after the type filter, in one pass."""
    cols = list(df.columns)
    return staged_audit(
        df,
        [("raw", None, cols, None), ("after_type_filter", f"{ident(PLANE_TYPE_COLUMN)} IS NOT NULL", cols, None)],
        tokens,
    )


def clean_airports(df: DataFrame, overrides=AIRPORT_CITY_STATE) -> DataFrame:
    """Rename the airport columns and fix city/state for the listed codes."""
    df = rename(df, AIRPORT_RENAMES)
    return override_by_key(df, "IATA", overrides, ["city", "state"])


def clean_planes(df: DataFrame) -> DataFrame:
    """Drop planes without a type; parse the issue date; year to int."""
    df = require_not_null(df, PLANE_TYPE_COLUMN)
    df = parse_dates(df, PLANE_DATE_PATTERNS)
    return cast_columns(df, PLANE_INT_COLUMNS, "int")


def clean_variables(df: DataFrame) -> DataFrame:
    """Name the blank-header columns; drop rows without a variable number."""
    df = rename(df, VARIABLE_RENAMES)
    return require_not_null(df, VARIABLE_KEY)


def clean_carriers(df: DataFrame) -> DataFrame:
    """Carriers are published as read (``NA`` is a real carrier code)."""
    return df


def land(
    spark: SparkSession,
    paths: Sequence[str],
    stage_path: str,
    on_missing: str = "fail",
    partitions: int | None = None,
    columns: Sequence[str] | None = None,
    verify: str = "rows",
    by_name: bool = False,
) -> tuple[DataFrame, int]:
    """Landing: existing yearly CSVs (plain or bz2) -> verified Parquet stage.

    ``verify="content"`` compares a digest of all values with the stage as
    read back.  ``by_name`` binds ``columns`` (by default those of the first
    file) by name in every file, for headers that drift.
    """
    present = resolve_sources(spark, paths, on_missing)
    if by_name:
        raw = read_csv_by_name(spark, present, columns or csv_header(spark, present[0]))
    else:
        raw = read_csv_strings(spark, present, columns=columns)
    return stage_and_verify(drop_columns(raw, DROPPED_COLUMNS), stage_path, partitions, verify)


def _manifest_path(stage_path: str) -> str:
    return f"{stage_path.rstrip('/')}_manifest"


def write_manifest(spark: SparkSession, stage_path: str, manifest: dict) -> None:
    """What a stage was made of, as one line of JSON in a folder beside it."""
    line = spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(_manifest_path(stage_path))


def committed_stage(spark: SparkSession, stage_path: str, wanted: dict) -> tuple[DataFrame | None, int]:
    """The stage and its row count if its manifest says what ``wanted`` says and
    all its rows are there, else ``(None, 0)``."""
    if not path_exists(spark, f"{_manifest_path(stage_path)}/_SUCCESS"):
        return None, 0
    line = spark.read.text(_manifest_path(stage_path)).first()
    manifest = json.loads(line.value) if line else {}
    rows = manifest.pop("rows", None)
    if manifest != json.loads(json.dumps(wanted)) or not path_exists(spark, f"{stage_path.rstrip('/')}/_SUCCESS"):
        return None, 0
    staged = read_stage(spark, stage_path)
    return (staged, rows) if staged.count() == rows else (None, 0)


def flights_job(
    spark: SparkSession,
    source_root: str,
    stage_path: str,
    target: str,
    first: int = FIRST_YEAR,
    last: int = LAST_YEAR,
    pattern: str = YEAR_FILE_PATTERN,
    on_missing: str = "fail",
    as_table: bool = False,
    reuse_stage: bool = False,
    partitions: int | None = None,
    snapshots: bool = False,
    verify: str = "rows",
) -> int:
    """Yearly CSVs -> staged Parquet -> cleaned fact, published by date.

    With ``reuse_stage`` the stage is read instead of landing again, so a run
    that failed while publishing resumes from it rather than re-parsing every
    source file.  That holds only for a stage whose manifest names the same
    sources (paths, sizes, times of their files) and dropped columns and
    whose rows are all there; any other stage is landed anew.
    ``partitions`` evens the stage out to so many files at least, for a year
    that cannot be split.
    With ``snapshots`` the fact appears as the next version of the table at
    ``target``, and a run that fails leaves the one before; ``verify="content"``
    checks the stage, and such a version, by a digest of all values.
    """
    if snapshots and as_table:
        raise ValueError("snapshots are published to a path, not to a catalog table")
    paths = resolve_sources(spark, year_paths(source_root, first, last, pattern), on_missing)
    wanted = {"paths": paths, "files": source_state(spark, paths), "dropped": DROPPED_COLUMNS}
    staged, rows = None, 0
    if reuse_stage:
        staged, rows = committed_stage(spark, stage_path, wanted)
    if staged is None:
        # No manifest while the stage is being written: a stage that broke off has none.
        write_manifest(spark, stage_path, {})
        staged, rows = land(spark, paths, stage_path, partitions=partitions, verify=verify)
        write_manifest(spark, stage_path, wanted | {"rows": rows})
    if snapshots:
        publish_snapshot(clean_flights(staged), target, PARTITION_COLUMNS, CLUSTER_COLUMNS, verify=verify == "content")
        return rows
    publish(
        clean_flights(staged),
        target,
        partition_by=PARTITION_COLUMNS,
        cluster_by=CLUSTER_COLUMNS,
        as_table=as_table,
    )
    return rows


def lookup_job(
    spark: SparkSession,
    source: str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    schema=None,
    as_table: bool = False,
) -> None:
    """One lookup CSV -> transform -> published table (overwritten whole)."""
    publish(transform(read_csv_inferred(spark, source, schema)), target, as_table=as_table)
