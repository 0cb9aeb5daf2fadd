"""

``entry(spark)`` runs the flagship job (the cleaned flights fact) on the
sf0.001 tables.  ``queries()`` has one entry per operator or job; every
one reads whole benchmark tables through the dirty adapters in
``flightmart.sources.adapters``.  ``oracle_sql()`` gives, per key, DuckDB
SQL written independently of the Spark code (same adapter text, then the
operator re-expressed in SQL).
"""

from __future__ import annotations

import os
import sys
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flightmart.functions import is_missing  # noqa: E402
from flightmart.operators import (  # noqa: E402
    assemble_date,
    cast_columns,
    cast_with_rejects,
    content_digest,
    drop_columns,
    duplicate_keys,
    fill_const,
    fill_expr,
    fill_from,
    flag_counts,
    flag_missing,
    key_profile,
    key_sketches,
    mapping_frame,
    merge_audits,
    merged_key_profile,
    missing_audit,
    nan_audit,
    non_null_count,
    override_by_key,
    parse_dates,
    peek,
    reject_counts,
    reject_ledger,
    relabel_missing,
    rename,
    require_not_null,
    require_present,
    row_count,
    rows_missing,
    rows_with_values,
    schema_profile,
    select_columns,
    step_counts,
    strip_non_ascii,
    typed_rows,
)
from flightmart.plans import jobs  # noqa: E402
from flightmart.plans.jobs import (  # noqa: E402
    clean_airports,
    clean_carriers,
    clean_flights,
    clean_planes,
    clean_variables,
)
from flightmart.session import settings, shared_dir  # noqa: E402
from flightmart.sinks import (  # noqa: E402
    DEAL,
    even_partitions,
    publish,
    publish_increment,
    publish_snapshot,
    publish_zordered,
    read_snapshot,
    snapshot_versions,
    stage_and_verify,
)
from flightmart.sources import (  # noqa: E402
    adapter_sql,
    header_drift,
    raw_airports,
    raw_carriers,
    raw_flights,
    raw_planes,
    raw_variables,
    read_csv_by_name,
    read_csv_inferred,
    read_csv_strings,
    read_stage,
    resolve_sources,
    year_paths,
    year_span,
)
from flightmart.streaming import land_incrementally, publish_incrementally  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
# The column names of the raw files.
FLIGHT_COLUMNS = [
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
    "UniqueCarrier", "FlightNum", "TailNum", "ActualElapsedTime", "CRSElapsedTime", "AirTime",
    "ArrDelay", "DepDelay", "Origin", "Dest", "Distance", "TaxiIn", "TaxiOut", "Cancelled",
    "CancellationCode", "Diverted", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
    "LateAircraftDelay",
]
STAGED_COLUMNS = [c for c in FLIGHT_COLUMNS if c not in jobs.DROPPED_COLUMNS]
CLEAN_COLUMNS = STAGED_COLUMNS + [jobs.FLAG_NAME, jobs.DATE_NAME]


def staged_flights(spark: SparkSession, sf: str) -> DataFrame:
    """J1's first half: raw flights staged as verified Parquet and read back.

    The original job cleans the staged copy, not the raw read; staging also
    keeps the adapter's expressions out of the cleaning stage's generated code.
    """
    staged, _ = stage_and_verify(
        drop_columns(raw_flights(spark, sf), jobs.DROPPED_COLUMNS), shared_dir(spark, "flights_stage")
    )
    return staged


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the cleaned, typed flights fact (J1) over the sf0.001 tables."""
    return clean_flights(staged_flights(spark, SMOKE_DIR))


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def _airports(spark: SparkSession, sf: str) -> DataFrame:
    return rename(raw_airports(spark, sf), jobs.AIRPORT_RENAMES)


def _flight_years(spark: SparkSession, raw: DataFrame, root: str, compression: str | None) -> tuple[int, int]:
    """Write raw flights as one header-CSV folder per year (like the yearly files); first and last year."""
    span = year_span(raw)
    writer = (
        raw.withColumn("source_year", F.col("Year"))
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy("source_year")
    )
    if compression:
        writer = writer.option("compression", compression)
    # A file per year is open in each task, so no task sorts (and spills) its rows by year.
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "64"}):
        writer.csv(root)
    return span


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "csv_roundtrip")
    raw_flights(spark, sf).write.mode("overwrite").option("header", True).csv(root)
    return read_csv_strings(spark, [root])


def q_bz2_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "bz2_roundtrip")
    # Compressing is most of the job, and input splits hold whole row groups, so few tasks would have
    # most rows.  Three even files per core are three even waves here and even splits when read.
    n = 3 * spark.sparkContext.defaultParallelism
    evened = raw_flights(spark, sf, lambda rows: even_partitions(rows, n))
    with settings(spark, DEAL):
        evened.write.mode("overwrite").option("header", True).option("compression", "bzip2").csv(root)
    return read_csv_strings(spark, [f"{root}/*.csv.bz2"])


def q_parquet_stage(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "parquet_stage")
    staged, _ = stage_and_verify(drop_columns(raw_flights(spark, sf), jobs.DROPPED_COLUMNS), path, 40)
    return staged


def q_land(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "landing")
    span = _flight_years(spark, raw_flights(spark, sf), root, "bzip2")
    paths = year_paths(root, *span, "source_year={year}")
    staged, _ = jobs.land(spark, paths, shared_dir(spark, "stage"), on_missing="skip")
    return staged


def q_stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "landing_stream")
    _flight_years(spark, raw_flights(spark, sf), root, "bzip2")
    stage = shared_dir(spark, "stream_stage")
    land_incrementally(spark, f"{root}/*/", FLIGHT_COLUMNS, stage)
    return read_stage(spark, stage)


def q_flights_job(spark: SparkSession, sf: str) -> DataFrame:
    """J1 end to end: yearly CSV folders -> stage -> clean -> table partitioned by date, read back."""
    root, target = shared_dir(spark, "flight_years"), shared_dir(spark, "flights_fact")
    first, last = _flight_years(spark, raw_flights(spark, sf), root, None)
    jobs.flights_job(
        spark, root, shared_dir(spark, "flights_job_stage"), target, first, last, "source_year={year}", "skip", partitions=8
    )
    return spark.read.parquet(target)


def _new_database(spark: SparkSession) -> str:
    """A database of this session whose tables live in the shared folder."""
    name = f"flightmart_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, 'tables')}'")
    return name


def q_flights_table(spark: SparkSession, sf: str) -> DataFrame:
    """The partitioned fact as a catalog table, read back by name."""
    name = f"{_new_database(spark)}.flights"
    publish(
        clean_flights(staged_flights(spark, sf)),
        name,
        partition_by=jobs.PARTITION_COLUMNS,
        cluster_by=jobs.CLUSTER_COLUMNS,
        as_table=True,
    )
    return spark.table(name)


def q_planes_table(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup as a catalog table, published twice: the second replaces the first whole."""
    name = f"{_new_database(spark)}.planes"
    publish(clean_carriers(raw_carriers(spark, sf)), name, as_table=True)
    publish(clean_planes(raw_planes(spark, sf)), name, as_table=True)
    return spark.table(name)


def q_blank_header(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup CSV whose second and third header cells are empty."""
    source = shared_dir(spark, "blank_header")
    blank = raw_variables(spark, sf).toDF("Variable descriptions", " ", "  ")  # written trimmed
    blank.write.mode("overwrite").option("header", True).csv(source)
    return clean_variables(read_csv_inferred(spark, source))


def _respelled(df: DataFrame, how: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[how(c) for c in df.columns])


def q_partitioned_publish(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "published_flights")
    publish(
        clean_flights(staged_flights(spark, sf)),
        target,
        partition_by=jobs.PARTITION_COLUMNS,
        cluster_by=jobs.CLUSTER_COLUMNS,
    )
    return spark.read.parquet(target)


def _lookup_roundtrip(
    spark: SparkSession, raw: DataFrame, transform: Callable[[DataFrame], DataFrame], name: str
) -> DataFrame:
    """Lookup job end to end: raw CSV -> inferred read -> transform -> published table."""
    source = shared_dir(spark, f"{name}_csv")
    raw.write.mode("overwrite").option("header", True).csv(source)
    target = shared_dir(spark, f"{name}_table")
    jobs.lookup_job(spark, source, transform, target)
    return spark.read.parquet(target)


def q_resolve_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Skip policy for absent yearly sources, then read what exists."""
    root = shared_dir(spark, "resolve")
    first, last = _flight_years(spark, raw_flights(spark, sf), root, None)
    # A year before the first has no file: the policy skips it.
    present = resolve_sources(spark, year_paths(root, first - 1, last, "source_year={year}"), "skip")
    return read_csv_strings(spark, present)


def _planes_versions(spark: SparkSession, sf: str) -> str:
    """A table with two versions: the planes as read, then cleaned."""
    root = shared_dir(spark, "planes_versions")
    publish_snapshot(raw_planes(spark, sf), root)
    publish_snapshot(clean_planes(raw_planes(spark, sf)), root, cluster_by=["tailnum"], verify=True)
    return root


def q_snapshot_publish(spark: SparkSession, sf: str) -> DataFrame:
    return read_snapshot(spark, _planes_versions(spark, sf))


def q_snapshot_time_travel(spark: SparkSession, sf: str) -> DataFrame:
    root = _planes_versions(spark, sf)
    return read_snapshot(spark, root, snapshot_versions(spark, root)[0])


def q_snapshot_after_failure(spark: SparkSession, sf: str) -> DataFrame:
    """The planes after a publish that broke off while it was writing."""
    root = _planes_versions(spark, sf)
    stop = F.when(F.col("tailnum") == "N77", F.raise_error(F.lit("stopped while writing"))).otherwise(F.col("tailnum"))
    try:
        publish_snapshot(clean_planes(raw_planes(spark, sf)).withColumn("model", stop), root)
    except Exception as exc:
        if "stopped while writing" not in str(exc):
            raise
    return read_snapshot(spark, root)


def q_incremental_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings of yearly files whose months overlap, and one batch that is given twice."""
    root, table, months = shared_dir(spark, "increments"), shared_dir(spark, "increments_table"), ["Year", "Month"]
    raw = raw_flights(spark, sf)
    part = F.coalesce(F.pmod(F.col("FlightNum").cast("int"), F.lit(10)), F.lit(0))
    for name, rows in (("early", raw.where(part < 6)), ("late", raw.where(part.between(6, 8)))):
        _flight_years(spark, rows, f"{root}/{name}", None)
        publish_incrementally(spark, f"{root}/*/*/", FLIGHT_COLUMNS, table, partition_by=months)
    last = clean_flights(drop_columns(raw, jobs.DROPPED_COLUMNS).where(part == 9))
    for _ in range(2):
        publish_increment(last, table, months, jobs.CLUSTER_COLUMNS, stream="last", batch=0, verify=True)
    return read_snapshot(spark, table)


def q_zordered_publish(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "zordered_flights")
    publish_zordered(clean_flights(staged_flights(spark, sf)), target, jobs.CLUSTER_COLUMNS, files=64)
    return spark.read.parquet(target)


def q_land_verified(spark: SparkSession, sf: str) -> DataFrame:
    """Landing of bz2 files with every staged value verified."""
    root = shared_dir(spark, "landing_verified")
    span = _flight_years(spark, raw_flights(spark, sf), root, "bzip2")
    paths = year_paths(root, *span, "source_year={year}")
    staged, _ = jobs.land(spark, paths, shared_dir(spark, "stage_verified"), on_missing="skip", verify="content")
    return staged


def q_content_check(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the raw rows, of their stage, and of a stage with one kind of value changed."""
    raw = drop_columns(raw_flights(spark, sf), jobs.DROPPED_COLUMNS)
    other = staged_flights(spark, sf).withColumn("TaxiIn", F.when(F.col("TaxiIn") == "3", F.lit("4")).otherwise(F.col("TaxiIn")))
    found = [content_digest(df) for df in (raw, staged_flights(spark, sf).select(*raw.columns), other.select(*raw.columns))]
    one, two, three = (d.select(F.struct("*").alias(f"d{i}")) for i, d in enumerate(found))
    rows = one.crossJoin(two).crossJoin(three)  # three single rows
    return rows.select(
        F.col("d0.rows").alias("rows"), (F.col("d0") == F.col("d1")).alias("stage_is_equal"), (F.col("d0") == F.col("d2")).alias("changed_is_equal"),
        (F.col("d0.rows") == F.col("d2.rows")).alias("changed_has_all_rows"),
    )


#: Columns of the files whose header drifts: as published, turned round, and by name; one file group has no tail numbers.
DRIFTED = [FLIGHT_COLUMNS, FLIGHT_COLUMNS[::-1], sorted(FLIGHT_COLUMNS, key=str.lower)]
LACKING, WITHOUT = 4, "TailNum"


def _drifting_files(spark: SparkSession, sf: str) -> list[str]:
    """Nine groups of CSV files in three column orders, one group without a column; their folders."""
    root = shared_dir(spark, "drifting_headers")
    rows = raw_flights(spark, sf).withColumn("part", F.pmod(F.col("FlightNum").cast("int"), F.lit(9)))
    layouts = [(f"order{k}", cols, (F.col("part") % 3 == k) & (F.col("part") != LACKING)) for k, cols in enumerate(DRIFTED)]
    layouts.append(("lacking", [c for c in DRIFTED[LACKING % 3] if c != WITHOUT], F.col("part") == LACKING))
    for name, cols, of in layouts:
        rows.where(of).select(*cols, "part").write.partitionBy("part").option("header", True).csv(f"{root}/{name}")
    return [f"{root}/{name}/*" for name, _, _ in layouts]


def q_drifting_headers(spark: SparkSession, sf: str) -> DataFrame:
    return read_csv_by_name(spark, _drifting_files(spark, sf), FLIGHT_COLUMNS)


def q_header_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The kinds of drift that the files' headers show."""
    return header_drift(spark, _drifting_files(spark, sf), FLIGHT_COLUMNS).drop("file").distinct()


def _flights_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """Staged flights with the file each row came from."""
    part = F.concat(F.lit("part-"), F.pmod(F.col("FlightNum").cast("int"), F.lit(5)).cast("string"))
    return staged_flights(spark, sf).withColumn("source_file", part)


def q_merged_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Audit states of five files, of which one landed damaged first; merged without another scan."""
    root, rows = shared_dir(spark, "audit_states"), _flights_by_file(spark, sf)
    damaged = rows.where("source_file = 'part-2'").withColumn("DepTime", F.lit("NA"))
    jobs.refresh_audits(spark, rows.where("source_file IN ('part-0', 'part-1')").union(damaged), root, "source_file")
    jobs.refresh_audits(spark, rows.where("source_file IN ('part-2', 'part-3', 'part-4')"), root, "source_file")
    return merge_audits(read_snapshot(spark, root))


def q_merged_key_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Key profile of the carriers from sketches kept per file."""
    parts = raw_carriers(spark, sf).withColumn("file", F.pmod(F.xxhash64("Description"), F.lit(7)))
    root = shared_dir(spark, "key_sketches")
    key_sketches(parts, "Code", ["file"]).write.parquet(root)
    return merged_key_profile(spark.read.parquet(root))


def _cast_planes(spark: SparkSession, sf: str) -> DataFrame:
    """Planes cast in one pass, typed rows and rejects staged together."""
    path = shared_dir(spark, "cast_planes")
    cast_with_rejects(raw_planes(spark, sf), jobs.PLANE_INT_COLUMNS, jobs.PLANE_DATE_PATTERNS).write.parquet(path)
    return read_stage(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # audits (F1 F7 A3 A4)
    "missing_audit": lambda s, sf: missing_audit(raw_flights(s, sf)),
    "missing_audit_clean": lambda s, sf: missing_audit(clean_flights(staged_flights(s, sf))),
    "flights_audit_trail": lambda s, sf: jobs.flights_audit_trail(staged_flights(s, sf)),
    "planes_audit_trail": lambda s, sf: jobs.planes_audit_trail(raw_planes(s, sf)),
    "nan_audit": lambda s, sf: nan_audit(_airports(s, sf), ["latitude", "longitude"]),
    "airport_text_audit": lambda s, sf: missing_audit(
        _airports(s, sf), ["IATA", "airport", "city", "state", "country"]
    ),
    "planes_audit": lambda s, sf: missing_audit(raw_planes(s, sf)),
    "carriers_audit": lambda s, sf: missing_audit(raw_carriers(s, sf)),
    # filters (F2 F3 F4 F5 F8) and row accounting (A6)
    "require_present": lambda s, sf: require_present(
        require_present(raw_flights(s, sf), jobs.REQUIRED_TAXI), jobs.REQUIRED_SCHEDULE
    ),
    "require_not_null": lambda s, sf: require_not_null(raw_planes(s, sf), "type"),
    "rows_missing": lambda s, sf: rows_missing(_airports(s, sf), "city"),
    "rows_missing_after_override": lambda s, sf: rows_missing(clean_airports(raw_airports(s, sf)), "city"),
    "pick_airports": lambda s, sf: rows_with_values(
        clean_airports(raw_airports(s, sf)), "IATA", ["CLD", "ROR"]
    ),
    "carrier_na": lambda s, sf: rows_with_values(raw_carriers(s, sf), "Code", ["NA"]),
    "planes_step_counts": lambda s, sf: step_counts(
        raw_planes(s, sf), [("with_type", F.col("type").isNotNull())]
    ),
    "variables_step_counts": lambda s, sf: step_counts(
        raw_variables(s, sf), [("with_number", F.col("Variable descriptions").isNotNull())]
    ),
    "flights_step_counts": lambda s, sf: step_counts(
        raw_flights(s, sf),
        [
            ("with_taxi", ~(is_missing("TaxiIn") | is_missing("TaxiOut"))),
            ("with_schedule", ~is_missing("CRSElapsedTime")),
        ],
    ),
    # cleaning (C1-C10)
    "fill_from": lambda s, sf: fill_from(raw_flights(s, sf), jobs.FILL_FROM),
    "fill_const": lambda s, sf: fill_const(raw_flights(s, sf), jobs.FILL_ZERO),
    "fill_expr": lambda s, sf: fill_expr(
        fill_from(raw_flights(s, sf), jobs.FILL_FROM), "AirTime", jobs.air_time_fill()
    ),
    "relabel_tail": lambda s, sf: strip_non_ascii(relabel_missing(raw_flights(s, sf), "TailNum"), "TailNum"),
    "strip_non_ascii": lambda s, sf: strip_non_ascii(raw_flights(s, sf), "TailNum"),
    "flag_missing": lambda s, sf: flag_missing(
        require_present(raw_flights(s, sf), jobs.REQUIRED_TAXI + jobs.REQUIRED_SCHEDULE),
        jobs.FLAG_NAME,
        jobs.FLAG_COLUMNS,
    ),
    "flag_counts": lambda s, sf: flag_counts(
        flag_missing(
            require_present(raw_flights(s, sf), jobs.REQUIRED_TAXI + jobs.REQUIRED_SCHEDULE),
            jobs.FLAG_NAME,
            jobs.FLAG_COLUMNS,
        ),
        jobs.FLAG_NAME,
    ),
    "cast_columns": lambda s, sf: cast_columns(raw_flights(s, sf), jobs.INT_COLUMNS),
    "parse_date": lambda s, sf: parse_dates(raw_planes(s, sf), jobs.PLANE_DATE_PATTERNS),
    "assemble_date": lambda s, sf: select_columns(
        assemble_date(
            cast_columns(raw_flights(s, sf), ["Year", "Month", "DayofMonth"]),
            "FlightDate", "Year", "Month", "DayofMonth",
        ),
        ["Year", "Month", "DayofMonth", "FlightDate"],
    ),
    "override_by_key": lambda s, sf: clean_airports(raw_airports(s, sf)),
    "override_by_join": lambda s, sf: override_by_key(
        _airports(s, sf),
        "IATA",
        mapping_frame(s, "IATA", jobs.AIRPORT_CITY_STATE, ["city", "state"]),
        ["city", "state"],
    ),
    # counts and keys (A1 A2 A5 A7)
    "row_count": lambda s, sf: row_count(raw_flights(s, sf)),
    "non_null_count": lambda s, sf: non_null_count(
        require_not_null(raw_planes(s, sf), "type"), "tailnum"
    ),
    "key_profile": lambda s, sf: key_profile(raw_carriers(s, sf), "Code"),
    # projections and peek (P1 P2 P3 I1)
    "drop_columns": lambda s, sf: drop_columns(raw_flights(s, sf), jobs.DROPPED_COLUMNS + ["NoSuchColumn"]),
    "rename_select": lambda s, sf: select_columns(_airports(s, sf), ["IATA", "latitude", "longitude"]),
    "peek_flights": lambda s, sf: peek(clean_flights(staged_flights(s, sf)), 5, CLEAN_COLUMNS),
    # jobs (J1-J5)
    "clean_flights": lambda s, sf: clean_flights(staged_flights(s, sf)),
    "case_insensitive_names": lambda s, sf: clean_flights(_respelled(staged_flights(s, sf), str.lower)),
    "case_insensitive_trail": lambda s, sf: jobs.flights_audit_trail(_respelled(staged_flights(s, sf), str.upper)),
    "schema_rows": lambda s, sf: schema_profile(clean_flights(staged_flights(s, sf))),
    "clean_airports": lambda s, sf: clean_airports(raw_airports(s, sf)),
    "clean_planes": lambda s, sf: clean_planes(raw_planes(s, sf)),
    "clean_variables": lambda s, sf: clean_variables(raw_variables(s, sf)),
    "clean_carriers": lambda s, sf: clean_carriers(raw_carriers(s, sf)),
    # sources and sinks (S1-S7, K1-K5, J6), each through real files
    "csv_roundtrip": q_csv_roundtrip,
    "bz2_roundtrip": q_bz2_roundtrip,
    "resolve_sources": q_resolve_sources,
    "parquet_stage": q_parquet_stage,
    "land": q_land,
    "stream_landing": q_stream_landing,
    "partitioned_publish": q_partitioned_publish,
    "flights_job": q_flights_job,
    "flights_table": q_flights_table,
    "planes_table": q_planes_table,
    "blank_header": q_blank_header,
    "airports_job": lambda s, sf: _lookup_roundtrip(s, raw_airports(s, sf), clean_airports, "airports"),
    "planes_job": lambda s, sf: _lookup_roundtrip(s, raw_planes(s, sf), clean_planes, "planes"),
    "variables_job": lambda s, sf: _lookup_roundtrip(s, raw_variables(s, sf), clean_variables, "variables"),
    "carriers_job": lambda s, sf: _lookup_roundtrip(s, raw_carriers(s, sf), clean_carriers, "carriers"),
    # versions, increments and layout of published tables (K2 K3)
    "snapshot_publish": q_snapshot_publish,
    "snapshot_time_travel": q_snapshot_time_travel,
    "snapshot_after_failure": q_snapshot_after_failure,
    "incremental_publish": q_incremental_publish,
    "zordered_publish": q_zordered_publish,
    # contents verified (K5 J6), headers that drift (S1 S5)
    "land_verified": q_land_verified,
    "content_check": q_content_check,
    "drifting_headers": q_drifting_headers,
    "header_drift": q_header_drift,
    # audits, key profiles and rejects that are kept and merged (A3-A7 C8 C9)
    "merged_audit": q_merged_audit,
    "merged_key_profile": q_merged_key_profile,
    "duplicate_keys": lambda s, sf: duplicate_keys(raw_carriers(s, sf), "Code"),
    "duplicate_flights": lambda s, sf: duplicate_keys(raw_flights(s, sf), ["UniqueCarrier", "FlightNum", "Year", "Month"]),
    "reject_ledger": lambda s, sf: reject_ledger(_cast_planes(s, sf), ["tailnum"]),
    "reject_counts": lambda s, sf: reject_counts(_cast_planes(s, sf)),
    "typed_with_ledger": lambda s, sf: typed_rows(_cast_planes(s, sf)),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator / job; each takes (spark, sf_dir)."""
    return dict(QUERIES)


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

_TOKENS_SQL = "'null', 'NULL', 'NA', 'NaN'"


def _m(c: str, extra: tuple[str, ...] = ()) -> str:
    """Missing: NULL or one of the tokens."""
    toks = _TOKENS_SQL + "".join(f", '{t}'" for t in extra)
    return f"({c} IS NULL OR {c} IN ({toks}))"


def _i(c: str) -> str:
    """Lenient integer: trimmed; digits with optional fraction; '.5' is 0."""
    t = rf"regexp_replace(CAST({c} AS VARCHAR), '^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$', '', 'g')"
    w = f"regexp_replace({t}, '[.].*$', '')"
    return (
        f"(CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]*)') "
        f"THEN (CASE WHEN {w} IN ('', '+', '-') THEN 0 ELSE TRY_CAST({w} AS INTEGER) END) END)"
    )


def _wrap_int(expr: str) -> str:
    """64-bit value folded into 32-bit two's complement range."""
    return (
        f"CAST(((( ({expr}) + 2147483648) % 4294967296 + 4294967296) % 4294967296) - 2147483648 AS INTEGER)"
    )


def _air_time() -> str:
    diff = (
        f"CAST({_i('ActualElapsedTime')} AS BIGINT) - CAST({_i('TaxiIn')} AS BIGINT)"
        f" - CAST({_i('TaxiOut')} AS BIGINT)"
    )
    return f"CAST({_wrap_int(diff)} AS VARCHAR)"


def _date(y: str, m: str, d: str) -> str:
    return (
        f"TRY_CAST(CAST({y} AS VARCHAR) || '-' || lpad(CAST({m} AS VARCHAR), 2, '0') || '-' || "
        f"lpad(CAST({d} AS VARCHAR), 2, '0') AS DATE)"
    )


def _q(c: str) -> str:
    return f'"{c}"'


def _with(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({adapter_sql(n)})" for n in names) + "\n"


def _audit(table: str, cols: list[str], renamed: dict[str, str] | None = None) -> str:
    renamed = renamed or {}
    items = ", ".join(
        f"count(*) FILTER (WHERE {_m(_q(c))}) AS {_q(renamed.get(c, c))}" for c in cols
    )
    return _with(table) + f"SELECT {items} FROM {table}"


_FLIGHTS_PRESENT = (
    f"NOT ({_m('TaxiIn')} OR {_m('TaxiOut')}) AND NOT {_m('CRSElapsedTime')}"
)
# Fixed values, written out here so that a wrong constant in the jobs cannot pass.
_FLAG_OF = ["DepTime", "ArrTime", "ActualElapsedTime", "AirTime", "ArrDelay", "DepDelay"]
_FILLED_FROM = {"DepTime": "CRSDepTime", "ArrTime": "CRSArrTime", "ActualElapsedTime": "CRSElapsedTime"}
_INTS = [
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime", "FlightNum",
    "ActualElapsedTime", "CRSElapsedTime", "AirTime", "ArrDelay", "DepDelay", "Distance", "TaxiIn", "TaxiOut",
    "Cancelled", "Diverted",
]
_FLAG = "CASE WHEN " + " OR ".join(_m(c) for c in _FLAG_OF) + " THEN 1 ELSE 0 END"
_TAIL = (
    f"regexp_replace(CASE WHEN {_m('TailNum', ('UNKNOW',))} THEN 'Unknown Tail Number' "
    "ELSE TailNum END, '[^ -~]', '', 'g')"
)
_FILL_FROM = ", ".join(
    f"CASE WHEN {_m(c)} THEN {src} ELSE {c} END AS {c}" for c, src in _FILLED_FROM.items()
)
_FILL_ZERO = ", ".join(f"CASE WHEN {_m(c)} THEN '0' ELSE {c} END AS {c}" for c in ("DepDelay", "ArrDelay"))
_CASTS = ", ".join(f"{_i(c)} AS {c}" for c in _INTS)
_DROPPED = "CancellationCode, CarrierDelay, WeatherDelay, NASDelay, SecurityDelay, LateAircraftDelay"


def _clean_flights_sql(final: str = "SELECT * FROM clean") -> str:
    """The fact job as a CTE chain in the job's step order; ``final`` reads ``clean``."""
    return _with("raw_flights") + f""", f1 AS (
  SELECT * EXCLUDE ({_DROPPED}) FROM raw_flights WHERE {_FLIGHTS_PRESENT}
), f2 AS (
  SELECT * REPLACE ({_TAIL} AS TailNum), {_FLAG} AS MissingData FROM f1
), f3 AS (
  SELECT * REPLACE ({_FILL_FROM}, {_FILL_ZERO}) FROM f2
), f4 AS (
  SELECT * REPLACE (CASE WHEN {_m('AirTime')} THEN {_air_time()} ELSE AirTime END AS AirTime) FROM f3
), f5 AS (
  SELECT * REPLACE ({_CASTS}) FROM f4
), clean AS (
  SELECT *, {_date('Year', 'Month', 'DayofMonth')} AS FlightDate FROM f5
)
{final}"""


def _unpivot(stage: str, select: str) -> str:
    return (
        f"SELECT '{stage}' AS stage, \"column\", missing FROM "
        f"(UNPIVOT ({select}) ON COLUMNS(*) INTO NAME \"column\" VALUE missing)"
    )


def _counts(source: str, cols: list[str], keep: str | None, values: dict[str, str] | None = None) -> str:
    values = values or {}
    items = ", ".join(
        f"count(*) FILTER (WHERE {'' if keep is None else keep + ' AND '}"
        f"{_m('CAST(' + values.get(c, _q(c)) + ' AS VARCHAR)')}) AS {_q(c)}"
        for c in cols
    )
    return f"SELECT {items} FROM {source}"


def _flights_trail_sql() -> str:
    taxi_ok = f"NOT ({_m('TaxiIn')} OR {_m('TaxiOut')})"
    kept = _FLIGHTS_PRESENT
    later = STAGED_COLUMNS + [jobs.FLAG_NAME]
    head = _with("raw_flights") + f""", s AS (
  SELECT * EXCLUDE ({_DROPPED}) FROM raw_flights
), filled AS (
  SELECT * REPLACE ({_TAIL} AS TailNum, {_FILL_FROM}, {_FILL_ZERO}), {_FLAG} AS MissingData,
    {taxi_ok} AS k_taxi, {kept} AS k_all FROM s
), aired AS (
  SELECT * REPLACE (CASE WHEN {_m('AirTime')} THEN {_air_time()} ELSE AirTime END AS AirTime) FROM filled
)
"""
    parts = [
        _unpivot("raw", _counts("s", STAGED_COLUMNS, None)),
        _unpivot("after_taxi_filter", _counts("s", STAGED_COLUMNS, taxi_ok)),
        _unpivot("after_fills", _counts("filled", later, "k_all")),
        _unpivot("after_air_time", _counts("aired", later, "k_all")),
    ]
    return head + "\nUNION ALL\n".join(parts)


_PLANE_COLUMNS = ["tailnum", "type", "issue_date", "model", "year"]


_OVERRIDE_CITY = (
    "WHEN 'CLD' THEN 'San Diego' WHEN 'HHH' THEN 'Hilton Head Island' WHEN 'MIB' THEN 'Minot' "
    "WHEN 'MQT' THEN 'Marquette' WHEN 'RCA' THEN 'Rapid City' WHEN 'RDR' THEN 'Grand Forks' "
    "WHEN 'ROP' THEN 'Mueang Prachinburi' WHEN 'ROR' THEN 'Airai' WHEN 'SCE' THEN 'State College' "
    "WHEN 'SKA' THEN 'Spokane' WHEN 'SPN' THEN 'San Jose' WHEN 'YAP' THEN 'Colonia'"
)
_OVERRIDE_STATE = (
    "WHEN 'CLD' THEN 'CA' WHEN 'HHH' THEN 'SC' WHEN 'MIB' THEN 'ND' WHEN 'MQT' THEN 'MI' WHEN 'RCA' THEN 'SD' "
    "WHEN 'RDR' THEN 'ND' WHEN 'ROP' THEN 'PC' WHEN 'ROR' THEN 'PW350' WHEN 'SCE' THEN 'PA' WHEN 'SKA' THEN 'WA' "
    "WHEN 'SPN' THEN 'TI' WHEN 'YAP' THEN 'FMYAP'"
)


def _clean_airports_sql(where: str = "") -> str:
    return _with("raw_airports") + (
        f"SELECT iata AS IATA, airport, CASE iata {_OVERRIDE_CITY} ELSE city END AS city, "
        f"CASE iata {_OVERRIDE_STATE} ELSE state END AS state, country, "
        f"lat AS latitude, long AS longitude FROM raw_airports {where}"
    )


_AIRPORTS_RENAMED = (
    "SELECT iata AS IATA, airport, city, state, country, lat AS latitude, long AS longitude FROM raw_airports"
)
_PLANE_DATE = (
    "CASE WHEN regexp_full_match(issue_date, '[0-9]{2}/[0-9]{2}/[0-9]{4}') "
    "THEN CAST(try_strptime(issue_date, '%m/%d/%Y') AS DATE) END"
)
_CLEAN_PLANES = f"SELECT * REPLACE ({_PLANE_DATE} AS issue_date, {_i('year')} AS year) FROM raw_planes WHERE type IS NOT NULL"
_CLEAN_VARIABLES = (
    'SELECT "Variable descriptions", _c1 AS Name, _c2 AS Description FROM raw_variables '
    'WHERE "Variable descriptions" IS NOT NULL'
)
# What the casts of a plane cannot read; in these rows every such text is no number or date at all (reason 2).
_REJECTED = f""", rejected AS (
  SELECT tailnum, 'year' AS "column", year AS raw, 2 AS reason FROM raw_planes WHERE NOT {_m('year')} AND {_i('year')} IS NULL
  UNION ALL
  SELECT tailnum, 'issue_date', issue_date, 2 FROM raw_planes WHERE NOT {_m('issue_date')} AND ({_PLANE_DATE}) IS NULL
)"""


def _drift_sql() -> str:
    """The drift of the second and third column order, and of the group that lacks a column."""
    lacking = [c for c in DRIFTED[LACKING % 3] if c != WITHOUT]
    rows = {(WITHOUT, "absent", FLIGHT_COLUMNS.index(WITHOUT), None)}
    for own in (*DRIFTED[1:], lacking):
        rows |= {(c, "moved", at, own.index(c)) for at, c in enumerate(FLIGHT_COLUMNS) if c in own and own.index(c) != at}
    values = ", ".join(f"('{c}', '{d}', {at}, {'NULL' if i is None else i})" for c, d, at, i in sorted(rows, key=str))
    return f'SELECT * FROM (VALUES {values}) AS t("column", drift, wanted_at, found_at)'


_STAGED = f"SELECT * EXCLUDE ({_DROPPED}) FROM raw_flights"
_ORDER_ALL = ", ".join(f"{c} ASC NULLS FIRST" for c in CLEAN_COLUMNS)

_CLEAN_TYPES = {c: "string" for c in ("UniqueCarrier", "TailNum", "Origin", "Dest")} | {"FlightDate": "date"}

ORACLE: dict[str, str] = {
    "missing_audit": _audit("raw_flights", FLIGHT_COLUMNS),
    "missing_audit_clean": _clean_flights_sql(
        "SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {_m('CAST(' + c + ' AS VARCHAR)')}) AS {c}" for c in CLEAN_COLUMNS)
        + " FROM clean"
    ),
    "flights_audit_trail": _flights_trail_sql(),
    "planes_audit_trail": _with("raw_planes")
    + _unpivot("raw", _counts("raw_planes", _PLANE_COLUMNS, None))
    + "\nUNION ALL\n"
    + _unpivot("after_type_filter", _counts("raw_planes", _PLANE_COLUMNS, "type IS NOT NULL")),
    "nan_audit": _with("raw_airports")
    + "SELECT count(*) FILTER (WHERE lat IS NULL OR isnan(lat)) AS latitude, "
    "count(*) FILTER (WHERE long IS NULL OR isnan(long)) AS longitude FROM raw_airports",
    "airport_text_audit": _audit(
        "raw_airports", ["iata", "airport", "city", "state", "country"], {"iata": "IATA"}
    ),
    "planes_audit": _audit("raw_planes", ["tailnum", "type", "issue_date", "model", "year"]),
    "carriers_audit": _audit("raw_carriers", ["Code", "Description"]),
    "require_present": _with("raw_flights") + f"SELECT * FROM raw_flights WHERE {_FLIGHTS_PRESENT}",
    "require_not_null": _with("raw_planes") + "SELECT * FROM raw_planes WHERE type IS NOT NULL",
    "rows_missing": _with("raw_airports") + f"SELECT * FROM ({_AIRPORTS_RENAMED}) WHERE {_m('city')}",
    "rows_missing_after_override": _clean_airports_sql(
        f"WHERE CASE iata {_OVERRIDE_CITY} ELSE city END IS NULL "
        f"OR CASE iata {_OVERRIDE_CITY} ELSE city END IN ({_TOKENS_SQL})"
    ),
    "pick_airports": _clean_airports_sql("WHERE iata = 'CLD' OR iata = 'ROR'"),
    "carrier_na": _with("raw_carriers") + "SELECT * FROM raw_carriers WHERE Code = 'NA'",
    "planes_step_counts": _with("raw_planes")
    + "SELECT count(*) AS rows_in, count(*) FILTER (WHERE type IS NOT NULL) AS with_type FROM raw_planes",
    "variables_step_counts": _with("raw_variables")
    + 'SELECT count(*) AS rows_in, count(*) FILTER (WHERE "Variable descriptions" IS NOT NULL) AS with_number '
    "FROM raw_variables",
    "flights_step_counts": _with("raw_flights")
    + f"SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT ({_m('TaxiIn')} OR {_m('TaxiOut')})) AS with_taxi, "
    f"count(*) FILTER (WHERE {_FLIGHTS_PRESENT}) AS with_schedule FROM raw_flights",
    "fill_from": _with("raw_flights") + f"SELECT * REPLACE ({_FILL_FROM}) FROM raw_flights",
    "fill_const": _with("raw_flights") + f"SELECT * REPLACE ({_FILL_ZERO}) FROM raw_flights",
    "fill_expr": _with("raw_flights")
    + f", f AS (SELECT * REPLACE ({_FILL_FROM}) FROM raw_flights)\n"
    f"SELECT * REPLACE (CASE WHEN {_m('AirTime')} THEN {_air_time()} ELSE AirTime END AS AirTime) FROM f",
    "relabel_tail": _with("raw_flights") + f"SELECT * REPLACE ({_TAIL} AS TailNum) FROM raw_flights",
    "strip_non_ascii": _with("raw_flights")
    + "SELECT * REPLACE (regexp_replace(TailNum, '[^ -~]', '', 'g') AS TailNum) FROM raw_flights",
    "flag_missing": _with("raw_flights")
    + f"SELECT *, {_FLAG} AS MissingData FROM raw_flights WHERE {_FLIGHTS_PRESENT}",
    "flag_counts": _with("raw_flights")
    + f'SELECT {_FLAG} AS MissingData, count(*) AS "count" FROM raw_flights WHERE {_FLIGHTS_PRESENT} GROUP BY 1',
    "cast_columns": _with("raw_flights") + f"SELECT * REPLACE ({_CASTS}) FROM raw_flights",
    "parse_date": _with("raw_planes") + f"SELECT * REPLACE ({_PLANE_DATE} AS issue_date) FROM raw_planes",
    "assemble_date": _with("raw_flights")
    + f", c AS (SELECT {_i('Year')} AS Year, {_i('Month')} AS Month, {_i('DayofMonth')} AS DayofMonth "
    f"FROM raw_flights)\nSELECT *, {_date('Year', 'Month', 'DayofMonth')} AS FlightDate FROM c",
    "override_by_key": _clean_airports_sql(),
    "override_by_join": _clean_airports_sql(),
    "row_count": _with("raw_flights") + 'SELECT count(*) AS "rows" FROM raw_flights',
    "non_null_count": _with("raw_planes")
    + "SELECT count(tailnum) AS count_tailnum FROM raw_planes WHERE type IS NOT NULL",
    "key_profile": _with("raw_carriers")
    + 'SELECT count(*) AS "rows", count(Code) AS non_null, count(DISTINCT Code) AS "distinct", '
    "count(Code) - count(DISTINCT Code) AS duplicates FROM raw_carriers",
    "drop_columns": _with("raw_flights") + _STAGED,
    "rename_select": _with("raw_airports")
    + "SELECT iata AS IATA, lat AS latitude, long AS longitude FROM raw_airports",
    "peek_flights": _clean_flights_sql(f"SELECT * FROM clean ORDER BY {_ORDER_ALL} LIMIT 5"),
    "clean_flights": _clean_flights_sql(),
    "flights_job": _clean_flights_sql(),
    "flights_table": _clean_flights_sql(),
    "case_insensitive_names": _clean_flights_sql(),
    "case_insensitive_trail": _flights_trail_sql(),
    "schema_rows": _clean_flights_sql(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS name, '{_CLEAN_TYPES.get(c, 'int')}' AS type, count({c}) AS filled FROM clean"
            for c in CLEAN_COLUMNS
        )
    ),
    "planes_table": _with("raw_planes") + _CLEAN_PLANES,
    "blank_header": _with("raw_variables") + _CLEAN_VARIABLES,
    "clean_airports": _clean_airports_sql(),
    "clean_planes": _with("raw_planes") + _CLEAN_PLANES,
    "clean_variables": _with("raw_variables") + _CLEAN_VARIABLES,
    "clean_carriers": _with("raw_carriers") + "SELECT * FROM raw_carriers",
    "csv_roundtrip": _with("raw_flights") + "SELECT * FROM raw_flights",
    "bz2_roundtrip": _with("raw_flights") + "SELECT * FROM raw_flights",
    "resolve_sources": _with("raw_flights") + "SELECT * FROM raw_flights",
    "parquet_stage": _with("raw_flights") + _STAGED,
    "land": _with("raw_flights") + _STAGED,
    "stream_landing": _with("raw_flights") + _STAGED,
    "partitioned_publish": _clean_flights_sql(),
    "airports_job": _clean_airports_sql(),
    "planes_job": _with("raw_planes") + _CLEAN_PLANES,
    "variables_job": _with("raw_variables") + _CLEAN_VARIABLES,
    "carriers_job": _with("raw_carriers") + "SELECT * FROM raw_carriers",
    "snapshot_publish": _with("raw_planes") + _CLEAN_PLANES,
    "snapshot_time_travel": _with("raw_planes") + "SELECT * FROM raw_planes",
    "snapshot_after_failure": _with("raw_planes") + _CLEAN_PLANES,
    "incremental_publish": _clean_flights_sql(),
    "zordered_publish": _clean_flights_sql(),
    "land_verified": _with("raw_flights") + _STAGED,
    "content_check": _with("raw_flights")
    + "SELECT count(*) AS \"rows\", true AS stage_is_equal, count(*) FILTER (WHERE TaxiIn = '3') = 0 AS changed_is_equal, "
    "true AS changed_has_all_rows FROM raw_flights",
    "drifting_headers": _with("raw_flights")
    + f"SELECT * REPLACE (CASE WHEN CAST(FlightNum AS INTEGER) % 9 = {LACKING} THEN NULL ELSE {WITHOUT} END AS {WITHOUT}) FROM raw_flights",
    "header_drift": _drift_sql(),
    "merged_audit": _flights_trail_sql(),
    "merged_key_profile": _with("raw_carriers")
    + 'SELECT count(*) AS "rows", count(Code) AS non_null, count(DISTINCT Code) AS "distinct", '
    "count(Code) - count(DISTINCT Code) AS duplicates FROM raw_carriers",
    "duplicate_keys": _with("raw_carriers")
    + 'SELECT Code, count(*) AS "rows" FROM raw_carriers WHERE Code IS NOT NULL GROUP BY Code HAVING count(*) > 1',
    "duplicate_flights": _with("raw_flights")
    + 'SELECT UniqueCarrier, FlightNum, Year, Month, count(*) AS "rows" FROM raw_flights GROUP BY ALL HAVING count(*) > 1',
    "reject_ledger": _with("raw_planes") + _REJECTED + " SELECT * FROM rejected",
    "reject_counts": _with("raw_planes")
    + _REJECTED
    + ' SELECT "column", reason, count(*) AS rejects FROM rejected GROUP BY ALL',
    "typed_with_ledger": _with("raw_planes") + f"SELECT * REPLACE ({_PLANE_DATE} AS issue_date, {_i('year')} AS year) FROM raw_planes",
}


try:  # an optional part: everything else works without it
    import corpus_pipeline
    from flightmart.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # Absent, or a library that only this part needs is: the queries above still run.
    if (missing.name or "").partition(".")[0] == "flightmart" and missing.name != "flightmart.llm":
        raise
    if missing.name not in ("corpus_pipeline", "flightmart.llm"):
        warnings.warn(f"without the optional queries: {missing}", stacklevel=1)
else:
    QUERIES |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    ORACLE |= llm_queries.ORACLE
    if corpus_pipeline.ORACLE_SQL:
        ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
