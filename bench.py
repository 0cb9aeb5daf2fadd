"""Benchmark the jobs at one scale factor; prints ONE JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Setup (untimed) derives the raw inputs from the benchmark tables: the dirty
flights projection written as one header-CSV folder per year (plain and
bzip2) and the four lookups as CSV.  The cleaning and audit plans first run once on the
smallest tables ($BENCH_WARMUP_DIR, default sf0.001) for the compile-heavy
cleaning and audit plans, to warm the JIT and the generated-code cache; its
time is reported as ``warmup_seconds``.  The timed
queries are the original pipeline's stages:

  land_bz2         J6  yearly .bz2 CSVs -> verified Parquet stage
  flights_job      J1  yearly CSVs -> stage -> clean -> date-partitioned publish
  clean_flights    J1  staged Parquet -> cleaned fact (computed in full, no output)
  publish_flights  K3  staged Parquet -> cleaned fact -> date-partitioned publish
  missing_audit    A3  per-column missing counts over the staged raw rows
  audit_trail      A3 x4  the fact job's four audits (raw .. after air time) in one pass
  flag_counts      A5  MissingData counts over the filtered rows
  lookup_jobs      J2-J5 four lookup CSVs -> cleaned -> published
  key_profile      A7  carrier code uniqueness
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from flightmart import get_session, shared_dir  # noqa: E402
from flightmart.operators import flag_counts, flag_missing, key_profile, missing_audit, require_present  # noqa: E402
from flightmart.plans import jobs  # noqa: E402
from flightmart.sinks import publish  # noqa: E402
from flightmart.sources import (  # noqa: E402
    raw_airports,
    raw_carriers,
    raw_flights,
    raw_planes,
    raw_variables,
    read_csv_inferred,
    year_paths,
    year_span,
)


def _log(msg: str) -> None:
    print(msg, file=sys.stderr, flush=True)


def _write_years(raw, root: str, compression: str | None) -> None:
    w = raw.withColumn("source_year", F.col("Year")).write.mode("overwrite").option("header", True)
    if compression:
        w = w.option("compression", compression)
    w.partitionBy("source_year").csv(root)


def run_suite(spark, sf_dir: str, run: str, log=_log) -> tuple[dict[str, float], int]:
    """Set up raw inputs under ``run`` (untimed), then time every query once."""
    t = time.time()
    raw = raw_flights(spark, sf_dir)
    _write_years(raw, f"{run}/csv", None)
    _write_years(raw, f"{run}/bz2", "bzip2")
    lookups = {
        "airports": (raw_airports(spark, sf_dir), jobs.clean_airports),
        "carriers": (raw_carriers(spark, sf_dir), jobs.clean_carriers),
        "planes": (raw_planes(spark, sf_dir), jobs.clean_planes),
        "variables": (raw_variables(spark, sf_dir), jobs.clean_variables),
    }
    for name, (df, _) in lookups.items():
        df.write.mode("overwrite").option("header", True).csv(f"{run}/lookup_{name}")
    first, last = year_span(raw)
    bz2_years = year_paths(f"{run}/bz2", first, last, "source_year={year}")
    log(f"setup {time.time() - t:.1f}s in {run}")

    stage = f"{run}/stage"
    results: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        results[name] = round(time.time() - t0, 3)
        log(f"{name}: {results[name]}s {'' if out is None else out}")
        return out

    timed("land_bz2", lambda: jobs.land(spark, bz2_years, stage, on_missing="skip")[1])
    timed(
        "flights_job",
        lambda: jobs.flights_job(
            spark, f"{run}/csv", f"{run}/stage_j1", f"{run}/fact_j1", first, last, "source_year={year}", "skip"
        ),
    )
    staged = spark.read.parquet(stage)
    timed(
        "clean_flights",
        lambda: jobs.clean_flights(staged).write.format("noop").mode("overwrite").save(),
    )
    timed(
        "publish_flights",
        lambda: publish(
            jobs.clean_flights(staged),
            f"{run}/fact",
            partition_by=jobs.PARTITION_COLUMNS,
            cluster_by=jobs.CLUSTER_COLUMNS,
        ),
    )
    timed("missing_audit", lambda: missing_audit(staged).collect()[0]["TaxiIn"])
    timed("audit_trail", lambda: len(jobs.flights_audit_trail(staged).collect()))
    timed(
        "flag_counts",
        lambda: sorted(
            tuple(r)
            for r in flag_counts(
                flag_missing(
                    require_present(staged, jobs.REQUIRED_TAXI + jobs.REQUIRED_SCHEDULE),
                    jobs.FLAG_NAME,
                    jobs.FLAG_COLUMNS,
                ),
                jobs.FLAG_NAME,
            ).collect()
        ),
    )

    def lookup_jobs():
        for name, (_, transform) in lookups.items():
            jobs.lookup_job(spark, f"{run}/lookup_{name}", transform, f"{run}/table_{name}")

    timed("lookup_jobs", lookup_jobs)
    timed(
        "key_profile",
        lambda: key_profile(read_csv_inferred(spark, f"{run}/lookup_carriers"), "Code").collect()[0].asDict(),
    )
    return results, raw.count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        app="flightmart-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            # Many dates, little data: keep several writers for the daily files.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = shared_dir(spark, "bench")

    # Warm-up (not in the total): compile the wide cleaning and audit plans once on
    # a small stage, so JIT and generated-code compilation (a fixed cost per plan
    # shape, several seconds for the cleaning stage) are not counted as data
    # processing.  File-heavy queries are not repeated: on tiny data the publish
    # shuffle coalesces into one task that creates every daily file serially.
    t = time.time()
    if warmup_dir != sf_dir and os.path.isdir(warmup_dir):
        small = raw_flights(spark, warmup_dir).drop(*jobs.DROPPED_COLUMNS)
        small.write.mode("overwrite").parquet(f"{run}/warmup_stage")
        staged = spark.read.parquet(f"{run}/warmup_stage")
        jobs.clean_flights(staged).write.format("noop").mode("overwrite").save()
        jobs.flights_audit_trail(staged).collect()
        missing_audit(staged).collect()
    warmup_seconds = round(time.time() - t, 3)
    results, raw_rows = run_suite(spark, sf_dir, f"{run}/timed")

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(sf_dir).replace("sf", ""),
                "cpus": int(cpus),
                "raw_rows": raw_rows,
                "warmup_sf": os.path.basename(warmup_dir).replace("sf", ""),
                "warmup_seconds": warmup_seconds,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
