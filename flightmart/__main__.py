"""Run one job from the command line (what a scheduler task calls).

    python -m flightmart land      --source ROOT --stage PATH [--first 2000 --last 2008] [--on-missing skip]
    python -m flightmart flights   --source ROOT --stage PATH --target PATH_OR_TABLE [--table]
    python -m flightmart airports  --source FILE --target PATH_OR_TABLE [--table]
    python -m flightmart carriers  --source FILE --target PATH_OR_TABLE [--table]
    python -m flightmart planes    --source FILE --target PATH_OR_TABLE [--table]
    python -m flightmart variables --source FILE --target PATH_OR_TABLE [--table]
    python -m flightmart audit     --stage PATH          (one-pass audit trail, printed)
    python -m flightmart stream    --source GLOB --stage PATH --checkpoint PATH   (incremental landing)
    python -m flightmart increment --source GLOB --target PATH                    (new files into the versioned fact)
    python -m flightmart drift     --source GLOB                                  (files whose header differs)

``flights --snapshots`` publishes the fact as the next version of a table (an
unfinished run leaves the version before), ``--verify content`` compares all
staged values, ``land --by-name`` binds columns by name in every file.

The session comes from ``spark-submit`` / the environment (master, executors,
``spark.checkpoint.dir``); only the job defaults in ``session.DEFAULT_CONF``
are added.
"""

from __future__ import annotations

import argparse
import sys

from .plans import jobs
from .session import get_session
from .sources.files import csv_header, read_stage, year_paths
from .sources.headers import header_drift
from .streaming.landing import land_incrementally
from .streaming.publishing import publish_incrementally

LOOKUPS = {
    "airports": jobs.clean_airports,
    "carriers": jobs.clean_carriers,
    "planes": jobs.clean_planes,
    "variables": jobs.clean_variables,
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="flightmart")
    p.add_argument("job", choices=["land", "flights", "audit", "stream", "increment", "drift", *LOOKUPS])
    p.add_argument("--source", help="yearly CSV folder (land, flights) or lookup CSV file")
    p.add_argument("--stage", help="Parquet staging folder")
    p.add_argument("--target", help="published table path, or catalog name with --table")
    p.add_argument("--table", action="store_true", help="publish as a catalog table")
    p.add_argument("--first", type=int, default=jobs.FIRST_YEAR)
    p.add_argument("--last", type=int, default=jobs.LAST_YEAR)
    p.add_argument("--pattern", default=jobs.YEAR_FILE_PATTERN)
    p.add_argument("--on-missing", choices=["fail", "skip"], default="fail")
    p.add_argument("--reuse-stage", action="store_true", help="flights: resume from a stage of the same sources")
    p.add_argument("--partitions", type=int, help="flights: even the stage out to this many files")
    p.add_argument("--snapshots", action="store_true", help="flights: publish a new version of the table at --target")
    p.add_argument("--verify", choices=["rows", "content"], default="rows", help="land, flights: what of the stage is compared")
    p.add_argument("--by-name", action="store_true", help="land: bind columns by name, file by file")
    p.add_argument("--checkpoint", help="stream: progress folder kept with the stage (shared storage)")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session(app=f"flightmart-{args.job}")
    if args.job == "land":
        paths = year_paths(args.source, args.first, args.last, args.pattern)
        _, rows = jobs.land(spark, paths, args.stage, args.on_missing, verify=args.verify, by_name=args.by_name)
        print(f"staged {rows} rows at {args.stage}")
    elif args.job == "flights":
        rows = jobs.flights_job(
            spark, args.source, args.stage, args.target, args.first, args.last, args.pattern,
            args.on_missing, args.table, args.reuse_stage, args.partitions, args.snapshots, args.verify,
        )
        print(f"published {args.target} from {rows} staged rows")
    elif args.job == "stream":
        columns = csv_header(spark, args.source)
        land_incrementally(spark, args.source, columns, args.stage, args.checkpoint)
        print(f"stage {args.stage} is up to date with {args.source}")
    elif args.job == "increment":
        made = publish_incrementally(spark, args.source, csv_header(spark, args.source), args.target, args.checkpoint)
        print(f"published {made} new versions of {args.target}")
    elif args.job == "drift":
        for r in header_drift(spark, args.source, csv_header(spark, args.source)).orderBy("file", "column").collect():
            print(f"{r.file} {r.column} {r.drift} {r.wanted_at} {r.found_at}")
    elif args.job == "audit":
        for r in jobs.flights_audit_trail(read_stage(spark, args.stage)).collect():
            print(f"{r.stage:>18} {r.column:>18} {r.missing}")
    else:
        jobs.lookup_job(spark, args.source, LOOKUPS[args.job], args.target, as_table=args.table)
        print(f"published {args.target}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
