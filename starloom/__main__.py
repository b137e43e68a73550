"""Command line: run the racing star-schema job on the current cluster.

    python -m starloom racing --control control.csv --landing <dir> \\
        --bronze <dir|database> --silver <dir> [--export <dir>] [--keep-all-results] \\
        [--race-ids 18,19] [--rejects <dir> --max-reject-share 0.01] \\
        [--allow-drift added,widened] [--keep-versions 3]

or on a cluster, ``spark-submit --py-files starloom.zip starloom/__main__.py
racing ...`` with the same arguments.

``--control`` is a CSV file with the columns file_name, file_type,
target_table, file_delimiter (or a catalog table name).  The session is the
one the job is launched with (``getOrCreate``); nothing is configured here.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from starloom.plans import racing
from starloom.sources.landing import CONTROL_SCHEMA, Rejects


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starloom")
    sub = ap.add_subparsers(dest="job", required=True)
    r = sub.add_parser("racing", help="ingest landed files, load the silver star schema, export")
    r.add_argument("--control", required=True)
    r.add_argument("--landing", required=True)
    r.add_argument("--bronze", required=True)
    r.add_argument("--silver", required=True)
    r.add_argument("--export")
    r.add_argument("--load-ts")
    r.add_argument("--keep-all-results", action="store_true",
                   help="keep result rows without a qualifying time")
    r.add_argument("--race-ids", type=lambda v: [int(x) for x in v.split(",")],
                   help="targeted reload: rebuild only these races in the fact")
    r.add_argument("--rejects", help="folder of the table that takes lines which do not parse")
    r.add_argument("--max-reject-share", type=float, default=1.0,
                   help="share of a source's lines above which it fails all the same")
    r.add_argument("--allow-drift", type=lambda v: [x for x in v.split(",") if x],
                   help="schema changes that a source may bring: added,missing,widened,narrower")
    r.add_argument("--keep-versions", type=int, help="remove older versions of the tables afterwards")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("starloom-racing").getOrCreate()
    if "/" in args.control or args.control.endswith(".csv"):
        control = spark.read.schema(CONTROL_SCHEMA).option("header", "true").csv(args.control)
    else:
        control = spark.table(args.control)
    try:
        res, _ = racing.run_from_landing(
            spark, control, args.landing, args.bronze, args.silver, export_dir=args.export,
            load_ts=args.load_ts, race_ids=args.race_ids,
            rejects=Rejects(args.rejects, max_share=args.max_reject_share) if args.rejects else None,
            allow_drift=args.allow_drift, keep_versions=args.keep_versions,
            require_measure=None if args.keep_all_results else "best_qualifying_time_ms")
    except racing.SourcesFailed as e:
        res = e.result
    res.audit.show(truncate=False)
    print(f"loaded={res.loaded} skipped={res.skipped} failed={res.failed}")
    return 1 if res.failed else 0


if __name__ == "__main__":
    sys.exit(main())
