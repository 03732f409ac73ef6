"""Run the catalogue job: ``python -m marquee --raw PATH --out DIR``.

Uses the session the cluster configures (``spark-submit`` settings); it
never sets a master or partition counts itself. Exits 1 on failure,
naming the stage that failed.
"""

from __future__ import annotations

import argparse
import logging
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="marquee", description=__doc__.splitlines()[0])
    ap.add_argument("--raw", required=True, help="raw records (CSV / JSON lines / Parquet)")
    ap.add_argument("--raw-format", default="parquet", choices=["csv", "json", "parquet"])
    ap.add_argument("--single-line", action="store_true",
                    help="no CSV cell holds a line break: read each CSV file in many tasks")
    ap.add_argument("--out", required=True, help="output folder for the clean table and KPI tables")
    ap.add_argument("--format", default="parquet", choices=["csv", "parquet"], help="output format")
    ap.add_argument("--expected-rows", type=int, default=None)
    ap.add_argument("--as-of", default=None, help="date for the 'release after' check (default today)")
    ap.add_argument("--parallel", type=int, default=4, help="KPI tables written at once")
    ap.add_argument("--refresh-from", default=None,
                    help="an earlier clean output: re-clean only ids listed in --changed")
    ap.add_argument("--changed", default=None,
                    help="ids of the new raw records (a table with an 'id' column, same format as --raw)")
    ap.add_argument("--approx-median", action="store_true",
                    help="bounded-memory approximate medians instead of exact ones")
    args = ap.parse_args(argv)
    if bool(args.refresh_from) != bool(args.changed):
        ap.error("--refresh-from and --changed go together")

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    from pyspark.sql import SparkSession

    from marquee.plans.job import StageError, run
    from marquee.sources.raw import read_raw

    spark = SparkSession.builder.appName("marquee").getOrCreate()
    try:
        raw = read_raw(spark, args.raw, args.raw_format, multiline=not args.single_line)
        changed = read_raw(spark, args.changed, args.raw_format) if args.changed else None
        paths = run(spark, raw, args.out, args.format, args.as_of, args.expected_rows, args.parallel,
                    args.approx_median, refresh_from=args.refresh_from, changed=changed)
    except StageError as e:
        print(f"job failed during the '{e.stage}' stage: {e.__cause__}", file=sys.stderr)
        return 1
    for name, path in paths.items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
