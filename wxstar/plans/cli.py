"""spark-submit entry point for the jobs.

    spark-submit -m wxstar.plans.cli ingest-year --year 2024 --source-prefix s3://.../by_year --output-prefix s3://...
    python -m wxstar.plans.cli backfill --first 1990 --last 2025 --source-prefix ... --output-prefix ...
    python -m wxstar.plans.cli refresh --source-prefix ... --output-prefix ... [--as-of 2026-01-02]
    python -m wxstar.plans.cli stations --source-path .../stations.txt --output-path .../stations.parquet
    python -m wxstar.plans.cli star --observations ... --stations ... --warehouse ... [--target prod]

The session is the one the cluster provides (``getOrCreate``); only the time zone is set.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from wxstar.plans import jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wxstar")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("ingest-year")
    a.add_argument("--year", type=int, required=True)
    a.add_argument("--source-prefix", required=True)
    a.add_argument("--output-prefix", required=True)
    b = sub.add_parser("backfill")
    b.add_argument("--first", type=int, default=1990)
    b.add_argument("--last", type=int, default=2025)
    b.add_argument("--source-prefix", required=True)
    b.add_argument("--output-prefix", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--source-prefix", required=True)
    r.add_argument("--output-prefix", required=True)
    r.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    r.add_argument("--years", type=int, default=2)
    s = sub.add_parser("stations")
    s.add_argument("--source-path", required=True)
    s.add_argument("--output-path", required=True)
    t = sub.add_parser("star")
    t.add_argument("--observations", required=True)
    t.add_argument("--stations", required=True)
    t.add_argument("--warehouse", required=True)
    t.add_argument("--target", default="dev")
    return p


def main(argv: list[str] | None = None) -> dict:
    args, _unknown = _parser().parse_known_args(argv)  # platforms may append their own arguments
    spark = SparkSession.builder.appName(f"wxstar-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if args.job == "ingest-year":
        years = [args.year]
        clean, quarantine = jobs.ingest_year(spark, args.source_prefix, args.output_prefix, args.year)
    elif args.job == "backfill":
        years = range(args.first, args.last + 1)
        clean, quarantine = jobs.backfill(spark, args.source_prefix, args.output_prefix, args.first, args.last)
    elif args.job == "refresh":
        as_of = args.as_of or dt.datetime.now(dt.timezone.utc).date()
        years = jobs.refresh_window(as_of, args.years)
        clean, quarantine = jobs.rolling_refresh(spark, args.source_prefix, args.output_prefix, as_of, args.years)
    elif args.job == "stations":
        jobs.build_stations(spark, args.source_path, args.output_path)
        return {"stations": args.output_path}
    else:
        built = jobs.build_star_schema(spark, args.observations, args.stations, args.warehouse, args.target)
        failing = built["data_tests"].filter("failures > 0")
        failing.show(truncate=False)  # the test report is the job's output
        return {"warehouse": args.warehouse}
    jobs.run_metrics(spark, clean, quarantine, years).show()
    return {"clean": clean, "quarantine": quarantine}


if __name__ == "__main__":
    main(sys.argv[1:])
