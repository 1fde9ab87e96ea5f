"""Command line: ``spark-submit run_job.py <job> ...`` or ``python -m stoploom.jobs <job> ...``.

    merge          ROOT TARGET      merge a snapshot tree into tables
    routes         DATASET          distinct routes per bus feed
    stops          DATASET          disconnected stops per feed
    waiting-time   DATASET          waiting time per route
    day-type       DATASET          average trips by day type
    intervals      DATASET          gaps between departures
    quality        DATASET          counts of rejected service windows
    rejected       DATASET          rejected service windows

Reports go to ``--database``, to ``--out`` or, without either, to the console (its first rows).
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stoploom.plans import analyses, schedule
from stoploom.plans.merge import merge_schedule
from stoploom.sinks.writers import publish
from stoploom.sources.tables import read_table


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stoploom", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    merge = jobs.add_parser("merge")
    merge.add_argument("root")
    merge.add_argument("target")
    merge.add_argument("--feed", action="append", help="repeatable; default: the known feeds")
    merge.add_argument("--all-feeds", action="store_true")
    merge.add_argument("--first-day", default=schedule.FIRST_DAY)
    merge.add_argument("--last-day", default=schedule.LAST_DAY)
    merge.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    merge.add_argument("--only-touched", action="store_true", help="keep folders of other dates")

    def report(name: str) -> argparse.ArgumentParser:
        job = jobs.add_parser(name)
        job.add_argument("dataset")
        job.add_argument("--format", choices=("parquet", "csv"), default="parquet")
        job.add_argument("--database", help="save there; it must exist unless --out is given")
        job.add_argument("--out", help="folder for the result as CSV: one file, or a file a task for intervals and rejected")
        return job

    report("routes")
    report("stops").add_argument(
        "--shared", choices=("owner", "each", "exclude"), default="owner"
    )
    waiting = report("waiting-time")
    waiting.add_argument("--feed", default=schedule.TRAIN_FEED)
    waiting.add_argument("--by-snapshot", action="store_true")
    waiting.add_argument("--dash", action="store_true", help="blanks in names as dashes")
    report("intervals").add_argument("--feed", default=schedule.TRAIN_FEED)
    report("quality")
    report("rejected")
    day_type = report("day-type")
    day_type.add_argument("--rounding", choices=("truncate", "half_up"), default="truncate")
    day_type.add_argument("--wide", action="store_true", help="a column per day type")
    day_type.add_argument("--fill", type=int, help="value for absent day types, with --wide")
    return parser


def _report(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, str]:
    def table(name: str) -> DataFrame:
        return read_table(spark, args.dataset, name, args.format)

    if args.job == "routes":
        return analyses.routes_per_feed(table("routes")), schedule.ROUTES_TABLE
    if args.job == "stops":
        result = analyses.disconnected_stops(table("stops"), shared=args.shared)
        return result, schedule.STOPS_TABLE
    if args.job == "waiting-time":
        result = analyses.waiting_time(
            table("routes"), table("trips"), table("stop_times"), args.feed, args.by_snapshot, args.dash
        )
        return result, schedule.WAITING_TABLE
    if args.job == "intervals":
        result = analyses.departure_intervals(table("routes"), table("trips"), table("stop_times"), args.feed)
        return result, schedule.INTERVALS_TABLE
    if args.job == "quality":
        return analyses.service_quality(table("frequencies")), schedule.QUALITY_TABLE
    if args.job == "rejected":
        return analyses.rejected_service(table("frequencies")), schedule.REJECTED_TABLE
    if args.wide:
        result = analyses.average_trips_wide(table("frequencies"), args.rounding, fill=args.fill)
    else:
        result = analyses.average_trips(table("frequencies"), args.rounding)
    return result, schedule.DAY_TYPE_TABLE


def main(argv: Sequence[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"stoploom {args.job}").getOrCreate()
    if args.job == "merge":
        feeds = None if args.all_feeds else (args.feed or schedule.FEEDS)
        merge_schedule(
            spark,
            args.root,
            args.target,
            feeds=feeds,
            first_day=args.first_day,
            last_day=args.last_day,
            fmt=args.format,
            only_touched=args.only_touched,
        )
    else:
        result, name = _report(spark, args)
        publish(result, name, args.database, args.out, one_file=args.job not in ("intervals", "rejected"))


if __name__ == "__main__":
    main()
