"""Run one job: ``spark-submit`` this file or ``python -m gridlake JOB --root PATH ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from gridlake.plans import jobs, late
from gridlake.schemas import FUEL, GRID_LOOKBACK_DAYS, PLANNING_LOOKBACK_DAYS, REGION, SPECS
from gridlake.session import build_session
from gridlake.sources import versions
from gridlake.sources.tables import export_csv, stages
from gridlake.streaming.ingest import read_topic


def instant(text: str) -> datetime:
    """ISO text to a UTC instant without offset."""
    value = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="gridlake", description=__doc__)
    subs = main.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, start: bool = True, end: bool = True):
        sub = subs.add_parser(name, help=about)
        sub.add_argument("--root", required=True, help="root folder of all tables")
        if start:
            sub.add_argument("--start", type=instant, help="inclusive UTC start of the window")
        if end:
            sub.add_argument("--end", type=instant, help="exclusive UTC end of the window")
        return sub

    ingest = job("ingest", "topic to Bronze", start=False, end=False)
    ingest.add_argument("--topic", required=True)
    ingest.add_argument("--servers", default="kafka:9092")
    ingest.add_argument("--starting-offsets", default="earliest")
    ingest.add_argument("--max-offsets-per-trigger", default="5000000")
    ingest.add_argument("--replay-window", help="drop events replayed within it early: '2 hours'")

    clean = job("clean", "Bronze to Silver")
    clean.add_argument("--dataset", choices=sorted(SPECS), help="default: all datasets")
    clean.add_argument("--validation-only", action="store_true")

    curate = job("curate-hourly", "Silver to hourly facts and dimensions")
    curate.add_argument("--dataset", choices=["all", FUEL, REGION], default="all")
    job("curate-power", "Silver to the monthly power fact")
    job("region-daily", "daily demand mart")
    grid = job("grid-operations", "grid status and alert marts", start=False)
    grid.add_argument("--lookback-days", type=int, default=GRID_LOOKBACK_DAYS)
    grid.add_argument("--drop-unmeasured", action="store_true")
    planning = job("resource-planning", "daily planning mart", start=False)
    planning.add_argument("--lookback-days", type=int, default=PLANNING_LOOKBACK_DAYS)
    job("power-monthly", "monthly power mart")
    window = job("run-window", "all layers of one window, and older days its rows change")
    window.add_argument("--dataset", choices=sorted(SPECS), nargs="+", default=[REGION, FUEL])
    late_rows = job("late-rows", "marts of days whose facts have changed", start=False, end=False)
    late_rows.add_argument("--lookback-days", type=int, default=GRID_LOOKBACK_DAYS)
    expired = job("expire-versions", "forget old versions of a table", start=False, end=False)
    expired.add_argument("--table", required=True, help="path below the root")
    expired.add_argument("--keep", type=int, default=10)
    verify = job("verify-coverage", "hourly coverage", start=False)
    verify.add_argument("--dataset", choices=sorted(SPECS), required=True)
    verify.add_argument("--recount", action="store_true", help="count all of Bronze again")
    repairs = job("choose-repairs", "hour windows to fetch again, as CSV", start=False)
    repairs.add_argument("--dataset", choices=sorted(SPECS), required=True)
    repairs.add_argument("--open-jobs", help="parquet: dataset_id, hour_start_utc, status")
    repairs.add_argument("--statuses", nargs="+", default=["missing"])
    repairs.add_argument("--max-open", type=int, default=0, help="0: no limit")
    repairs.add_argument("--output", required=True)
    compare = job("compare", "keys of freshly fetched rows against all layers, as CSV")
    compare.add_argument("--dataset", choices=sorted(SPECS), required=True)
    compare.add_argument("--raw", required=True, help="parquet with the columns of Bronze")
    compare.add_argument("--output", required=True)
    return main


OPEN_JOBS = "dataset_id string, hour_start_utc timestamp, status string"


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"gridlake-{args.job}")
    lake = jobs.Lake(args.root.rstrip("/"))
    with stages(spark):
        if args.job == "ingest":
            stream = read_topic(
                spark,
                args.servers,
                args.topic,
                args.starting_offsets,
                maxOffsetsPerTrigger=args.max_offsets_per_trigger,
            )
            jobs.ingest_topic(stream, lake, args.topic, args.replay_window)
        elif args.job == "clean":
            for dataset in [args.dataset] if args.dataset else SPECS:
                jobs.clean_dataset(
                    spark, lake, dataset, args.start, args.end, args.validation_only
                )
        elif args.job == "curate-hourly":
            jobs.curate_hourly(spark, lake, args.dataset, args.start, args.end)
        elif args.job == "curate-power":
            jobs.curate_power(spark, lake, args.start, args.end)
        elif args.job == "region-daily":
            jobs.build_region_daily(spark, lake, args.start, args.end)
        elif args.job == "grid-operations":
            jobs.build_grid_operations(
                spark, lake, args.end, args.lookback_days, drop_unmeasured=args.drop_unmeasured
            )
        elif args.job == "resource-planning":
            jobs.build_resource_planning(spark, lake, args.end, args.lookback_days)
        elif args.job == "power-monthly":
            jobs.build_power_monthly(spark, lake, args.start, args.end)
        elif args.job == "run-window":
            if args.start is None or args.end is None:
                raise SystemExit("run-window needs --start and --end")
            late.run_window(spark, lake, args.start, args.end, args.dataset)
        elif args.job == "late-rows":
            late.propagate(spark, lake, days=args.lookback_days)
        elif args.job == "expire-versions":
            versions.expire(spark, f"{lake.root}/{args.table}", args.keep)
        elif args.job == "verify-coverage":
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            jobs.verify_coverage(
                spark, lake, args.dataset, args.end or now, recount=args.recount
            )
        elif args.job == "choose-repairs":
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            open_jobs = (
                spark.read.parquet(args.open_jobs)
                if args.open_jobs
                else spark.createDataFrame([], OPEN_JOBS)
            )
            chosen = jobs.choose_repairs(
                spark, lake, args.dataset, args.end or now, open_jobs, args.statuses, args.max_open
            )
            export_csv(chosen, args.output)
        elif args.job == "compare":
            raw = spark.read.parquet(args.raw)
            compared = jobs.compare_layers(spark, lake, args.dataset, raw, args.start, args.end)
            export_csv(compared, args.output)

if __name__ == "__main__":
    main()
