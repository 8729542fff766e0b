"""Command line: the monthly run, or its steps, with typed parameters.

    python -m tripmart run-month --root s3a://lake --env DEV \\
        --file s3a://inbound/yellow_tripdata_2025-01.parquet --year 2025 --month 1 \\
        [--zones s3a://inbound/taxi_zone_lookup.csv] [--mode safe|reference] \\
        [--reset] [--full-refresh] [--no-export] [--quality raise|report|skip] \\
        [--casts ansi|try] [--duplicates keep|first|error] [--seeds DIR]
    python -m tripmart ingest  --root ... --env ... --file ... --year ... --month ... [--zones CSV] [--reset] [--casts ...]
    python -m tripmart build   --root ... --env ... [--select MART ...] [--mode ...] [--full-refresh] [--quality ...] ...
    python -m tripmart test    --root ... --env ... [--quality raise|report]
    python -m tripmart export  --root ... --env ... --year 2025 --month 1
"""

from __future__ import annotations

import argparse
import json
import sys


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tripmart")
    sub = parser.add_subparsers(dest="command", required=True)
    steps = {
        "run-month": "ingest one monthly file, build, check and export",
        "ingest": "load one monthly file (and the zones) into the raw tables",
        "build": "build dimension, fact and marts, or only selected marts",
        "test": "run the declared checks over the published tables",
        "export": "export one month of the monthly zone mart",
    }
    p = {name: sub.add_parser(name, help=text) for name, text in steps.items()}
    for name, step in p.items():
        step.add_argument("--root", required=True)
        step.add_argument("--env", required=True)
        step.add_argument("--master", default=None)
        if name in ("run-month", "ingest", "export"):
            step.add_argument("--year", type=int, required=True)
            step.add_argument("--month", type=int, required=True)
        if name in ("run-month", "ingest"):
            step.add_argument("--file", required=True)
            step.add_argument("--zones", default=None)
            step.add_argument("--reset", action="store_true")
        if name in ("run-month", "build"):
            step.add_argument("--mode", choices=["safe", "reference"], default="safe")
            step.add_argument("--full-refresh", action="store_true")
            step.add_argument("--duplicates", choices=["keep", "first", "error"], default="keep")
        if name in ("run-month", "ingest", "build"):
            step.add_argument("--casts", choices=["ansi", "try"], default="ansi")
        if name in ("run-month", "build", "test"):
            step.add_argument("--quality", choices=["raise", "report", "skip"], default="raise")
            step.add_argument("--seeds", default=None)
    p["run-month"].add_argument("--no-export", action="store_true")
    p["build"].add_argument("--select", nargs="+", metavar="MART", default=None)
    return parser


def main(argv=None) -> int:
    args = _parser().parse_args(argv)

    from tripmart.plans import pipeline
    from tripmart.session import build_session

    spark = build_session(args.master) if args.master else build_session()
    layout = pipeline.Layout(args.root, args.env)
    out: dict = {}
    report: list | None = None
    if args.command == "run-month":
        report, out["exported"] = pipeline.run_month(
            spark, layout, args.file, args.year, args.month, zones_csv=args.zones, mode=args.mode,
            export=not args.no_export, quality_gate=args.quality, reset=args.reset,
            full_refresh=args.full_refresh, cast_mode=args.casts, dup_policy=args.duplicates, seed_dir=args.seeds)
    elif args.command == "ingest":
        if args.zones:
            pipeline.ingest_zones(spark, layout, args.zones)
        touched = pipeline.ingest_month(spark, layout, args.file, args.year, args.month, reset=args.reset,
                                        cast_mode=args.casts)
        out["months"] = [f"{y}-{m:02d}" for y, m in sorted(touched)]
    elif args.command == "build" and args.select:
        pipeline.build_marts(spark, layout, args.select)
        out["built"] = args.select
    elif args.command == "build":
        report = pipeline.build(spark, layout, mode=args.mode, quality_gate=args.quality, months=[],
                                full_refresh=args.full_refresh, cast_mode=args.casts, dup_policy=args.duplicates,
                                seed_dir=args.seeds)
    elif args.command == "test":
        report = pipeline.check_published(spark, layout, args.seeds, args.quality)
    else:
        out["exported"] = [pipeline.export_month_slice(spark, layout, args.year, args.month),
                           pipeline.export_csv(spark, layout, args.year, args.month)]
    if report is not None:
        out["checks"] = len(report)
        out["not_passing"] = [r.asDict() for r in report if r["status"] != "pass"]
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
