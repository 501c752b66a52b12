"""Command line for the scheduled jobs: ``python -m airshed <job> --warehouse … [options]`` (or spark-submit).

  load-flights       --lake DIR --direction arrival|departure [--day YYYY-MM-DD | --lag-days 4]
  ingest-flights     --lake DIR --direction arrival|departure --progress DIR
  load-observations  --payloads DIR --kind pollution|weather [--history DIR] [--coordinates FILE_DIR]
  import-history     --history DIR --kind pollution|weather
  load-road          --lake DIR [--glob PATTERN | --day YYYY-MM-DD] [--lenient] [--reload]
  load-airports      --airports DIR
  refresh            --views DIR [--since YYYY-MM-DD]

Checkpoints and staged tables go to spark.checkpoint.dir, or to --checkpoint-dir where the cluster sets none (by default
a folder in the warehouse). Each job prints one JSON line with what it did (small counts only).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from airshed.plans import jobs
from airshed.plans.planning import target_day
from airshed.session import build_session, shuffle_partitions_for


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m airshed")
    p.add_argument("--warehouse", required=True, help="folder holding the warehouse tables")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit / the cluster)")
    p.add_argument("--shuffle-bytes", type=int, default=None,
                   help="expected shuffle volume; sizes spark.sql.shuffle.partitions for ~256 MB partitions")
    p.add_argument("--local", action="store_true", help="skip the cluster sizing profile")
    p.add_argument("--checkpoint-dir", default=None,
                   help="shared folder for checkpoints where spark.checkpoint.dir is unset (default: in the warehouse)")
    sub = p.add_subparsers(dest="job", required=True)
    f = sub.add_parser("load-flights")
    f.add_argument("--lake", required=True)
    f.add_argument("--direction", choices=["arrival", "departure"], required=True)
    f.add_argument("--day")
    f.add_argument("--lag-days", type=int, default=None, help="load today minus N days (flights: 4)")
    i = sub.add_parser("ingest-flights")
    i.add_argument("--lake", required=True)
    i.add_argument("--direction", choices=["arrival", "departure"], required=True)
    i.add_argument("--progress", required=True, help="folder that remembers which files were loaded")
    o = sub.add_parser("load-observations")
    o.add_argument("--payloads", required=True)
    o.add_argument("--kind", choices=["pollution", "weather"], required=True)
    o.add_argument("--history")
    o.add_argument("--coordinates", help="folder with the city-coordinates config JSON")
    h = sub.add_parser("import-history")
    h.add_argument("--history", required=True)
    h.add_argument("--kind", choices=["pollution", "weather"], required=True)
    r = sub.add_parser("load-road")
    r.add_argument("--lake", required=True)
    r.add_argument("--glob", default="*.json")
    r.add_argument("--day", help="files with this day in their name")
    r.add_argument("--lenient", action="store_true", help="report bad records instead of refusing the load")
    r.add_argument("--reload", action="store_true", help="replace the table instead of appending")
    r.add_argument("--name", help="name of the load: run again, it replaces what it had added")
    a = sub.add_parser("load-airports")
    a.add_argument("--airports", required=True)
    v = sub.add_parser("refresh")
    v.add_argument("--views", required=True)
    v.add_argument("--since")
    v.add_argument("--changed", action="store_true", help="only the days that loads touched since the last refresh")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    partitions = shuffle_partitions_for(args.shuffle_bytes) if args.shuffle_bytes else None
    spark = build_session(args.master, app_name=f"airshed-{args.job}", shuffle_partitions=partitions,
                          cluster=not args.local,
                          checkpoint_dir=args.checkpoint_dir or f"{args.warehouse.rstrip('/')}/_checkpoints")
    wh = jobs.Warehouse(args.warehouse)
    out: dict = {"job": args.job}
    load = None
    if args.job == "load-flights":
        day = args.day or (target_day(dt.date.today(), args.lag_days) if args.lag_days is not None else None)
        load = jobs.load_flights(spark, wh, args.lake, args.direction, day=day)
        out.update(day=day)
    elif args.job == "ingest-flights":
        jobs.ingest_flights(spark, wh, args.lake, args.progress, args.direction)
    elif args.job == "load-observations":
        coords = None
        if args.coordinates:
            from airshed.sources.lake import read_city_coordinates
            coords = read_city_coordinates(spark, args.coordinates)
        load = jobs.load_observations(spark, wh, args.payloads, args.kind, history_dir=args.history, coordinates=coords)
    elif args.job == "import-history":
        load = jobs.import_history(spark, wh, args.history, args.kind)
    elif args.job == "load-road":
        load = jobs.load_road(spark, wh, args.lake, glob=args.glob, strict=not args.lenient, day=args.day,
                              reload=args.reload, name=args.name)
    elif args.job == "load-airports":
        load = jobs.load_airports(spark, wh, args.airports)
    elif args.job == "refresh":
        report = jobs.refresh_changed(spark, wh, args.views) if args.changed else \
            jobs.refresh_all(spark, wh, args.views, since=args.since)
        out.update(refreshed=report.refreshed, failed=report.failed, error=report.error)
        if not report.ok:
            print(json.dumps(out))
            return 1
    if load is not None:
        out.update(stats={r["reason"]: r["n"] for r in load.stats().collect()})
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
