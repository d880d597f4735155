"""Command line for the pipelines (the load / ``migrate`` mode switch).

    python -m tablepipe.jobs bike_trips load <csv> <target> [--snapshot PATH]
    python -m tablepipe.jobs bike_trips migrate <snapshot> <target>
    python -m tablepipe.jobs stop_times load <json> <target> <day> [--snapshot ROOT]
    python -m tablepipe.jobs stop_times migrate <parquet> <target>
    python -m tablepipe.jobs requests_311 <source> <out_csv> [--as-of YYYY-MM-DD]
    python -m tablepipe.jobs catalog_report [--out PATH]

The session comes from ``spark-submit`` (or a local one when run directly).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from tablepipe.session import apply_defaults, ensure_checkpoint_dir


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m tablepipe.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    b = sub.add_parser("bike_trips")
    b.add_argument("mode", choices=["load", "migrate"])
    b.add_argument("source")
    b.add_argument("target")
    b.add_argument("--snapshot")
    s = sub.add_parser("stop_times")
    s.add_argument("mode", choices=["load", "migrate"])
    s.add_argument("source")
    s.add_argument("target")
    s.add_argument("day", nargs="?")
    s.add_argument("--snapshot")
    r = sub.add_parser("requests_311")
    r.add_argument("source")
    r.add_argument("out")
    r.add_argument("--as-of")
    c = sub.add_parser("catalog_report")
    c.add_argument("--out")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"tablepipe-{args.job}").getOrCreate()
    apply_defaults(spark)
    ensure_checkpoint_dir(spark)
    if args.job == "bike_trips":
        from tablepipe.jobs import bike_trips

        if args.mode == "migrate":
            bike_trips.migrate(spark, args.source, args.target)
        else:
            bike_trips.run(spark, args.source, args.target, snapshot_path=args.snapshot)
    elif args.job == "stop_times":
        from tablepipe.jobs import stop_times

        if args.mode == "migrate":
            stop_times.migrate(spark, args.source, args.target)
        else:
            day = args.day or (dt.date.today() - dt.timedelta(days=1)).isoformat()  # yesterday
            stop_times.run(spark, args.source, args.target, day, snapshot_root=args.snapshot)
    elif args.job == "requests_311":
        from tablepipe.jobs import requests_311

        as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else None
        requests_311.run(spark, args.source, args.out, as_of=as_of)
    elif args.job == "catalog_report":
        from tablepipe.jobs import catalog_report

        catalog_report.run(spark, out_path=args.out).show(truncate=False)


if __name__ == "__main__":
    main()
