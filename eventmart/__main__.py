"""Run load jobs: ``python -m eventmart --root PATH [--layer L] [--step S] ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from eventmart.layout import Layout
from eventmart.plans.jobs import STEPS, run


def main() -> None:
    parser = argparse.ArgumentParser(prog="eventmart", description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the tables, on shared storage")
    parser.add_argument("--layer", choices=["all", *STEPS], default="all")
    parser.add_argument("--step", default="all", help="one step of the chosen layer")
    parser.add_argument("--events", nargs="+", help="event CSV files, for bronze")
    parser.add_argument("--sessions", nargs="+", help="session JSON files, for bronze")
    parser.add_argument("--json-lines", action="store_true", help="one session per line")
    parser.add_argument("--scope", choices=["batch", "touched"], default="batch")
    parser.add_argument("--null-safe", action="store_true", help="let NULL merge keys match")
    parser.add_argument("--rejects", action="store_true", help="set malformed lines aside, do not fail")
    parser.add_argument("--buckets", type=int, help="bucket count of every table")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("eventmart").getOrCreate()
    counts = run(
        spark,
        Layout(args.root, args.buckets),
        layer=args.layer,
        step=args.step,
        events_csv=args.events,
        sessions_json=args.sessions,
        json_lines=args.json_lines,
        scope=args.scope,
        null_safe=args.null_safe,
        rejects=args.rejects,
    )
    for name, merged in counts.items():
        print(f"{name}: {merged.rows_inserted} inserted, {merged.rows_updated} updated")


if __name__ == "__main__":
    main()
