"""Command line for spark-submit: ``python -m candlewick <command> --landing <folder> [options]``."""

from __future__ import annotations

import argparse
from datetime import date

from candlewick.plans import bronze, build
from candlewick.plans.drift import landing_drift
from candlewick.session import build_session
from candlewick.sources import TABLES
from candlewick.streaming import stream_table


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="candlewick")
    commands = ("load", "stream", "reload", "verify", "build", "report", "freshness", "promote", "drift")
    parser.add_argument("command", choices=commands)
    parser.add_argument("--landing", required=True, help="landing folder of this environment")
    parser.add_argument("--bronze", default="bronze", help="schema of the typed tables")
    parser.add_argument("--silver", default="silver", help="schema of the cleaned tables")
    parser.add_argument("--gold", default="gold", help="schema of dimensions and facts")
    parser.add_argument("--policy", choices=("first_wins", "latest_wins"), default="first_wins")
    parser.add_argument("--since", type=date.fromisoformat, help="first landing day to read")
    parser.add_argument("--ticker-buckets", type=int, help="store the bars in buckets per ticker")
    parser.add_argument("--checkpoint", help="folder for stream checkpoints")
    parser.add_argument("--from-landing", help="landing folder to promote from")
    return parser.parse_args()


def main() -> int:
    args = _arguments()
    spark = build_session()
    lake = build.Lake(args.landing, args.bronze, args.silver, args.gold, args.ticker_buckets)
    for schema in (args.bronze, args.silver, args.gold):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    load = {"landing_root": args.landing, "schema": args.bronze}
    failed = False
    if args.command == "load":
        print(bronze.load_bronze(spark, **load, policy=args.policy, since=args.since))
    elif args.command == "stream":
        for table in TABLES:
            stream_table(
                spark,
                table,
                landing_root=args.landing,
                target=f"{args.bronze}.{table}",
                checkpoint=f"{args.checkpoint}/{table}",
                policy=args.policy,
            ).awaitTermination()
    elif args.command == "reload":
        print(bronze.reload_bronze(spark, **load))
    elif args.command == "verify":
        result = bronze.verify_incremental(spark, **load)
        result.show(truncate=False)
        failed = not result.filter("status != 'ok'").isEmpty()
    elif args.command == "build":
        build.build(spark, lake)
    elif args.command == "report":
        result = build.quality_report(spark, lake).unionByName(build.landing_rejects(spark, lake))
        result.show(1000, truncate=False)
        failed = not result.filter("status = 'fail'").isEmpty()
    elif args.command == "freshness":
        build.freshness_report(spark, lake).show(truncate=False)
    elif args.command == "drift":
        result = landing_drift(spark, args.landing).filter("status != 'ok'").orderBy("source", "path", "landed")
        result.show(1000, truncate=False)
        failed = not result.filter("status = 'lost'").isEmpty()
    elif args.command == "promote":
        source = build.Lake(args.from_landing)
        since = args.since and args.since.isoformat()
        print(build.promote_and_load(spark, source, lake, since=since))
    return int(failed)


if __name__ == "__main__":
    raise SystemExit(main())
