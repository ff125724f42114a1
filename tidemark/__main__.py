"""Command line: create tables, run the streams, backfill, check quality, show newest rows.

    spark-submit --packages <kafka and avro connectors> -m tidemark stream \\
        --root s3a://lake --servers broker:9092
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timedelta

from tidemark import schemas
from tidemark.operators.serving import LATEST, latest
from tidemark.plans import catalog
from tidemark.plans.backfill import backfill
from tidemark.plans.lake import Lake, in_zone
from tidemark.plans.quality import record
from tidemark.session import build_session
from tidemark.sources import kafka_feed, open_feed
from tidemark.streaming import jobs
from tidemark.streaming.accounts import BatchLog, totals


def writer_schemas(path: str) -> dict[int, str]:
    """Writer schemas by registry id, from a JSON file of ``{"id": schema}``."""
    with open(path, encoding="utf-8") as file:
        return {int(number): json.dumps(schema) for number, schema in json.load(file).items()}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the lake on shared storage")
        sub.add_argument("--zone", default=schemas.LOCAL_ZONE, help="zone of stored times")
        return sub

    command("create", "create databases, tables and views that do not exist")
    for name, text in (("stream", "run the streaming jobs"),
                       ("backfill", "append a bounded range of the feeds")):
        sub = command(name, text)
        sub.add_argument("--servers", required=True, help="broker addresses")
        sub.add_argument("--feeds", nargs="+", choices=list(schemas.TOPICS),
                         default=["orders", "payments", "refunds", "ticks"])
        sub.add_argument("--files-per-batch", type=int,
                         help="hash raw rows over this many files per batch")
        sub.add_argument("--min-partitions", type=int, help="split topic partitions into tasks")
        sub.add_argument("--writers", type=writer_schemas, metavar="JSON",
                         help="file with the writer schemas by registry id")
        if name == "stream":
            sub.add_argument("--max-offsets", type=int, default=1_000_000,
                             help="messages per micro-batch at most")
            sub.add_argument("--state-partitions", type=int,
                             help="partitions of window state; fixed by the first start")
            sub.add_argument("--generation", default="",
                             help="name of a new start, which reads the feeds from the beginning")
        else:
            sub.add_argument("--slack-minutes", type=int, default=60,
                             help="how far event times may lie from record times; -1 reads the "
                                  "whole topic")
            sub.add_argument("--max-strays", type=int,
                             help="fail when more records lie further apart than that")
            sub.add_argument("--run", required=True, help="name; repeating it adds nothing")
            sub.add_argument("--start", type=datetime.fromisoformat)
            sub.add_argument("--end", type=datetime.fromisoformat)
    sub = command("check", "run the quality suites and keep the results")
    sub.add_argument("--run-id", type=int, required=True)
    command("accounts", "show what the streaming jobs took, left out and dropped")
    sub = command("latest", "show the newest rows of a table")
    sub.add_argument("--table", choices=list(LATEST), required=True)
    sub.add_argument("--as-of", help="time with zone, as 2026-03-13 12:00:00 Asia/Seoul")
    sub = command("snapshots", "list the commits of a table")
    sub.add_argument("--table", choices=list(schemas.TABLE_DDL), required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session()
    lake = Lake(spark, args.root.rstrip("/"), args.zone,
                getattr(args, "files_per_batch", None))
    if args.command == "create":
        catalog.create_tables(lake)
    elif args.command == "stream":
        if args.state_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", args.state_partitions)
        with BatchLog(lake) as log:
            jobs.await_all(jobs.start_all({
                feed: lambda feed=feed: open_feed(kafka_feed(
                    spark, feed, args.servers, max_offsets=args.max_offsets,
                    min_partitions=args.min_partitions), feed, writers=args.writers)
                for feed in args.feeds
            }, lake, generation=args.generation, counted=True), log=log)
    elif args.command == "backfill":
        start, end = (t and in_zone(t, lake.zone) for t in (args.start, args.end))
        bounded = args.slack_minutes >= 0
        slack = timedelta(minutes=args.slack_minutes if bounded else 0)
        backfill(lake, {
            feed: open_feed(kafka_feed(
                spark, feed, args.servers, streaming=False, start=start, end=end,
                slack=slack if bounded else None,
                min_partitions=args.min_partitions), feed, writers=args.writers,
                record_time=bounded)
            for feed in args.feeds
        }, args.run, start, end, slack, args.max_strays).show(truncate=False)
    elif args.command == "check":
        success = record(lake, args.run_id)
        print(f"success={success}")
        return 0 if success else 1
    elif args.command == "latest":
        rows = lake.newest(args.table, LATEST[args.table][1], args.as_of)
        latest(rows, args.table).show(LATEST[args.table][1], False)
    elif args.command == "accounts":
        totals(lake).orderBy("job").show(1000, False)  # a row per job
    else:
        for row in lake.snapshots(args.table).toLocalIterator():  # all of them, never at once
            print(*row, sep="\t")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
