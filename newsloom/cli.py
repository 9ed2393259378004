"""Command line of the jobs, for ``spark-submit``.

Topics are Kafka topics when ``--servers`` is given, else folders of JSON-lines
files with the envelope columns. Defaults come from environment variables of
the same meaning, so jobs can be configured without arguments.
"""

from __future__ import annotations

import argparse
import os
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from newsloom.plans.jobs import backfill, backfill_report, crawled, positive
from newsloom.session import configure
from newsloom.sources import documents, feeds, messages, tables, topics
from newsloom.streaming import jobs


def positive_int(text: str) -> int:
    try:
        return positive(int(text), "value")
    except ValueError as error:
        raise argparse.ArgumentTypeError(str(error)) from error


def parser() -> argparse.ArgumentParser:
    env = os.environ.get
    main = argparse.ArgumentParser(prog="newsloom")
    commands = main.add_subparsers(dest="command", required=True)

    crawl = commands.add_parser("crawl", help="feed documents to raw_news")
    crawl.add_argument("--mode", choices=jobs.MODES, default=env("CRAWLER_MODE", "realtime"))
    crawl.add_argument("--feeds", default=env("FEEDS_CONFIG_PATH", "feeds.yaml"), help="feed registry, YAML or JSON")
    crawl.add_argument("--documents", required=True, help="landing folder of fetched documents")
    crawl.add_argument("--per-feed-limit", type=positive_int, help="[backfill] articles per feed")
    crawl.add_argument("--total-limit", type=positive_int, help="[backfill] articles over all feeds")
    crawl.add_argument("--days", type=positive_int, help="[backfill] age limit; articles without a time are kept")
    crawl.add_argument("--skip-report", action="store_true", help="[backfill] no counters, which read the documents again")
    crawl.add_argument("--startup-ts", type=int, help="[realtime] oldest publish time (default: when the job first began)")
    crawl.add_argument("--seen", help="[realtime] table of registered urls, read at the first start and added to")
    crawl.add_argument("--report", help="[backfill] folder for the counters of every feed")
    crawl.add_argument("--window", type=positive_int, default=int(env("CRAWLER_STATE_MAX_URLS", jobs.CRAWLER_WINDOW)))

    process = commands.add_parser("process", help="raw_news to processed_news")
    process.add_argument("--quarantine", required=True, help="folder for messages that cannot be processed")
    process.add_argument("--window", type=int, default=int(env("DEDUP_WINDOW_SIZE", jobs.PROCESSOR_WINDOW)),
                         help="hashes remembered; 0 remembers all")
    alt = commands.add_parser("alt-process", help="raw_news to processed_news, scored rules")
    alt.add_argument("--quarantine", help="folder for messages that cannot be taken; without it they are left out")

    store = commands.add_parser("store", help="processed_news to the storage table")
    store.add_argument("--warehouse", default=env("ICEBERG_WAREHOUSE"), required="ICEBERG_WAREHOUSE" not in os.environ)
    store.add_argument("--namespace", default=env("ICEBERG_NAMESPACE", "news"))
    store.add_argument("--table", default=env("ICEBERG_TABLE", "processed_news"))
    store.add_argument("--catalog", default=env("ICEBERG_CATALOG_NAME"))
    store.add_argument("--catalog-uri", default=env("ICEBERG_CATALOG_URI"), help="address of the REST catalog")
    store.add_argument("--endpoint", default=env("S3_ENDPOINT"), help="address of the object store")
    store.add_argument("--region", default=env("AWS_REGION", "us-east-1"))
    store.add_argument("--flush-messages", type=positive_int, default=jobs.STORE_BATCH, help="[Kafka, --every] messages of a full batch")
    store.add_argument("--format", choices=("parquet", "iceberg"), default="parquet")

    alert = commands.add_parser("alert", help="processed_news to the alert outbox")
    alert.add_argument("--mode", choices=jobs.MODES, default=env("CRAWLER_MODE", "realtime"))
    alert.add_argument("--pace", type=float, help="[Kafka] seconds between messages, at least; the job runs on")
    alert.add_argument("--all", action="store_true", help="also articles whose feed rules do not ask for an alert")
    alert.add_argument("--shared-progress", action="store_true", help="one progress for both modes")

    for command in (crawl, process, alt, store, alert):
        command.add_argument("--servers", default=env("KAFKA_BOOTSTRAP_SERVERS"), help="Kafka bootstrap servers")
        command.add_argument("--every", help="trigger interval such as '60 seconds'; without it the job ends when done")
        command.add_argument("--name", default=command.prog.split()[-1], help="query name; names its progress")
    for command in (process, alt, store, alert):
        command.add_argument("--input", required=True, help="topic or folder")
        command.add_argument("--starting", choices=("earliest", "latest"), help="[Kafka] where a new query begins")
    for command in (crawl, process, alt, store, alert):
        command.add_argument("--max-per-trigger", type=positive_int, help="messages (Kafka) or files a batch")
    for command in (process, crawl):
        command.add_argument("--buckets", type=positive_int, default=1, help="parallel parts of the dedup window")
    for command in (crawl, process, alt, alert):
        command.add_argument("--output", required=True, help="topic or folder")
    return main


def source(spark: SparkSession, args: argparse.Namespace, starting: str = "earliest") -> DataFrame:
    if args.servers:
        return topics.kafka_stream(spark, args.servers, args.input, args.starting or starting, args.max_per_trigger)
    return topics.file_stream(spark, args.input, args.max_per_trigger)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    configure(spark)
    where = {"out": args.output, "servers": args.servers} if args.command != "store" else {}
    progress = jobs.Run(args.name, jobs.shared_dir(spark), args.every)
    if args.command == "crawl":
        registry = feeds.load_feeds(spark, args.feeds)
        if args.mode == "backfill":
            limits = (args.per_feed_limit, args.total_limit, args.days)
            docs, now = documents.read_documents(spark, args.documents), int(time.time())
            rows = crawled(docs, registry)
            sent = messages.to_messages(backfill(docs, registry, *limits, now=now, rows=rows).drop("feed_ord", "entry_pos", "feed_pos"), "id")
            if args.servers:
                topics.write_kafka(sent, args.servers, args.output)
            else:
                topics.write_files(sent, args.output, topics.writer_number(spark, args.output))
            if args.skip_report:
                return
            report = args.report or f"{progress.folder}/reports/{args.name}-{now}"
            backfill_report(docs, registry, *limits, now=now, rows=rows).write.mode("overwrite").json(report)
            print(f"counters of every feed: {report}")
            return
        docs = documents.read_documents(spark, args.documents, stream=True, max_files=args.max_per_trigger)
        startup = jobs.startup_time(spark, progress, args.startup_ts)
        # The window of a new query begins with the urls of earlier ones.
        seen = tables.load_seen(spark, args.seen, args.window) if args.seen else None
        queries = [jobs.start_crawler(docs, registry, run=progress, startup_ts=startup, window=args.window,
                                      buckets=args.buckets, seen=seen, save_seen=args.seen, **where)]
    elif args.command == "process":
        stream = source(spark, args)
        queries = [jobs.start_processor(stream, run=progress, quarantine=args.quarantine, window=args.window or None, buckets=args.buckets, **where)]
    elif args.command == "alt-process":
        queries = [jobs.start_alt_processor(source(spark, args), run=progress, quarantine=args.quarantine, **where)]
    elif args.command == "store":
        if args.servers and args.every and not args.max_per_trigger:
            args.max_per_trigger = args.flush_messages
        config = tables.TableConfig(args.warehouse, args.namespace, args.table, args.catalog, args.format,
                                    args.catalog_uri or "", args.endpoint or "", args.region)
        for key, value in config.catalog_conf().items():
            spark.conf.set(key, value)
        table = tables.create_table(spark, config)
        queries = [jobs.start_store(source(spark, args), table, progress, args.format == "iceberg")]
    else:
        if args.pace:
            every, most = jobs.alert_pace(args.pace)
            progress, args.max_per_trigger = replace(progress, every=every), most
        scoped = jobs.scoped(progress, args.mode, not args.shared_progress)
        stream = source(spark, args, jobs.starting_offsets(args.mode))
        queries = [jobs.start_alerts(stream, run=scoped, only_matched=not args.all, **where)]
    for query in queries:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(SparkSession.builder.appName(f"newsloom-{args.command}").getOrCreate(), args)


if __name__ == "__main__":
    main()
