"""The streaming jobs. Each takes an input stream and returns a started query.

A query's progress and state live in its checkpoint folder, below the shared
folder of the session; a restarted query goes on where it stopped. A failed
micro-batch is run again as a whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from newsloom.functions.once import computed
from newsloom.functions.text import url_fingerprint
from newsloom.operators.alerts import alert_outbox
from newsloom.operators.articles import Classifier, alt_candidates, alt_normalize, arrival_seconds, normalize
from newsloom.operators.outcomes import NO_TIME, OLD, PUBLISHED, REPEATED, realtime_outcome
from newsloom.operators.storage import storage_rows
from newsloom.session import shared_dir
from newsloom.sources import documents, messages, topics
from newsloom.sources.tables import append_batch
from newsloom.streaming.metrics import attach, observe_exits, observe_outcomes
from newsloom.streaming.state import (
    CRAWLER_WINDOW, LATENESS_SECONDS, PROCESSOR_WINDOW, first_position_stream, ttl_stream, window_stream,
)

# Crawl interval, writer batch, writer interval, seconds between alerts.
CRAWL_SECONDS = 60
STORE_BATCH = 100
STORE_SECONDS = 60
ALERT_SECONDS = 1.1
MODES = ("realtime", "backfill")

QUARANTINE = "topic string, partition int, offset bigint, value string, reason string"


def query_name(base: str, mode: str, scoped: bool = True) -> str:
    """Name of a reader per crawl mode, so that the modes keep separate progress."""
    if not scoped:
        return base
    suffix = "-" + (mode if mode in MODES else "realtime")
    return base if base.endswith(suffix) else base + suffix


def starting_offsets(mode: str) -> str:
    """A new realtime reader skips the backlog, a new backfill reader wants it."""
    return "earliest" if mode == "backfill" else "latest"


@dataclass(frozen=True)
class Run:
    """How a query runs: its name, where its checkpoint is and when it fires.

    ``every=None`` handles what is there and stops.
    """

    name: str
    folder: str
    every: str | None = None

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoints/{self.name}"

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        attach(writer._spark, f"{self.folder}/metrics")
        writer = writer.queryName(self.name).option("checkpointLocation", self.checkpoint)
        trigger = {"processingTime": self.every} if self.every else {"availableNow": True}
        return writer.trigger(**trigger).start()


def new_run(rows: DataFrame, name: str, every: str | None = None) -> Run:
    return Run(name, shared_dir(rows.sparkSession), every)


def writer_interval(seconds: int = STORE_SECONDS) -> str:
    """Trigger of the table writer. With ``maxOffsetsPerTrigger`` at the batch size a
    batch is written when it is full or the interval is over."""
    return f"{seconds} seconds"


def startup_time(spark: SparkSession, run: Run, given: int | None = None) -> int:
    """Start time of a query, kept beside its checkpoint: a restart gets the first one back."""
    path = f"{run.folder}/startup/{run.name}"
    try:
        return int(spark.read.text(path).first()[0])
    except AnalysisException:
        started = int(time.time()) if given is None else given
        spark.createDataFrame([(str(started),)], "value string").coalesce(1).write.text(path)
        return started


def alert_pace(interval: float = ALERT_SECONDS, trigger_seconds: int = 60) -> tuple[str, int]:
    """Trigger and ``maxOffsetsPerTrigger`` that keep at least ``interval`` seconds a message."""
    return f"{trigger_seconds} seconds", int(trigger_seconds / interval)


def _send(rows: DataFrame, out: str, key: str, servers: str | None, run: Run, json_columns: tuple[str, ...] = ()) -> DataStreamWriter:
    """Messages to the Kafka topic ``out``, or without servers to the file topic in that folder."""
    sent = messages.to_messages(rows, key, json_columns)
    if servers:
        return topics.kafka_sink(sent, servers, out)

    writer = topics.writer_number(rows.sparkSession, out, run.checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        topics.write_files(batch, out, writer, batch_id)

    return sent.writeStream.foreachBatch(write)


# Processing -------------------------------------------------------------------------------


def _unique(rows: DataFrame, window: int | None, buckets: int, passes: str | None = None) -> DataFrame:
    if window is None:
        return first_position_stream(rows, "raw_hash", passes=passes)
    return window_stream(rows, "raw_hash", size=window, buckets=buckets, passes=passes)


def _processed(unique: DataFrame, now: Column | None, classifier: Classifier | None) -> DataFrame:
    # The state functions see the message text only; it is parsed again behind them.
    return normalize(messages.unpacked(computed(unique, _m=F.parse_json("value"))), now=now, classifier=classifier)


def processed_stream(envelope: DataFrame, window: int | None = PROCESSOR_WINDOW, buckets: int = 1,
                     now: Column | None = None, classifier: Classifier | None = None) -> DataFrame:
    """processed_news rows of a raw_news stream. ``window=None`` remembers every hash."""
    keyed = messages.keyed(messages.parse_raw_news(envelope), "value")
    return _processed(_unique(keyed, window, buckets), now, classifier)


def quarantine_stream(envelope: DataFrame) -> DataFrame:
    return messages.quarantine(messages.parse_raw_news(envelope))


BAD = ("topic", "partition", "offset", "value", "reason")


def _two_exits(rows: DataFrame, process: Callable[[DataFrame], DataFrame], key: str, out: str, quarantine: str, run: Run,
               servers: str | None, json_columns: tuple[str, ...] = ()) -> StreamingQuery:
    """Good rows to the topic, bad ones to the quarantine folder: one read and one parse of the input, one batch number for both.

    A batch that runs again replaces its own folders in both.
    """
    spark = rows.sparkSession
    writer = None if servers else topics.writer_number(spark, out, run.checkpoint)
    bin_number = topics.writer_number(spark, quarantine, run.checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            bad = batch.filter("reason IS NOT NULL").select(*BAD)
            bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/writer-{bin_number:04d}-batch-{batch_id:012d}")
            good = batch.filter("reason IS NULL").drop(*[c for c in BAD if c != "value"])
            sent = messages.to_messages(process(good), key, json_columns)
            if servers:
                topics.write_kafka(sent, servers, out)
            else:
                topics.write_files(sent, out, writer, batch_id)
        finally:
            batch.unpersist()

    return run.start(rows.writeStream.foreachBatch(write))


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The bad messages of all batches."""
    return spark.read.schema(QUARANTINE).option("recursiveFileLookup", True).parquet(folder)


def start_processor(envelope: DataFrame, out: str, run: Run, servers: str | None = None, quarantine: str | None = None,
                    window: int | None = PROCESSOR_WINDOW, buckets: int = 1, now: Column | None = None,
                    classifier: Classifier | None = None) -> StreamingQuery:
    """raw_news envelope to processed_news messages, keyed by article id; with ``quarantine``, bad messages to that folder."""
    if quarantine is None:
        rows = processed_stream(envelope, window, buckets, now, classifier)
        return run.start(_send(rows, out, "article_id", servers, run, ("raw_payload",)))
    rows = observe_exits(messages.with_exits(messages.parse_raw_news(envelope)), f"{run.name}_read")
    unique = observe_exits(_unique(rows, window, buckets, "reason"), f"{run.name}_unique")
    return _two_exits(unique, lambda good: _processed(good, now, classifier), "article_id", out, quarantine, run, servers, ("raw_payload",))


def start_quarantine(envelope: DataFrame, out: str, run: Run) -> StreamingQuery:
    """Messages that cannot be processed, whole, with the reason, as a query of its own."""
    return run.start(quarantine_stream(envelope).writeStream.format("parquet").option("path", out))


def _alt_keyed(candidates: DataFrame, now: Column | None) -> DataFrame:
    return candidates.withColumns({"url_hash": url_fingerprint(F.col("url")), "arrival": arrival_seconds(candidates, now)})


def alt_stream(envelope: DataFrame, now: Column | None = None, lateness: int | None = None) -> DataFrame:
    """The alternative job: time-to-live dedup by url, then scoring."""
    raw = messages.raw_news(messages.parse_raw_news(envelope))
    return alt_normalize(ttl_stream(_alt_keyed(alt_candidates(raw), now), "url_hash", "arrival", lateness=lateness), now=now)


def start_alt_processor(envelope: DataFrame, out: str, run: Run, servers: str | None = None, quarantine: str | None = None,
                        now: Column | None = None) -> StreamingQuery:
    """The alternative job; with ``quarantine``, messages it cannot take go to that folder."""
    lateness = LATENESS_SECONDS if run.every else None
    if quarantine is None:
        return run.start(_send(alt_stream(envelope, now, lateness), out, "id", servers, run))
    raw = observe_exits(messages.raw_news_with_exits(messages.parse_raw_news(envelope)), f"{run.name}_read")
    usable = raw.filter(F.col("reason").isNotNull() | ((F.col("url") != "") & (F.col("title") != "")))
    keyed = _alt_keyed(usable, now)
    # A bad message meets no other row: its key is its place.
    own = keyed.withColumn("url_hash", F.when(F.col("reason").isNull(), F.col("url_hash")).otherwise(F.concat(F.lit("bad/"), F.col("pos").cast("string"))))
    unique = observe_exits(ttl_stream(own, "url_hash", "arrival", lateness=lateness, passes="reason"), f"{run.name}_unique")
    return _two_exits(unique, lambda good: alt_normalize(good.drop("value"), now=now), "id", out, quarantine, run, servers)


# Crawling ---------------------------------------------------------------------------------


def crawl_stream(docs: DataFrame, feeds: DataFrame, startup_ts: int, window: int = CRAWLER_WINDOW,
                 buckets: int = 1, seen: DataFrame | None = None) -> DataFrame:
    """Every crawled entry with its ``outcome``. Entries register their url even when skipped.

    Arrival order is fetch time, then feed order, then entry order. Per-feed and total limits
    belong to the backfill and have no place here.
    """
    rows = documents.crawl(docs, feeds).withColumn("url_hash", url_fingerprint(F.col("url")))
    flagged = window_stream(rows, "url_hash", size=window, buckets=buckets, flag="_repeated", seen=seen)
    outcome = realtime_outcome(F.col("_repeated"), F.col("published_ts"), startup_ts)
    labelled = flagged.withColumn("outcome", outcome)
    return observe_outcomes(labelled, "crawl", "outcome", (PUBLISHED, OLD, NO_TIME, REPEATED)).drop("_repeated")


def start_crawler(docs: DataFrame, feeds: DataFrame, out: str, run: Run, startup_ts: int, servers: str | None = None,
                  save_seen: str | None = None, **options) -> StreamingQuery:
    """Landing documents to raw_news messages. ``startup_ts`` is fixed when the query is
    created; :func:`startup_time` keeps it. ``save_seen`` names the table of registered urls each batch adds its own to."""
    inner = ("outcome", "url_hash", "pos", "feed_pos", "feed_ord", "entry_pos")
    labelled = crawl_stream(docs, feeds, startup_ts, **options)
    if save_seen is None:
        return run.start(_send(labelled.filter(F.col("outcome") == PUBLISHED).drop(*inner), out, "id", servers, run))

    writer = None if servers else topics.writer_number(labelled.sparkSession, out, run.checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            sent = messages.to_messages(batch.filter(F.col("outcome") == PUBLISHED).drop(*inner), "id")
            if servers:
                topics.write_kafka(sent, servers, out)
            else:
                topics.write_files(sent, out, writer, batch_id)
            new = batch.filter(F.col("outcome") != REPEATED).select("url_hash", F.col("pos").alias("seq"))
            new.write.mode("overwrite").parquet(f"{save_seen}/{run.name}-{batch_id:012d}")
        finally:
            batch.unpersist()

    return run.start(labelled.writeStream.foreachBatch(write))


# Storing and alerting ---------------------------------------------------------------------


def start_store(envelope: DataFrame, table: str, run: Run, iceberg: bool = False, ledger: str | None = None) -> StreamingQuery:
    """processed_news messages into the storage table; a repeated batch adds nothing.

    ``ledger`` is the folder of the batches all writers of the table have appended; by default it is kept with the progress, for one writer only.
    """
    notes = ledger or f"{run.folder}/ledger/{table}"
    # A query begun anew counts its batches from 0 again: the number of its writer tells it from the one before.
    name = f"{run.name}-{topics.writer_number(envelope.sparkSession, notes, run.checkpoint)}"
    first = True

    def append(batch: DataFrame, batch_id: int) -> None:
        nonlocal first
        append_batch(batch, table, notes, name, batch_id, first, iceberg)
        first = False

    stored = storage_rows(envelope).observe(f"{run.name}_read", F.count("*").alias("total"))
    return run.start(stored.writeStream.foreachBatch(append))


def start_alerts(envelope: DataFrame, out: str, run: Run, only_matched: bool = True,
                 servers: str | None = None) -> StreamingQuery:
    """Formatted alert messages into an outbox (a topic or a Parquet folder), for a sender outside Spark."""
    keep = ("article_id", "source_topic", "kafka_partition", "kafka_offset")
    rows = alert_outbox(messages.processed_news(envelope), only_matched, keep)
    if servers:
        return run.start(_send(rows, out, "article_id", servers, run))
    return run.start(rows.writeStream.format("parquet").option("path", out))


def scoped(run: Run, mode: str, by_mode: bool = True) -> Run:
    return replace(run, name=query_name(run.name, mode, by_mode))
