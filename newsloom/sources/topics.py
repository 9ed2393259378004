"""Topics: Kafka, or files with the same envelope columns."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter

from newsloom.schemas import ENVELOPE

# Producer settings.
SINK_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "gzip"}


def _text_envelope(df: DataFrame) -> DataFrame:
    return df.select("topic", "partition", "offset", "timestamp",
                     F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def _kafka_options(servers: str, topic: str, starting: str) -> dict[str, str]:
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting offsets must be earliest or latest, not {starting!r}")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_per_trigger: int | None = None) -> DataFrame:
    """Streaming read. ``starting`` counts only while the query has no checkpoint."""
    reader: DataStreamReader = spark.readStream.format("kafka").options(**_kafka_options(servers, topic, starting))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return _text_envelope(reader.load())


def kafka_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All messages the topic holds now."""
    options = _kafka_options(servers, topic, "earliest") | {"endingOffsets": "latest"}
    return _text_envelope(spark.read.format("kafka").options(**options).load())


# Bits of an offset that count the messages of one batch and task, and of a partition that number the tasks of a writer.
BATCH_BITS = 33
TASK_BITS = 20


def writer_number(spark: SparkSession, path: str, kept: str | None = None) -> int:
    """A number no other writer of this file topic has.

    It is claimed by creating a file of that name in the topic, which only one writer can do. ``kept`` names the folder of a query's progress, where
    the number stays: a restarted query is the same writer, one that begins anew is another one.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    note = f"{kept.rstrip('/')}/newsloom-writer/{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:16]}" if kept else None
    if note:
        try:
            return int(spark.read.text(note).first()[0])
        except AnalysisException:
            pass
    folder = hadoop.Path(f"{path.rstrip('/')}/_writers")
    files = folder.getFileSystem(conf)
    files.mkdirs(folder)
    for number in range(1 << 31 - TASK_BITS):
        if files.createNewFile(hadoop.Path(folder, str(number))):
            if note:
                spark.createDataFrame([(str(number),)], "value string").coalesce(1).write.text(note)
            return number
    raise ValueError(f"{path} has had {number + 1} writers; begin a new topic")


def write_files(sent: DataFrame, path: str, writer: int, batch: int = 0) -> None:
    """Write ``(key, value)`` rows of one batch to a file topic: envelope rows in JSON lines, in a folder of their own.

    A batch that is done again replaces its folder; no other writer uses it. Writer and task are the partition; offsets
    grow from batch to batch, so a position names one message however many write to the topic.
    """
    number = F.monotonically_increasing_id().bitwiseAND((1 << BATCH_BITS) - 1)
    topic = path.rstrip("/").rsplit("/", 1)[-1]
    envelope = sent.select(
        F.lit(topic).alias("topic"), (F.lit(writer << TASK_BITS) + F.spark_partition_id()).alias("partition"),
        (number + (batch << BATCH_BITS)).alias("offset"), F.current_timestamp().alias("timestamp"), "key", "value")
    envelope.write.mode("overwrite").json(f"{path.rstrip('/')}/writer-{writer:04d}-batch-{batch:012d}")


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming read of envelope rows from JSON-lines files in a folder and those below it."""
    reader = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def file_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).option("recursiveFileLookup", True).json(path)


def peek(messages: DataFrame, n: int) -> DataFrame:
    """The first ``n`` messages from the beginning of the topic."""
    return messages.orderBy("offset", "partition").limit(n)


def kafka_sink(messages: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """Streaming write of ``(key, value)`` rows; add a checkpoint location and start it."""
    return (messages.writeStream.format("kafka").options(**SINK_OPTIONS)
            .option("kafka.bootstrap.servers", servers).option("topic", topic))


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch write of ``(key, value)`` rows."""
    (messages.write.format("kafka").options(**SINK_OPTIONS)
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
