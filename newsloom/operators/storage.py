"""processed_news to rows of the storage table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from newsloom.functions import variant as V
from newsloom.functions.text import strip
from newsloom.schemas import STORAGE_ROW, columns

# Storage columns whose message field has another name.
RENAMED = {"published_at_source": "_published_at_source", "raw_payload_json": "raw_payload"}
TEXT_COLUMNS = (
    "article_id source matched_feed_name title summary url published_at ingested_at category raw_hash "
    "published_at_source"
).split()


def storage_rows(messages: DataFrame) -> DataFrame:
    """The 19 storage columns from messages ``(topic, partition, offset, value)``.

    Messages that are no JSON objects are left out. A null field is stored as
    an empty text.
    """
    names = [RENAMED.get(c, c) for c in columns(STORAGE_ROW)[:-3]]
    objects = V.read_objects(messages, names).filter("_is_object")

    def field(name: str) -> Column:
        return F.col("_" + RENAMED.get(name, name))

    values = {name: strip(V.text_or(field(name))) for name in TEXT_COLUMNS}
    values |= {name: V.text_list(field(name)) for name in ("keywords", "matched_keywords")}
    values |= {name: V.truthy(field(name)) for name in ("is_duplicate", "should_alert")}
    values["raw_payload_json"] = V.json_text(field("raw_payload_json"))
    values["source_topic"] = F.col("topic")
    values["kafka_partition"] = F.col("partition").cast("long")
    values["kafka_offset"] = F.col("offset").cast("long")
    return objects.select(*[values[name].alias(name) for name in columns(STORAGE_ROW)])


def latest_rows(table: DataFrame, n: int = 10) -> DataFrame:
    """The newest rows by offset; ties are settled by partition."""
    return table.orderBy(F.desc("kafka_offset"), F.desc("kafka_partition")).limit(n)


PLACE = ["source_topic", "kafka_partition", "kafka_offset"]


def place_ranges(rows: DataFrame) -> list[Row]:
    """Offset range (low, high) of ``rows`` in each topic and partition.

    One row a partition of the topics. A row without a place is an error, as it could be stored twice or never.
    """
    ranges = rows.groupBy(*PLACE[:2]).agg(F.min(PLACE[2]).alias("low"), F.max(PLACE[2]).alias("high"),
                                          F.count_if(F.col(PLACE[2]).isNull()).alias("lost")).collect()
    if any(r.lost or r[PLACE[0]] is None or r[PLACE[1]] is None for r in ranges):
        raise ValueError("messages without topic, partition or offset cannot be stored")
    return ranges


def unstored(rows: DataFrame, stored: DataFrame, ranges: list[Row]) -> DataFrame:
    """Rows whose (topic, partition, offset) is not stored yet.

    The stored side is cut to the :func:`place_ranges` of ``rows`` first. Appended files hold narrow offset ranges of few partitions,
    so the filter skips nearly all of them by their Parquet statistics.
    """
    near = [(F.col(PLACE[0]) == r[0]) & (F.col(PLACE[1]) == r[1]) & F.col(PLACE[2]).between(r.low, r.high) for r in ranges]
    known = stored.filter(reduce(or_, near)).select(*PLACE)
    return rows.join(known, PLACE, "left_anti")
