"""Topic messages (JSON text in an envelope) to typed rows, with bad ones set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import variant as V
from newsloom.functions.text import raw_hash, strip
from newsloom.functions.times import number_from_text
from newsloom.functions.rules import FIRST_MATCH_RULES, RuleSet
from newsloom.operators.articles import FROM_FEED, FROM_INGESTION, Classifier, normalize
from newsloom.operators.dedup import first_of_each, position

BAD_JSON, NOT_AN_OBJECT, MISSING_URL, PROCESS_ERROR = "bad_json", "not_an_object", "missing_url", "process_error"

RAW_FIELDS = (
    "id title content summary url source matched_feed_name timestamp published_ts should_alert matched_keywords"
).split()

ALERT_FIELDS = "article_id id title summary content url source category keywords should_alert".split()


def _raw_fields(rows: DataFrame) -> DataFrame:
    """Add what the message ``_m`` says: its fields, the body and the time value."""
    fields = V.with_fields(rows, RAW_FIELDS)
    body = F.when(V.absent(F.col("_content")), F.col("_summary")).otherwise(F.col("_content"))
    time = F.when(V.given(F.col("_published_ts")), F.col("_published_ts")).otherwise(F.col("_timestamp"))
    return fields.withColumns({"_body": body, "_time": time})


def parse_raw_news(messages: DataFrame) -> DataFrame:
    """Add the parsed message ``_m``, its fields ``_<name>`` as VARIANT and the ``reason``
    a message cannot be processed for (null for good ones)."""
    fields = _raw_fields(V.read_objects(messages, []))

    def not_text(name: str) -> Column:
        return ~V.absent(F.col(name)) & ~V.is_text(F.col(name))

    # A list or an object as time is an error, unlike a text that is no number.
    broken = not_text("_url") | not_text("_title") | not_text("_body") | F.coalesce(V.is_nested(F.col("_time")), F.lit(False))
    reason = (
        F.when(F.col("_m").isNull(), BAD_JSON)
        .when(~F.col("_is_object"), NOT_AN_OBJECT)
        .when(~V.truthy(F.col("_url")), MISSING_URL)
        .when(broken, PROCESS_ERROR)
    )
    return fields.withColumn("reason", reason)


def quarantine(parsed: DataFrame) -> DataFrame:
    """Messages that cannot be processed, whole, with the reason."""
    return parsed.filter("reason IS NOT NULL").select("topic", "partition", "offset", "value", "reason")


def _seconds(v: Column) -> Column:
    """The number a time is taken from; null for null, missing or unreadable values."""
    flag = F.try_variant_get(v, "$", "boolean").cast("double")
    text = number_from_text(F.try_variant_get(v, "$", "string"))
    number = F.try_variant_get(v, "$", "double")
    return F.when(V.kind(v) == "BOOLEAN", flag).when(V.kind(v) == "STRING", text).otherwise(number)


def _text(name: str) -> Column:
    return F.coalesce(F.try_variant_get(F.col(name), "$", "string"), F.lit(""))


def article_columns() -> list[Column]:
    """The article frame (see ``operators.articles``) of a message, without ``pos``."""
    source = V.text_or(F.col("_source"))
    return [
        strip(_text("_url")).alias("url"),
        strip(_text("_title")).alias("title"),
        strip(_text("_body")).alias("content"),
        source.alias("source"),
        V.text_or(F.col("_matched_feed_name"), source).alias("matched_feed_name"),
        _seconds(F.col("_time")).alias("seconds"),
        F.when(V.given(F.col("_published_ts")), FROM_FEED).otherwise(FROM_INGESTION).alias("time_source"),
        V.truthy(F.col("_should_alert")).alias("should_alert"),
        V.text_list(F.col("_matched_keywords")).alias("matched_keywords"),
        F.to_json("_m").alias("raw_payload"),
    ]


def keyed(parsed: DataFrame, *carried: str) -> DataFrame:
    """``raw_hash``, ``pos`` and the ``carried`` columns of the good messages."""
    return parsed.filter("reason IS NULL").select(
        raw_hash(_text("_url"), _text("_title")).alias("raw_hash"),
        position(F.col("partition"), F.col("offset")).alias("pos"), *carried)


def with_exits(parsed: DataFrame) -> DataFrame:
    """All messages for one pass with two exits: ``raw_hash``, ``pos``, ``reason`` and the message as it came.

    A bad message gets a key of its own, its place, so it neither meets another row nor gathers with the other bad ones.
    """
    place = F.concat_ws("/", F.lit("bad"), "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    key = F.when(F.col("reason").isNull(), raw_hash(_text("_url"), _text("_title"))).otherwise(place)
    return parsed.select(key.alias("raw_hash"), position(F.col("partition"), F.col("offset")).alias("pos"), "topic", "partition", "offset", "value", "reason")


def articles(parsed: DataFrame) -> DataFrame:
    """Article frame of all good messages, repeats included."""
    pos = position(F.col("partition"), F.col("offset")).alias("pos")
    return parsed.filter("reason IS NULL").select(*article_columns(), pos)


def unpacked(unique: DataFrame) -> DataFrame:
    """Article frame, ``raw_hash`` and ``pos`` of messages ``_m`` that are known to be good."""
    return _raw_fields(unique).select(*article_columns(), "raw_hash", "pos")


def process_messages(parsed: DataFrame, rules: RuleSet = FIRST_MATCH_RULES, now: Column | None = None,
                     classifier: Classifier | None = None) -> DataFrame:
    """Whole batch step over parsed raw_news messages.

    Only key, position and the parsed message are shuffled; the fields, some
    of which repeat its content, are taken out of the survivors.
    """
    return normalize(unpacked(first_of_each(keyed(parsed, "_m"), "raw_hash")), rules, now, classifier)


def _alt_takes() -> Column:
    return F.coalesce(V.is_text(F.col("_url")) & V.is_text(F.col("_title")) & (V.absent(F.col("_content")) | V.is_text(F.col("_content"))), F.lit(False))


def raw_news_with_exits(parsed: DataFrame) -> DataFrame:
    """Like :func:`raw_news` for every message, with the ``reason`` of those the alternative job cannot take, and these as they came."""
    reason = F.when(F.col("_m").isNull(), BAD_JSON).when(~F.col("_is_object"), NOT_AN_OBJECT).when(~_alt_takes(), PROCESS_ERROR)
    names = ("topic", "partition", "offset", "value")
    place = [F.when(F.col("_reason").isNotNull(), F.col(c)).alias(c) for c in names]
    return parsed.withColumns({"_sent": F.col("timestamp"), "_reason": reason}).select(*_raw_news_columns(), F.col("_reason").alias("reason"), *place)


def raw_news(parsed: DataFrame) -> DataFrame:
    """Typed ``raw_news`` columns and ``pos`` of object messages, for the alternative job.

    It takes texts as they are: rows whose url, title or content is not a text are left out.
    """
    return parsed.withColumn("_sent", F.col("timestamp")).filter(_alt_takes()).select(*_raw_news_columns())


def _raw_news_columns() -> list[Column]:
    return [
        V.as_text(F.col("_id")).alias("id"),
        _text("_title").alias("title"),
        _text("_content").alias("content"),
        _text("_url").alias("url"),
        V.text_or(F.col("_source")).alias("source"),
        V.as_text(F.col("_matched_feed_name")).alias("matched_feed_name"),
        _seconds(F.col("_timestamp")).cast("long").alias("timestamp"),
        _seconds(F.col("_published_ts")).cast("long").alias("published_ts"),
        V.truthy(F.col("_should_alert")).alias("should_alert"),
        V.text_list(F.col("_matched_keywords")).alias("matched_keywords"),
        F.unix_seconds("_sent").alias("sent_at"),
        position(F.col("partition"), F.col("offset")).alias("pos"),
    ]


def processed_news(messages: DataFrame) -> DataFrame:
    """Columns an alert needs from processed_news or raw_news messages.

    ``should_alert`` is null where the key is absent; ``summary`` is null where
    it is absent, so the content is used instead.
    """
    objects = V.read_objects(messages, ALERT_FIELDS).filter("_is_object")

    def text(name: str) -> Column:
        v = F.col(f"_{name}")
        return F.when(~V.absent(v), V.text_or(v)).alias(name)

    flag, key = F.col("_should_alert"), F.col("_article_id")
    return objects.select(
        F.when(V.absent(key), V.as_text(F.col("_id"))).otherwise(V.as_text(key)).alias("article_id"),
        *[text(n) for n in ("title", "summary", "content", "url", "source", "category")],
        V.text_list(F.col("_keywords")).alias("keywords"),
        F.when(~V.absent(flag), V.truthy(flag)).alias("should_alert"),
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("long").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def checked(parsed: DataFrame) -> DataFrame:
    """``reason`` of bad messages and ``raw_hash`` of good ones, for counters."""
    key = raw_hash(_text("_url"), _text("_title"))
    return parsed.select("reason", F.when(F.col("reason").isNull(), key).alias("raw_hash"))


def to_messages(rows: DataFrame, key: str, json_columns: tuple[str, ...] = (),
                beside: dict[str, Column] | None = None) -> DataFrame:
    """Rows as ``(key, value)`` with every field in the JSON, nulls included.

    ``json_columns`` hold JSON text that becomes part of the document instead of
    a quoted text. Columns of ``beside`` stand next to the value, not in it.
    """
    beside = beside or {}
    fields = [F.parse_json(c).alias(c) if c in json_columns else F.col(c) for c in rows.columns if c != "pos"]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rows.select(*[c.alias(n) for n, c in beside.items()],
                       F.col(key).cast("string").alias("key"), value.alias("value"))
