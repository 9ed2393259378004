"""News streams derived from the given tables.

Every frame is a projection of a whole table; nothing is made up besides the
arithmetic on row ids that gives articles a time and a topic position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.html import escape
from newsloom.functions.once import computed
from newsloom.functions.text import url_fingerprint
from newsloom.operators.dedup import position

# Parameters of the derived streams; the SQL checks use the same ones.
START = 1711234567
SPREAD = 5000
NOW = START + SPREAD
STARTUP = START - 86400
SPREAD_RULES = "alpha: the , ation, there\nbeta: eau, ung, sch\ngamma: ción, license, ation"
FAULTS = 40


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def title_of(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def with_news_columns(docs: DataFrame) -> DataFrame:
    """raw_news columns, the topic position and ``pos`` from ``documents`` rows."""
    number = F.col("doc_id")
    published = F.col("timestamp") - (number % 5) * 86400
    return (
        docs.select("doc_id", "source", title_of(F.col("text")).alias("title"), F.col("text").alias("content"))
        .withColumn("url", F.concat(F.lit("https://"), "source", F.lit(".example.com/"),
                                    F.substring(F.sha2("title", 256), 1, 12)))
        .withColumn("timestamp", F.lit(START) + (number * 37) % SPREAD)
        .withColumn("published_ts", F.when(number % 7 != 0, published))
        .withColumn("partition", (number % 4).cast("int"))
        .withColumn("offset", F.floor(number / 4))
        .withColumn("pos", position(F.col("partition"), F.col("offset")))
    )


def raw_news(spark: SparkSession, sf: str) -> DataFrame:
    return with_news_columns(table(spark, sf, "documents").select("doc_id", "source", "text"))


def typed_raw_news(spark: SparkSession, sf: str) -> DataFrame:
    """With all raw_news columns of the schema."""
    return raw_news(spark, sf).select(
        F.col("doc_id").cast("string").alias("id"), "title", "content", "url", "source",
        F.col("source").alias("matched_feed_name"), "timestamp", "published_ts",
        F.lit(None).cast("boolean").alias("should_alert"),
        F.lit(None).cast("array<string>").alias("matched_keywords"), "pos",
    )


def feeds(spark: SparkSession, sf: str) -> DataFrame:
    """A registry with one feed per source; its keyword lists follow the source number."""
    number = F.substring("name", 4, 9).cast("int")

    def words(*texts: str) -> Column:
        return F.array(*[F.lit(t) for t in texts]).cast("array<string>")

    include = (
        F.when(number % 4 == 1, words("the ", "ation")).when(number % 4 == 2, words("ung", "sch"))
        .when(number % 4 == 3, words("AI", "oil", "CIÓN")).otherwise(words())
    )
    return table(spark, sf, "documents").select(F.col("source").alias("name")).distinct().select(
        number.alias("feed_ord"), "name",
        F.concat(F.lit("https://"), "name", F.lit(".example.com/rss")).alias("url"),
        (number != 19).alias("enabled"), F.lit("").alias("category_hint"), include.alias("include_keywords"),
        F.when(number % 5 == 0, words("License")).otherwise(words()).alias("exclude_keywords"),
    )


def seen_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Url hashes of the documents that have a label: the urls of an earlier crawl."""
    labelled = table(spark, sf, "documents").select("doc_id", "source", "text").join(
        table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    news = with_news_columns(labelled)
    return news.groupBy(url_fingerprint(F.col("url")).alias("url_hash")).agg(F.min("pos").alias("seq"))


def _case(number: int, value: Column) -> Column:
    """``value``, or null in rows with this fault number."""
    return F.when(F.col("doc_id") % FAULTS != number, value)


def messages(news: DataFrame, topic: str = "raw_news") -> DataFrame:
    """Envelope rows with JSON values; one row in ``FAULTS`` shows each irregular form."""
    k = F.col("doc_id") % FAULTS
    fields = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.when(~k.isin(7, 15), F.col("title")).alias("title"),
        F.when(~k.isin(8, 9), F.col("content")).alias("content"),
        F.when(k == 9, F.col("content")).alias("summary"),
        F.when(~k.isin(3, 4, 5, 6, 12, 16), F.col("url")).alias("url"),
        F.col("source").alias("source"),
        _case(14, F.concat(F.lit("feed "), "source")).alias("matched_feed_name"),
        F.when(~k.isin(10, 11), F.col("timestamp")).alias("timestamp"),
        F.when(~k.isin(10, 11), F.col("published_ts")).alias("published_ts"),
        F.when(~k.isin(13, 17), F.col("doc_id") % 3 == 0).alias("should_alert"),
        F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("the "), F.col("source"))).alias("matched_keywords"),
    )
    extra = (
        F.when(k == 4, F.lit(',"url":null}')).when(k == 5, F.lit(',"url":""}')).when(k == 6, F.lit(',"url":"   "}'))
        .when(k == 7, F.lit(',"title":null}')).when(k == 8, F.lit(',"content":null}'))
        .when(k == 10, F.concat(F.lit(',"timestamp":" '), F.col("timestamp").cast("string"), F.lit('.75 "}')))
        .when(k == 11, F.lit(',"timestamp":[1]}')).when(k == 12, F.lit(',"url":5}'))
        .when(k == 13, F.lit(',"should_alert":"false"}')).when(k == 15, F.lit(',"title":15}'))
        .when(k == 16, F.lit(',"url":0}')).when(k == 17, F.lit(',"should_alert":[]}'))
    )
    built = computed(news, json=F.to_json(fields))
    opened = F.expr("substring(json, 1, length(json) - 1)")
    value = (
        F.when(k == 1, F.expr("substring(json, 1, length(json) - 3)"))
        .when(k == 2, F.concat(F.lit(" ["), F.col("json"), F.lit("]")))
        .when(extra.isNotNull(), F.concat(opened, extra))
        .otherwise(F.col("json"))
    )
    return built.select(
        F.lit(topic).alias("topic"), "partition", "offset",
        F.timestamp_seconds("timestamp").alias("timestamp"), F.col("doc_id").cast("string").alias("key"),
        value.alias("value"))


def raw_messages(spark: SparkSession, sf: str) -> DataFrame:
    return messages(raw_news(spark, sf))


def rss_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One RSS document per row of ``documents``, with one item per line of its text."""
    def item(line: Column, i: Column) -> Column:
        date = F.when(i % 2 == 0, F.concat(F.lit("<pubDate>"), _rfc(i), F.lit("</pubDate>"))).otherwise(F.lit(""))
        return F.concat(F.lit("<item><title>"), line, F.lit("</title><link> "), F.col("link"), F.lit("/"), i.cast("string"),
                        F.lit(" </link><description>"), line, F.lit("</description>"), date, F.lit("</item>"))

    lines = raw_news(spark, sf).withColumns({"lines": F.split(escape(F.col("content")), "\n"), "link": escape(F.col("url"))})
    body = F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>t</title>'),
                    F.array_join(F.transform("lines", item), ""), F.lit("</channel></rss>"))
    return computed(lines, body=body).select(
        F.col("source").alias("feed_name"), F.lit(200).alias("status"), "body",
        F.timestamp_seconds("timestamp").alias("fetched_at"), "doc_id")


def _rfc(hours: Column) -> Column:
    at = F.timestamp_seconds(F.col("timestamp") + hours * 3600)
    return F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss '+0000'")


def atom_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One Atom document with one entry per row of ``documents``."""
    updated = F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+07:00'")
    body = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title><entry><link rel="self" href="x"/>'
              '<link href="'), escape(F.col("url")), F.lit('"/><title>'), escape(F.col("title")),
        F.lit('</title><summary type="html">'), escape(F.col("content")), F.lit("</summary><updated>"), updated,
        F.lit("</updated></entry></feed>"))
    return computed(raw_news(spark, sf), body=body).select(
        F.col("source").alias("feed_name"), F.lit(200).alias("status"), "body",
        F.timestamp_seconds("timestamp").alias("fetched_at"), "doc_id")


def crawl_documents(spark: SparkSession, sf: str) -> DataFrame:
    """RSS and Atom documents of all feeds: the two of an article were fetched in one second."""
    return rss_documents(spark, sf).drop("doc_id").unionByName(atom_documents(spark, sf).drop("doc_id"))


def page_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Web pages that came in place of feeds; HTML is no well-formed XML."""
    return table(spark, sf, "pages").select(
        F.col("url").alias("feed_name"), F.lit(200).alias("status"), F.col("html").alias("body"),
        F.timestamp_seconds(F.lit(START)).alias("fetched_at"), "page_id")
