"""Fetched feed documents and the RSS or Atom entries in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.once import computed
from newsloom.functions.text import first_non_empty, strip
from newsloom.functions.times import feed_date
from newsloom.operators.alerts import with_alert
from newsloom.operators.joins import join_small
from newsloom.schemas import FEED_DOCUMENTS

_ITEM = (
    "struct<title: string, link: string, guid: struct<_VALUE: string, _isPermaLink: string>, "
    "description: string, `content:encoded`: string, pubDate: string, `dc:date`: string>"
)
_ENTRY = (
    "struct<title: string, link: array<struct<_href: string, _rel: string>>, "
    "summary: string, content: string, published: string, updated: string>"
)
# Root fields of RSS 2.0 (channel), RSS 1.0 (item) and Atom (entry) documents.
DOCUMENT_XML = f"channel struct<item: array<{_ITEM}>>, item array<{_ITEM}>, entry array<{_ENTRY}>, _corrupt_record string"


def read_documents(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None) -> DataFrame:
    """Landing table of fetched documents, JSON lines with ``FEED_DOCUMENTS`` columns."""
    reader = (spark.readStream if stream else spark.read).schema(FEED_DOCUMENTS)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_document_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Landing folder with one XML file per fetch, ``<folder>/<feed name>/<file>.xml``."""
    reader = spark.readStream if stream else spark.read
    files = reader.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(path)
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return files.select(
        F.url_decode(folder).alias("feed_name"),
        F.lit(200).alias("status"),
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("fetched_at"),
    )


def fetched(documents: DataFrame) -> DataFrame:
    """Documents that were fetched."""
    return documents.filter("status = 200 AND body IS NOT NULL")


def parse_documents(documents: DataFrame) -> DataFrame:
    """Add the parsed document ``_doc``. A broken one has ``_doc._corrupt_record``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return computed(documents, _doc=F.from_xml("body", DOCUMENT_XML, options))


def is_broken(doc: Column) -> Column:
    return doc.isNull() | doc["_corrupt_record"].isNotNull()


def broken_documents(parsed: DataFrame) -> DataFrame:
    """Documents that are no well-formed XML, for the quarantine table."""
    return parsed.filter(is_broken(F.col("_doc"))).drop("_doc")


def _text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _item_fields(i: Column) -> Column:
    # A guid stands in for a missing link unless it says it is no permanent link.
    permalink = F.when(F.lower(F.coalesce(i["guid"]["_isPermaLink"], F.lit("true"))) == "true", i["guid"]["_VALUE"])
    return F.struct(
        first_non_empty(i["link"], permalink).alias("link"),
        _text_of(i["title"]).alias("title"),
        first_non_empty(i["description"], i["content:encoded"]).alias("content"),
        i["pubDate"].alias("published"),
        i["dc:date"].alias("updated"),
    )


def _entry_fields(e: Column) -> Column:
    # The link of an entry is its "alternate" one, which is also the default relation.
    links = F.filter(e["link"], lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    return F.struct(
        _text_of(F.get(links, 0)["_href"]).alias("link"),
        _text_of(e["title"]).alias("title"),
        first_non_empty(e["summary"], e["content"]).alias("content"),
        e["published"].alias("published"),
        e["updated"].alias("updated"),
    )


def entries(parsed: DataFrame) -> DataFrame:
    """One row per entry with a link: the document's columns, ``entry_pos`` (order in the
    document), ``url``, ``title``, ``content`` and ``published_ts``."""
    doc = F.col("_doc")
    none = F.array()
    items = F.concat(
        F.coalesce(F.transform(doc["channel"]["item"], _item_fields), none),
        F.coalesce(F.transform(doc["item"], _item_fields), none),
        F.coalesce(F.transform(doc["entry"], _entry_fields), none),
    )
    keep = [c for c in parsed.columns if c not in ("_doc", "body")]
    exploded = parsed.filter(~is_broken(doc)).select(*keep, F.posexplode(items).alias("entry_pos", "_e"))
    e = F.col("_e")
    return exploded.select(
        *keep,
        "entry_pos",
        strip(e["link"]).alias("url"),
        strip(e["title"]).alias("title"),
        strip(e["content"]).alias("content"),
        F.coalesce(feed_date(e["published"]), feed_date(e["updated"])).alias("published_ts"),
    ).filter("url <> ''")


def entry_id(feed: Column, url: Column, title: Column, published_ts: Column) -> Column:
    """Id of a raw article that stays the same when the entry is read again."""
    return F.substring(F.sha2(F.concat_ws("|", feed, url, title, published_ts.cast("string")), 256), 1, 32)


# Digits of a document's key and of an entry's number in a position. No text holds 10^8 entries.
KEY_DIGITS, ENTRY_DIGITS = 9, 8


def document_key(body: Column) -> Column:
    """Number that tells the documents of one feed and second apart, the same whenever they are read."""
    return F.pmod(F.xxhash64(body), F.lit(10 ** KEY_DIGITS))


def _digits(number: Column, places: int) -> Column:
    return number.cast("decimal(38,0)") * F.lit(str(10 ** places)).cast(f"decimal({places + 1},0)")


def feed_position(seconds: Column, key: Column, entry_pos: Column) -> Column:
    """Order of a feed's entries: fetch time, document, entry."""
    number = _digits(seconds.cast("decimal(11,0)"), KEY_DIGITS + ENTRY_DIGITS) + _digits(key, ENTRY_DIGITS) + entry_pos.cast("decimal(10,0)")
    return number.cast("decimal(28,0)")


def crawl_position(seconds: Column, feed_ord: Column, key: Column, entry_pos: Column) -> Column:
    """Arrival order over all feeds: fetch time, feed (any int from 0 on), document, entry."""
    places = KEY_DIGITS + ENTRY_DIGITS
    inside = (_digits(key, ENTRY_DIGITS) + entry_pos.cast("decimal(10,0)")).cast("decimal(17,0)")
    number = (_digits(seconds.cast("decimal(11,0)"), 10) + feed_ord.cast("decimal(10,0)")).cast("decimal(21,0)")
    return (number * F.lit(str(10 ** places)).cast(f"decimal({places + 1},0)") + inside).cast("decimal(38,0)")


def crawl(documents: DataFrame, feeds: DataFrame) -> DataFrame:
    """raw_news rows, with ``feed_ord``, ``entry_pos``, ``feed_pos`` (order in the feed) and ``pos`` (order of arrival),
    from fetched documents of known feeds."""
    rules = feeds.select(F.col("name").alias("feed_name"), "feed_ord", "include_keywords", "exclude_keywords")
    keyed = fetched(documents).withColumn("_key", document_key(F.col("body")))
    known = join_small(keyed, rules, "feed_name", spread="_key")
    rows = with_alert(entries(parse_documents(known))).withColumn("source", F.col("feed_name"))
    return rows.select(
        entry_id(F.col("feed_name"), F.col("url"), F.col("title"), F.col("published_ts")).alias("id"),
        "title",
        "content",
        "url",
        "source",
        F.col("source").alias("matched_feed_name"),
        F.unix_seconds("fetched_at").alias("timestamp"),
        "published_ts",
        "should_alert",
        "matched_keywords",
        "feed_ord",
        "entry_pos",
        feed_position(F.unix_seconds("fetched_at"), F.col("_key"), F.col("entry_pos")).alias("feed_pos"),
        crawl_position(F.unix_seconds("fetched_at"), F.col("feed_ord"), F.col("_key"), F.col("entry_pos")).alias("pos"),
    )

