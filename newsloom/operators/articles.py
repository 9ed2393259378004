"""raw_news to processed_news, and the alternative job's projection.

An article frame has the columns ``url, title, content, source,
matched_feed_name, seconds, time_source, should_alert, matched_keywords,
raw_payload, pos`` with trimmed texts; ``seconds`` is the number the publish
time is taken from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import rules as R
from newsloom.functions.text import article_id, article_summary, raw_hash, short_summary, strip, url_fingerprint
from newsloom.functions.times import epoch_iso, now_iso
from newsloom.operators.dedup import TTL_SECONDS, first_of_each, ttl_first, ttl_positions

# Category from title and content.
Classifier = Callable[[Column, Column], Column]

# Columns that come with a row and are no part of the message.
BOOKKEEPING = ("pos", "raw_hash")

FROM_FEED, FROM_INGESTION = "rss", "ingestion_fallback"


def article_frame(raw: DataFrame, payload: Column | None = None) -> DataFrame:
    """Article frame of a typed ``raw_news`` table that has a ``pos`` column; other columns
    than the payload's, such as ``raw_hash``, stay."""
    fields = [c for c in raw.columns if c not in BOOKKEEPING]
    if payload is None:
        payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return raw.filter(F.col("url") != "").select(
        strip(F.col("url")).alias("url"),
        strip(F.coalesce("title", F.lit(""))).alias("title"),
        strip(F.coalesce("content", F.lit(""))).alias("content"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("matched_feed_name", "source").alias("matched_feed_name"),
        F.coalesce("published_ts", "timestamp").cast("double").alias("seconds"),
        F.when(F.col("published_ts").isNotNull(), FROM_FEED).otherwise(FROM_INGESTION).alias("time_source"),
        F.coalesce("should_alert", F.lit(False)).alias("should_alert"),
        F.coalesce("matched_keywords", F.array().cast("array<string>")).alias("matched_keywords"),
        payload.alias("raw_payload"),
        *[c for c in raw.columns if c in BOOKKEEPING],
    )


def with_raw_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumn("raw_hash", raw_hash(F.col("url"), F.coalesce("title", F.lit(""))))


def normalize(unique: DataFrame, rules: R.RuleSet = R.FIRST_MATCH_RULES, now: Column | None = None,
              classifier: Classifier | None = None) -> DataFrame:
    """processed_news columns (and ``pos``) of articles that have their ``raw_hash``.

    Only projections, so it serves batch and streaming plans. It runs after the
    duplicates are gone: classification is the expensive step. ``classifier``
    replaces the rules for the category, for instance by a model.
    """
    text = R.match_text(F.col("title"), F.col("content"))
    ingested = now_iso(now)
    category = classifier(F.col("title"), F.col("content")) if classifier else \
        R.first_match_category(F.col("_hits"), rules)
    classified = (
        unique.withColumn("_text", text)
        .withColumn("_hits", R.hits_in_order(F.col("_text"), rules))
    )
    return classified.select(
        article_id(F.col("url")).alias("article_id"),
        "source",
        "matched_feed_name",
        "title",
        article_summary(F.col("title"), F.col("content")).alias("summary"),
        "url",
        R.top_keywords(F.col("_hits")).alias("keywords"),
        epoch_iso(F.col("seconds"), ingested).alias("published_at"),
        F.col("time_source").alias("_published_at_source"),
        ingested.alias("ingested_at"),
        category.alias("category"),
        "raw_hash",
        F.lit(False).alias("is_duplicate"),
        "should_alert",
        "matched_keywords",
        "raw_payload",
        "pos",
    )


def process_articles(raw: DataFrame, rules: R.RuleSet = R.FIRST_MATCH_RULES, now: Column | None = None,
                     classifier: Classifier | None = None) -> DataFrame:
    """Whole batch step over typed raw_news rows: drop repeated (url, title) pairs, then
    classify and normalise.

    The rows are shuffled once, as they came; trimmed texts and the payload,
    which hold the content again, are made afterwards.
    """
    unique = first_of_each(with_raw_hash(raw.filter(F.col("url") != "")), "raw_hash")
    return normalize(article_frame(unique), rules, now, classifier)


def alt_candidates(raw: DataFrame) -> DataFrame:
    """Rows of ``raw_news`` the alternative job looks at: url and title not empty, untrimmed."""
    return raw.filter((F.col("url") != "") & (F.col("title") != ""))


def arrival_seconds(raw: DataFrame, now: Column | None = None) -> Column:
    """The time a row counts from in the time-to-live window: its own, else that of its envelope, else the current one."""
    known = [F.col(c) for c in ("timestamp", "sent_at") if c in raw.columns]
    return F.coalesce(*known, F.unix_seconds(F.current_timestamp() if now is None else now))


def alt_normalize(unique: DataFrame, rules: R.RuleSet = R.SCORED_RULES, now: Column | None = None) -> DataFrame:
    """The alternative job's columns (and ``pos``)."""
    seconds = F.unix_seconds(F.current_timestamp() if now is None else now)
    content = F.coalesce("content", F.lit(""))
    scored = (
        unique.withColumn("_body", strip(content))
        .withColumn("_text", R.match_text(F.col("title"), content))
        .withColumn("_hits", R.hits_in_order(F.col("_text"), rules))
        .withColumn("_scores", R.category_scores(F.col("_hits"), rules))
    )
    # A row without an id gets one that stays the same when a task runs again.
    own_id = F.substring(F.sha2(F.concat_ws("|", "url", F.col("pos").cast("string")), 256), 1, 32)
    return scored.select(
        F.coalesce("id", own_id).alias("id"),
        "title",
        short_summary(F.col("title"), F.col("_body")).alias("summary"),
        "url",
        R.top_keywords(F.col("_hits")).alias("keywords"),
        R.scored_category(F.col("_scores"), rules).alias("category"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("timestamp", seconds).alias("timestamp"),
        seconds.alias("processed_at"),
        "pos",
    )


def alt_process_articles(raw: DataFrame, rules: R.RuleSet = R.SCORED_RULES, now: Column | None = None,
                         ttl: int = TTL_SECONDS) -> DataFrame:
    """Whole batch step of the alternative job: time-to-live dedup by url, then scoring."""
    seen = alt_candidates(raw)
    keyed = seen.withColumns({"url_hash": url_fingerprint(F.col("url")), "arrival": arrival_seconds(seen, now)})
    return alt_normalize(ttl_first(keyed, "url_hash", "arrival", ttl=ttl), rules, now)


def processor_counters(messages: DataFrame) -> DataFrame:
    """One row: total, published, dropped_duplicates, errors. ``messages`` has a ``reason``
    for bad messages and a ``raw_hash`` for good ones."""
    counts = messages.agg(
        F.count("*").alias("total"), F.count_distinct("raw_hash").alias("published"),
        F.count("raw_hash").alias("_good"), F.count("reason").alias("errors"))
    return counts.select("total", "published", (F.col("_good") - F.col("published")).alias("dropped_duplicates"),
                         "errors")


def alt_counters(raw: DataFrame, ttl: int = TTL_SECONDS, now: Column | None = None) -> DataFrame:
    """One row: processed, duplicates, filtered."""
    keyed = alt_candidates(raw).select("pos", arrival_seconds(raw, now).alias("arrival"), url_fingerprint(F.col("url")).alias("url_hash"))
    accepted = ttl_positions(keyed, "url_hash", "arrival", ttl=ttl).agg(F.count("*").alias("processed"))
    usable = F.count_if((F.col("url") != "") & (F.col("title") != "")).alias("usable")
    read = raw.agg(F.struct(F.count("*").alias("total"), usable)).scalar()
    return accepted.select(
        "processed",
        (read["usable"] - F.col("processed")).alias("duplicates"),
        (read["total"] - read["usable"]).alias("filtered"),
    )
