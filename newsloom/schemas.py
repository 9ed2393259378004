"""Schemas of the streams and tables, as Spark DDL."""

# A message of a topic, as the Kafka source delivers it.
ENVELOPE = "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"

# Feed registry; feed_ord is the registry order.
FEEDS = (
    "feed_ord int, name string, url string, enabled boolean, category_hint string, "
    "include_keywords array<string>, exclude_keywords array<string>"
)

# Fetched feed documents.
FEED_DOCUMENTS = "feed_name string, status int, body string, fetched_at timestamp"

RAW_NEWS = (
    "id string, title string, content string, url string, source string, matched_feed_name string, "
    "timestamp bigint, published_ts bigint, should_alert boolean, matched_keywords array<string>"
)

PROCESSED_NEWS = (
    "article_id string, source string, matched_feed_name string, title string, summary string, url string, "
    "keywords array<string>, published_at string, _published_at_source string, ingested_at string, "
    "category string, raw_hash string, is_duplicate boolean, should_alert boolean, "
    "matched_keywords array<string>, raw_payload string"
)

ALT_PROCESSED = (
    "id string, title string, summary string, url string, keywords array<string>, category string, "
    "source string, timestamp bigint, processed_at bigint"
)

STORAGE_ROW = (
    "article_id string, source string, matched_feed_name string, title string, summary string, url string, "
    "keywords array<string>, published_at string, ingested_at string, category string, raw_hash string, "
    "is_duplicate boolean, should_alert boolean, matched_keywords array<string>, raw_payload_json string, "
    "published_at_source string, source_topic string, kafka_partition bigint, kafka_offset bigint"
)

QUARANTINE = "topic string, partition int, offset bigint, value string, reason string"

OUTBOX = "article_id string, source_topic string, kafka_partition bigint, kafka_offset bigint, message string"

# Keys of an article that were accepted before.
SEEN_URLS = "url_hash string, seq decimal(38,0)"


def columns(ddl: str) -> list[str]:
    """Column names of one of the schemas above, in order."""
    return [part.split()[0] for part in ddl.split(", ")]
