"""The registered queries: name -> function of (session, data folder).

Each runs one operator, or a whole plan, over the whole derived news tables of
``plans.fixture``. List columns are joined to text with ``|`` and wall-clock
columns are fixed, so results can be compared with SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom.functions import html as H
from newsloom.functions import rules as R
from newsloom.functions import text as T
from newsloom.functions import times as M
from newsloom.functions import variant as V
from newsloom.functions.alerts import hashtags, icon
from newsloom.operators import alerts, articles, dedup, limits, outcomes, rulebook, storage
from newsloom.plans import fixture as X
from newsloom.plans import jobs as plan_jobs
from newsloom.session import run_dir
from newsloom.sources import documents as D
from newsloom.sources import feeds as feed_registry
from newsloom.sources import messages, tables, topics
from newsloom.streaming import jobs, metrics, state

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

PER_FEED, TOTAL, DAYS = 17, 200, 3


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def fixed_now() -> Column:
    return F.timestamp_seconds(F.lit(X.NOW))


def joined(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


def doc_id() -> Column:
    """doc_id of the topic position ``pos``."""
    partition, offset = dedup.place_of(F.col("pos"))
    return (offset * 4 + partition).alias("doc_id")


# Articles ---------------------------------------------------------------------------------


def processed(spark: SparkSession, sf: str) -> DataFrame:
    return articles.process_articles(X.typed_raw_news(spark, sf), now=fixed_now())


@query
def process_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Dedup, classify, extract keywords, summarise and normalise all articles."""
    return processed(spark, sf).select(
        doc_id(), "article_id", "source", "matched_feed_name", "title", "summary", "url", joined("keywords"),
        "published_at", "_published_at_source", "ingested_at", "category", "raw_hash", "is_duplicate", "should_alert")


@query
def classify_first_match(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.raw_news(spark, sf).select("doc_id", R.match_text(F.col("title"), F.col("content")).alias("t"))
    hits = rows.select("doc_id", R.hits_in_order(F.col("t")).alias("hits"))
    return hits.select("doc_id", R.first_match_category(F.col("hits")).alias("category"))


@query
def extract_keywords(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.raw_news(spark, sf).select("doc_id", R.match_text(F.col("title"), F.col("content")).alias("t"))
    hits = rows.select("doc_id", R.hits_in_order(F.col("t")).alias("hits"))
    return hits.select("doc_id", R.top_keywords(F.col("hits")).alias("keywords")).withColumn("keywords", joined("keywords"))


@query
def classify_rules_table(spark: SparkSession, sf: str) -> DataFrame:
    """Rules kept as a table instead of constants."""
    rules = R.RuleSet.from_table(R.RuleSet.from_text(X.SPREAD_RULES).table(spark))
    rows = X.raw_news(spark, sf).select("doc_id", R.match_text(F.col("title"), F.col("content")).alias("t"))
    hits = rows.select("doc_id", R.hits_in_order(F.col("t"), rules).alias("hits"))
    return hits.select("doc_id", R.first_match_category(F.col("hits"), rules).alias("category"),
                       F.array_join(R.top_keywords(F.col("hits")), "|").alias("keywords"))


@query
def classify_rules_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same by a join on rare grams, as rules too many for one machine need it."""
    rows = X.raw_news(spark, sf).select("doc_id", R.match_text(F.col("title"), F.col("content")).alias("t"))
    found = rulebook.rule_hits(rows, R.RuleSet.from_text(X.SPREAD_RULES).table(spark), "doc_id", F.col("t"))
    keywords = F.array_join(R.top_keywords(F.col("hits.keyword")), "|").alias("keywords")
    return found.select("doc_id", rulebook.first_category().alias("category"), keywords)


@query
def classify_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """The processor with a classifier of the user's own in place of the rules: by how the title is written."""
    def by_title(title: Column, content: Column) -> Column:
        return F.when(F.length(title) * 20 > F.length(content), "brief").when(F.contains(title, F.lit(",")), "listing").otherwise("report")

    rows = articles.process_articles(X.typed_raw_news(spark, sf), now=fixed_now(), classifier=by_title)
    return rows.select(doc_id(), "category", joined("keywords"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.raw_news(spark, sf).select("doc_id", R.match_text(F.col("title"), F.col("content")).alias("t"))
    hits = rows.select("doc_id", R.hits_in_order(F.col("t"), R.SCORED_RULES).alias("hits"))
    return hits.select("doc_id", "hits", R.category_scores(F.col("hits")).alias("scores"))


@query
def classify_by_score(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select(
        "doc_id", R.scored_category(F.col("scores")).alias("category"),
        F.array_join(R.top_keywords(F.col("hits")), "|").alias("keywords"))


@query
def category_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Hits per article and category, ranked; categories without a hit have no row."""
    positive = F.filter("scores", lambda s: s["score"] > 0)
    ranked = F.sort_array(positive, asc=False)
    rows = scored(spark, sf).select("doc_id", F.posexplode(ranked).alias("i", "s"))
    return rows.select("doc_id", F.col("s.category").alias("category"), F.col("s.score").cast("long").alias("score"),
                       (F.col("i") + 1).cast("long").alias("rank"))


@query
def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Processed articles per source and category."""
    return processed(spark, sf).groupBy("source", "category").agg(F.count("*").alias("articles"))


@query
def summaries(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.raw_news(spark, sf).select("doc_id", T.strip(F.col("title")).alias("title"),
                                        T.strip(F.col("content")).alias("body"))
    return rows.select("doc_id", T.article_summary(F.col("title"), F.col("body")).alias("summary"))


@query
def short_summaries(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.raw_news(spark, sf).select("doc_id", "title", T.strip(F.col("content")).alias("body"))
    return rows.select("doc_id", T.short_summary(F.col("title"), F.col("body")).alias("summary"))


@query
def article_ids(spark: SparkSession, sf: str) -> DataFrame:
    return X.raw_news(spark, sf).select(
        "doc_id", T.article_id(F.col("url")).alias("article_id"),
        T.raw_hash(F.col("url"), F.col("title")).alias("raw_hash"),
        T.url_fingerprint(F.concat(F.lit(" 　\t"), F.upper("url"), F.lit("\x1c\n"))).alias("url_hash"))


@query
def canonical_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Trim, lower and collapse white space in whole conversation texts."""
    rows = X.table(spark, sf, "conversations")
    padded = F.concat(F.lit(" \x1f \n"), "text", F.lit("\t \x85"))
    return rows.select("conv_id", "turn", T.canonical(padded).alias("canonical"),
                       T.collapse_space(padded).alias("collapsed"))


@query
def published_times(spark: SparkSession, sf: str) -> DataFrame:
    """Publish time with its source, and the fallback for times out of range."""
    frame = articles.article_frame(X.typed_raw_news(spark, sf))
    now = F.lit("now")
    return frame.select(
        doc_id(), M.epoch_iso(F.col("seconds"), now).alias("published_at"), "time_source",
        M.epoch_iso(F.col("seconds") - 0.5, now).alias("half_second_earlier"),
        M.epoch_iso(-F.col("seconds") * 37, now).alias("long_ago"))


@query
def feed_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Event times written in the date formats of feeds and read back."""
    at = F.col("ts").cast("timestamp")
    k = F.col("event_id") % 8
    text = (
        F.when(k == 0, F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(k == 1, F.date_format(at, "EEE, d MMM yyyy HH:mm:ss '+0700'"))
        .when(k == 2, F.date_format(at, "dd MMM yyyy HH:mm:ss 'EST'"))
        .when(k == 3, F.date_format(at, "EEEE, dd MMM yy HH:mm:ss 'PDT'"))
        .when(k == 4, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 5, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'-03:30'"))
        .when(k == 6, F.date_format(at, "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("at "), F.col("ts").cast("string"), F.lit(" or so")))
    )
    rows = X.table(spark, sf, "events").select("event_id", text.alias("text"))
    return rows.select("event_id", M.feed_date(F.col("text")).alias("epoch"))


# Duplicates -------------------------------------------------------------------------------


@query
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = articles.with_raw_hash(X.raw_news(spark, sf).select("doc_id", "url", "title", "pos"))
    return dedup.first_of_each(rows, "raw_hash").select("doc_id", "raw_hash")


@query
def dedup_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = articles.with_raw_hash(X.raw_news(spark, sf).select("doc_id", "url", "title", "pos"))
    return dedup.flag_repeats(rows, "raw_hash").select("doc_id", "is_duplicate")


@query
def dedup_ttl(spark: SparkSession, sf: str) -> DataFrame:
    """Time-to-live window over the event stream of every user."""
    rows = X.table(spark, sf, "events").select(
        "event_id", "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"))
    return dedup.ttl_first(rows, "user_id", "seconds", "event_id", 6 * 3600).select("event_id", "user_id", "seconds")


@query
def dedup_ttl_flags(spark: SparkSession, sf: str) -> DataFrame:
    """The same per event type, where one key holds a large share of the rows."""
    rows = X.table(spark, sf, "events").select(
        "event_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"))
    return dedup.ttl_flags(rows, "event_type", "seconds", "event_id").select("event_id", "is_duplicate")


@query
def seen_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """Urls that an earlier crawl has not registered."""
    rows = X.raw_news(spark, sf).select("pos", T.url_fingerprint(F.col("url")).alias("url_hash"))
    new = dedup.unseen(dedup.first_positions(rows, "url_hash"), X.seen_urls(spark, sf), "url_hash")
    return new.select("url_hash", doc_id())


@query
def seen_size(spark: SparkSession, sf: str) -> DataFrame:
    return X.seen_urls(spark, sf).agg(F.count_distinct("url_hash").alias("urls"))


@query
def latest_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The most recently registered urls, as they seed a bounded state."""
    registered = outcomes.registered_urls(X.raw_news(spark, sf))
    return outcomes.latest_urls(registered, 50).select("url_hash")


# Feeds and crawling -----------------------------------------------------------------------


def registry(spark: SparkSession, sf: str) -> DataFrame:
    return feed_registry.enabled_feeds(X.feeds(spark, sf))


@query
def enabled_feeds(spark: SparkSession, sf: str) -> DataFrame:
    return registry(spark, sf).select("feed_ord", "name", "url", joined("include_keywords"), joined("exclude_keywords"))


@query
def feed_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Every article with the alert decision of its feed."""
    rows = X.raw_news(spark, sf).select("doc_id", "source", "title", "content", "pos")
    return alerts.tag_articles(rows, registry(spark, sf)).select("doc_id", "should_alert", joined("matched_keywords"))


@query
def alert_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Articles and alerts per feed."""
    rows = X.raw_news(spark, sf).select("doc_id", "source", "title", "content", "pos")
    tagged = alerts.tag_articles(rows, registry(spark, sf))
    return tagged.groupBy("source").agg(F.count("*").alias("articles"), F.count_if("should_alert").alias("alerts"))


@query
def realtime_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.raw_news(spark, sf).select("doc_id", "url", "published_ts", "pos")
    return outcomes.realtime_outcomes(rows, X.STARTUP, X.seen_urls(spark, sf)).select("doc_id", "outcome")


@query
def realtime_counters(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.raw_news(spark, sf).select("doc_id", "url", "published_ts", "pos")
    return outcomes.realtime_counters(outcomes.realtime_outcomes(rows, X.STARTUP, X.seen_urls(spark, sf)))


def backfill_input(spark: SparkSession, sf: str) -> DataFrame:
    return X.raw_news(spark, sf).select(
        "doc_id", F.substring("source", 4, 9).cast("int").alias("feed_ord"), F.col("doc_id").alias("entry_pos"),
        "published_ts", "title")


@query
def backfill_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = limits.select_backfill(backfill_input(spark, sf), X.NOW, PER_FEED, TOTAL, DAYS)
    return rows.select("feed_ord", "doc_id", "title")


@query
def backfill_by_days(spark: SparkSession, sf: str) -> DataFrame:
    return limits.select_backfill(backfill_input(spark, sf), X.NOW, days=DAYS).select("feed_ord", "doc_id")


@query
def backfill_per_feed(spark: SparkSession, sf: str) -> DataFrame:
    return limits.select_backfill(backfill_input(spark, sf), X.NOW, per_feed=PER_FEED).select("feed_ord", "doc_id")


@query
def backfill_total(spark: SparkSession, sf: str) -> DataFrame:
    return limits.select_backfill(backfill_input(spark, sf), X.NOW, total=TOTAL).select("feed_ord", "doc_id")


@query
def backfill_counters(spark: SparkSession, sf: str) -> DataFrame:
    return limits.backfill_counters(backfill_input(spark, sf), X.NOW, PER_FEED, TOTAL, DAYS)


@query
def backfill_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Counters per feed without a total limit, and their grand total."""
    counters = limits.backfill_counters(backfill_input(spark, sf), X.NOW, PER_FEED, None, DAYS)
    return limits.with_grand_total(counters)


@query
def rss_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Items of RSS documents, one document per article and one item per line."""
    docs = D.fetched(X.rss_documents(spark, sf))
    return D.entries(D.parse_documents(docs)).select("doc_id", "entry_pos", "url", "title", "content", "published_ts")


@query
def atom_entries(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.fetched(X.atom_documents(spark, sf))
    return D.entries(D.parse_documents(docs)).select("doc_id", "entry_pos", "url", "title", "content", "published_ts")


@query
def fetched_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that were fetched, among those whose server answered with an error or with nothing."""
    number = F.col("doc_id")
    docs = X.atom_documents(spark, sf).withColumns({
        "status": F.when(number % 5 == 0, 404).when(number % 7 == 0, 503).when(number % 11 == 0, None).otherwise(F.col("status")),
        "body": F.when(number % 13 != 0, F.col("body"))})
    return D.entries(D.parse_documents(D.fetched(docs))).select("doc_id", "entry_pos", "url")


@query
def broken_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that are no feeds, among feeds: web pages sent in their place."""
    feeds_too = X.atom_documents(spark, sf).withColumnRenamed("doc_id", "page_id")
    docs = D.fetched(X.page_documents(spark, sf).unionByName(feeds_too))
    broken = D.broken_documents(D.parse_documents(docs))
    return broken.select("page_id", "feed_name", F.length("body").alias("chars"))


@query
def crawl(spark: SparkSession, sf: str) -> DataFrame:
    """raw_news rows of all fetched documents of enabled feeds, RSS and Atom together."""
    rows = D.crawl(X.crawl_documents(spark, sf), registry(spark, sf))
    return rows.select("id", "title", "url", "source", "timestamp", "published_ts", "should_alert",
                       joined("matched_keywords"), "feed_ord", "entry_pos")


# Messages, storage, alerts ----------------------------------------------------------------


@query
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that cannot be processed, with the reason."""
    bad = messages.quarantine(messages.parse_raw_news(X.raw_messages(spark, sf)))
    return bad.select((F.col("offset") * 4 + F.col("partition")).alias("doc_id"), "reason")


@query
def parsed_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Article frame of the good messages: defaults, fallbacks and coercions applied."""
    good = messages.articles(messages.parse_raw_news(X.raw_messages(spark, sf)))
    return good.select(doc_id(), "url", "title", "content", "source", "matched_feed_name", "seconds", "time_source",
                       "should_alert", joined("matched_keywords"))


@query
def process_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The processor from JSON messages to processed rows."""
    parsed = messages.parse_raw_news(X.raw_messages(spark, sf))
    return messages.process_messages(parsed, now=fixed_now()).select(
        doc_id(), "article_id", "raw_hash", "title", "summary", "category", joined("keywords"), "published_at",
        "should_alert")


@query
def processor_counters(spark: SparkSession, sf: str) -> DataFrame:
    parsed = messages.parse_raw_news(X.raw_messages(spark, sf))
    return articles.processor_counters(messages.checked(parsed))


@query
def topic_peek(spark: SparkSession, sf: str) -> DataFrame:
    return topics.peek(X.raw_messages(spark, sf), 25).select("partition", "offset", "key")


@query
def alt_process_articles(spark: SparkSession, sf: str) -> DataFrame:
    return articles.alt_process_articles(X.typed_raw_news(spark, sf), now=fixed_now()).select(
        "id", "title", "summary", "url", joined("keywords"), "category", "source", "timestamp", "processed_at")


@query
def alt_counters(spark: SparkSession, sf: str) -> DataFrame:
    return articles.alt_counters(X.typed_raw_news(spark, sf))


def alt_columns(rows: DataFrame) -> DataFrame:
    return rows.select("id", "title", "summary", "url", joined("keywords"), "category", "source", "timestamp", "processed_at")


@query
def alt_process_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The alternative job from JSON messages, some of them without a time."""
    raw = messages.raw_news(messages.parse_raw_news(X.raw_messages(spark, sf)))
    return alt_columns(articles.alt_process_articles(raw, now=fixed_now()))


@query
def alt_message_counters(spark: SparkSession, sf: str) -> DataFrame:
    return articles.alt_counters(messages.raw_news(messages.parse_raw_news(X.raw_messages(spark, sf))), now=fixed_now())


@query
def crawl_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Realtime outcomes of crawled rows, with several documents of a feed in one second."""
    rows = D.crawl(X.crawl_documents(spark, sf), registry(spark, sf))
    labelled = outcomes.realtime_outcomes(rows, X.STARTUP)
    return labelled.groupBy("feed_ord", "url", "published_ts", "outcome").agg(F.count("*").alias("rows"))


@query
def backfill_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of a backfill over fetched documents, and the rows it publishes."""
    docs, feeds = X.crawl_documents(spark, sf), registry(spark, sf)
    rows = plan_jobs.crawled(docs, feeds)
    kept = plan_jobs.backfill(docs, feeds, 3 * PER_FEED, None, DAYS, X.NOW, rows).groupBy("feed_ord").agg(F.count("*").alias("rows"))
    report = plan_jobs.backfill_report(docs, feeds, 3 * PER_FEED, None, DAYS, X.NOW, rows)
    return report.join(kept, "feed_ord", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def processed_messages(spark: SparkSession, sf: str) -> DataFrame:
    """processed_news messages, keyed by article, at the positions of their raw messages."""
    partition, offset = dedup.place_of(F.col("pos"))
    place = {"topic": F.lit("processed_news"), "partition": partition, "offset": offset}
    return messages.to_messages(processed(spark, sf), "article_id", ("raw_payload",), place)


@query
def storage_rows(spark: SparkSession, sf: str) -> DataFrame:
    """processed_news messages as rows of the storage table."""
    rows = storage.storage_rows(processed_messages(spark, sf))
    return rows.select(
        *[c for c in rows.columns if c not in ("keywords", "matched_keywords", "raw_payload_json")],
        joined("keywords"), joined("matched_keywords"),
        F.try_variant_get(F.parse_json("raw_payload_json"), "$.content", "string").alias("payload_content"))


@query
def storage_objects(spark: SparkSession, sf: str) -> DataFrame:
    """The writer over messages some of which are no JSON objects: these are left out, all others become rows."""
    rows = storage.storage_rows(X.raw_messages(spark, sf))
    return rows.select("source_topic", "kafka_partition", "kafka_offset", "title", "url", "should_alert", joined("matched_keywords"))


@query
def latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = storage.latest_rows(storage.storage_rows(processed_messages(spark, sf)))
    return rows.select("article_id", "source", "title", "published_at", "should_alert", "kafka_offset")


@query
def alert_outbox(spark: SparkSession, sf: str) -> DataFrame:
    """Alert messages for the articles whose feed rules ask for one."""
    rows = X.typed_raw_news(spark, sf).drop("should_alert", "matched_keywords")
    tagged = alerts.tag_articles(rows, registry(spark, sf))
    done = articles.process_articles(tagged, now=fixed_now())
    return alerts.alert_outbox(done, keep=("article_id",))


@query
def raw_alert_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Alert messages straight from raw_news: no summary, no category, flag sometimes absent."""
    read = messages.processed_news(X.raw_messages(spark, sf))
    return alerts.alert_outbox(read, keep=("kafka_partition", "kafka_offset"))


@query
def page_preview(spark: SparkSession, sf: str) -> DataFrame:
    """Plain text of whole web pages: decode, remove tags, collapse white space."""
    return X.table(spark, sf, "pages").select("page_id", H.preview(F.col("html")).alias("preview"))


@query
def escaped_pages(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "pages").select("page_id", H.escape(F.col("html")).alias("escaped"))


@query
def hashtag_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Hashtags from the first words of every conversation turn, with a source icon."""
    rows = X.table(spark, sf, "conversations").select("conv_id", "turn", "role", F.split("text", r"\. ").alias("words"))
    names = F.when(F.col("role") == "user", F.lit("VNExpress")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", hashtags(F.col("words")).alias("tags"), icon(names).alias("icon"))


@query
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Defaults, truthiness, list coercion and canonical JSON on event properties."""
    n = F.col("event_id") % 6
    more = (
        F.when(n == 0, F.lit(', "b": null, "a": "x"}')).when(n == 1, F.lit(', "b": [null, 1, "é", 2.0], "a": ""}'))
        .when(n == 2, F.lit(', "b": " ", "a": 0}')).when(n == 3, F.lit(', "b": "two words", "a": "false"}'))
        .when(n == 4, F.lit(', "b": true, "a": []}')).otherwise(F.lit("}"))
    )
    props = F.concat(F.regexp_replace("props", r"\}\s*$", ""), more)
    rows = X.table(spark, sf, "events").select("event_id", F.try_parse_json(props).alias("m"))
    a, b, k = (V.field(F.col("m"), name) for name in "abk")
    return rows.select(
        "event_id", V.text_or(a, "none").alias("a"), V.truthy(a).alias("a_true"), V.text_or(b, "none").alias("b"),
        F.array_join(V.text_list(b), "|").alias("b_list"), V.text_or(k).alias("k"),
        V.json_text(F.col("m")).alias("json"))


# Stored tables and streams ----------------------------------------------------------------


@query
def stored_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Append to a table twice, the second time in vain, and read its newest rows by SQL."""
    name = new_table(spark)
    rows = storage.storage_rows(processed_messages(spark, sf))
    tables.append_new(rows, name)
    tables.append_new(rows, name)
    return spark.sql(
        f"SELECT article_id, source, title, published_at, should_alert, kafka_offset FROM {name} "
        "ORDER BY kafka_offset DESC, kafka_partition DESC LIMIT 10")


def new_table(spark: SparkSession) -> str:
    config = tables.TableConfig(run_dir(spark, "warehouse"), namespace="newsloom",
                                table="processed_" + run_dir(spark, "t").rsplit("-", 1)[1])
    return tables.create_table(spark, config)


@query
def stored_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Batches appended with a ledger: two new ones, one that was appended but not noted, one that is delivered again, one from another query.

    What the ledger says of each partition, beside what the table holds.
    """
    name, ledger = new_table(spark), run_dir(spark, "ledger")
    rows = storage.storage_rows(processed_messages(spark, sf))
    folder = run_dir(spark, "rows")
    rows.write.parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    half = rows.agg(F.expr("approx_percentile(kafka_offset, 0.5)")).first()[0]
    early, late = rows.filter(F.col("kafka_offset") <= half), rows.filter(F.col("kafka_offset") > half)
    tables.append_batch(early, name, ledger, "store", 0, True)
    tables.append_new(late.filter("kafka_partition = 1"), name)  # the end of a run that did not come to its note
    tables.append_batch(late, name, ledger, "store", 1, True)
    tables.append_batch(late, name, ledger, "store", 1, False)
    tables.append_batch(rows, name, ledger, "other", 0, False)
    place = ["source_topic", "kafka_partition"]
    noted = tables.read_ledger(spark, ledger).groupBy(*place).agg(F.max("high").alias("high"), F.count("*").alias("batches"))
    held = tables.scan(spark, name).groupBy(*place).agg(F.count("*").alias("rows"), F.count_distinct("kafka_offset").alias("offsets"))
    return noted.join(held, place)


@query
def stored_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Create a table, append to it, find it in the catalog, and read two of its columns."""
    name = new_table(spark)
    added = tables.append_new(storage.storage_rows(processed_messages(spark, sf)), name)
    schema, table = name.rsplit(".", 1)
    found = tables.tables(spark, schema).filter(F.col("tableName") == table).count() * tables.schemas(spark).filter(F.col("namespace") == schema).count()
    counts = tables.scan(spark, name).groupBy("category").agg(F.count("*").alias("articles"))
    return counts.select("category", "articles", F.lit(added).cast("long").alias("appended"), F.lit(found).cast("long").alias("listed"))


@query
def stored_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Urls of two crawls saved one after the other; the latest come back to seed a window."""
    folder = run_dir(spark, "seen")
    tables.save_seen(X.seen_urls(spark, sf), folder)
    tables.save_seen(outcomes.registered_urls(X.raw_news(spark, sf)), folder)
    return tables.load_seen(spark, folder, 50).select("url_hash")


def stream_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream of its files. The path is a pattern, so it may be a file or a folder."""
    schema = X.table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/[{name[0]}]{name[1:]}.parquet")


def news_stream(spark: SparkSession, sf: str) -> DataFrame:
    return X.with_news_columns(stream_of(spark, sf, "documents").select("doc_id", "source", "text"))


def finished(rows: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there and return what it wrote."""
    folder = run_dir(rows.sparkSession, name)
    out = f"{folder}/out"
    jobs.Run(name, folder).start(rows.writeStream.format("parquet").option("path", out)).awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(out)


@query
def stream_first(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming form of dedup_first; which of two equal articles comes through is left open."""
    rows = articles.with_raw_hash(news_stream(spark, sf).select("url", "title"))
    return finished(state.first_stream(rows, "raw_hash"), "stream_first").select("raw_hash")


@query
def stream_window(spark: SparkSession, sf: str) -> DataFrame:
    """The window that holds every hash as a stream: state by key, exact however many there are."""
    rows = articles.with_raw_hash(news_stream(spark, sf).select("doc_id", "url", "title", "pos")).select("doc_id", "raw_hash", "pos")
    return finished(state.first_position_stream(rows, "raw_hash"), "stream_window").select("doc_id", "raw_hash")


EVICTING = 100
SLICE_ROWS = 2_000_000
SLICE_FILES = 8


def narrow_news(spark: SparkSession, sf: str) -> DataFrame:
    """Hash, source and position of every article, written once: a stream of it is fed in slices."""
    rows = articles.with_raw_hash(X.raw_news(spark, sf).select("doc_id", "source", "url", "title", "pos")).select("doc_id", "source", "raw_hash", "pos")
    folder = run_dir(spark, "narrow")
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def sliced(rows: DataFrame, by: str, stream: Callable[[DataFrame], DataFrame], name: str) -> tuple[DataFrame, str]:
    """Feed ``rows`` to a stream in slices of rising ``by``, the query being stopped and started again for each; what it wrote, and its checkpoint.

    At least four slices; more where one would hold over ``SLICE_ROWS`` rows.
    """
    spark, folder = rows.sparkSession, run_dir(rows.sparkSession, name)
    parts = max(4, -(-rows.count() // SLICE_ROWS))
    number = F.col(by).cast("double")
    cuts = sorted(set(rows.select(number.alias("n")).approxQuantile("n", [i / parts for i in range(1, parts)], 0.25 / parts)))

    def place(low: int, high: int) -> Column:
        """The slice of a row that lies in one of ``low`` to ``high``: the number of cuts it lies behind."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(number > cuts[middle], place(middle + 1, high)).otherwise(place(low, middle))

    # All slices are written in one pass, each as some files of its own, and so no slice is sought in the whole table.
    dealt = rows.filter(number.isNotNull() if cuts else F.lit(True)).withColumn("_slice", place(0, len(cuts)))
    dealt = dealt.repartition("_slice", F.pmod(F.xxhash64(by), F.lit(SLICE_FILES)))
    dealt.write.partitionBy("_slice").parquet(f"{folder}/slices")
    slices = spark.read.schema(dealt.schema).parquet(f"{folder}/slices")
    job = jobs.Run(name, folder)
    for i in range(len(cuts) + 1):
        slices.filter(F.col("_slice") == i).drop("_slice").write.mode("append").parquet(f"{folder}/in")
        out = stream(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"))
        job.start(out.writeStream.format("parquet").option("path", f"{folder}/out")).awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out"), job.checkpoint


def evicting(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    return sliced(narrow_news(spark, sf), "pos", lambda rows: state.window_stream(rows, "raw_hash", size=EVICTING, buckets="source"), "stream_window_evicts")


@query
def stream_window_evicts(spark: SparkSession, sf: str) -> DataFrame:
    """A window for each source so short that hashes leave it and come back, over several micro-batches and restarts."""
    return evicting(spark, sf)[0].select("doc_id", "source", "raw_hash")


@query
def stream_window_state(spark: SparkSession, sf: str) -> DataFrame:
    """The hashes these windows hold at the end, read back from the checkpoint."""
    held = state.held_hashes(spark, evicting(spark, sf)[1])
    return held.groupBy("url_hash").agg(F.count("*").alias("windows"))


@query
def stream_ttl_expiring(spark: SparkSession, sf: str) -> DataFrame:
    """dedup_ttl over micro-batches in order of time; a user's state goes by a timer when the watermark has passed its window."""
    events = X.table(spark, sf, "events").select(
        "event_id", "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"))
    return sliced(events, "seconds", lambda rows: state.ttl_stream(rows, "user_id", "seconds", "event_id", 6 * 3600, lateness=0), "stream_ttl_expiring")[0]


@query
def stream_ttl(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming form of dedup_ttl."""
    rows = stream_of(spark, sf, "events").select(
        "event_id", "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"))
    return finished(state.ttl_stream(rows, "user_id", "seconds", "event_id", 6 * 3600), "stream_ttl")


@query
def stream_alt(spark: SparkSession, sf: str) -> DataFrame:
    """The alternative job as a stream."""
    return alt_columns(finished(jobs.alt_stream(X.messages(news_stream(spark, sf)), now=fixed_now()), "stream_alt"))


@query
def stream_processor(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming processor over JSON messages."""
    envelope = X.messages(news_stream(spark, sf))
    rows = jobs.processed_stream(envelope, window=None, now=fixed_now())
    return finished(rows, "stream_processor").select(
        doc_id(), "article_id", "raw_hash", "title", "summary", "category", joined("keywords"), "published_at",
        "should_alert")


def run_job(start: Callable[..., StreamingQuery], spark: SparkSession, sf: str, name: str, **options) -> tuple[str, str, StreamingQuery]:
    """Run a job with two exits over all messages: its topic, its quarantine, and the finished query."""
    folder = run_dir(spark, name)
    out, bad = f"{folder}/processed_news", f"{folder}/bad"
    done = start(X.messages(news_stream(spark, sf)), out, jobs.Run(name, folder), quarantine=bad, now=fixed_now(), **options)
    done.awaitTermination()
    return out, bad, done


def exits(spark: SparkSession, out: str, bad: str, own: str) -> DataFrame:
    """The document of every message a job has sent or set apart, and why; ``own``: where a sent message has the document's number."""
    sent = topics.file_batch(spark, out).select(F.get_json_object("value", own).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("reason"))
    return sent.unionByName(jobs.read_quarantine(spark, bad).select((F.col("offset") * 4 + F.col("partition")).alias("doc_id"), "reason"))


@query
def stream_exits(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming processor in one pass: articles to the topic, bad messages to quarantine."""
    out, bad, _ = run_job(jobs.start_processor, spark, sf, "stream_exits", window=None)
    return exits(spark, out, bad, "$.raw_payload.id")


@query
def stream_alt_exits(spark: SparkSession, sf: str) -> DataFrame:
    """The alternative job in one pass, with a quarantine of its own."""
    out, bad, _ = run_job(jobs.start_alt_processor, spark, sf, "stream_alt_exits")
    return exits(spark, out, bad, "$.id")


@query
def stream_counters(spark: SparkSession, sf: str) -> DataFrame:
    """What the processor has counted as it ran: all messages, articles it published, duplicates it dropped, errors."""
    done = run_job(jobs.start_processor, spark, sf, "stream_counters", window=None)[2]
    seen = metrics.counters(done)
    read, unique = seen["stream_counters_read"], seen["stream_counters_unique"]
    published = unique["total"] - unique["errors"]
    row = (read["total"], published, read["total"] - read["errors"] - published, read["errors"])
    return spark.createDataFrame([row], "total long, published long, dropped_duplicates long, errors long")
