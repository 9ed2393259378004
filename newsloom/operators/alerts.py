"""Feed keyword rules on articles, the alert filter and the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.alerts import alert_message, feed_alert, message_preview
from newsloom.functions.rules import match_text
from newsloom.operators.joins import join_small


def with_alert(articles: DataFrame) -> DataFrame:
    """Replace the ``include_keywords`` and ``exclude_keywords`` of an article's feed by
    ``should_alert`` and ``matched_keywords``. Articles without a feed get no alert."""
    texts = articles.withColumn("_text", match_text(F.col("title"), F.col("content")))
    alert = F.when(F.col("include_keywords").isNotNull(),
                   feed_alert(F.col("_text"), F.col("include_keywords"), F.col("exclude_keywords")))
    return (
        texts.withColumn("_alert", alert)
        .withColumn("should_alert", F.coalesce("_alert.should_alert", F.lit(False)))
        .withColumn("matched_keywords", F.coalesce("_alert.matched_keywords", F.array().cast("array<string>")))
        .drop("_alert", "_text", "include_keywords", "exclude_keywords")
    )


def tag_articles(articles: DataFrame, feeds: DataFrame, spread: str = "pos") -> DataFrame:
    """Add ``should_alert`` and ``matched_keywords`` by the rules of each article's feed; no
    row is dropped."""
    lists = feeds.select(F.col("name").alias("source"), "include_keywords", "exclude_keywords")
    return with_alert(join_small(articles, lists, "source", "left", spread))


def wants_alert(should_alert: Column, only_matched: bool = True) -> Column:
    """Rows whose flag is false are skipped; rows without a flag (null) are sent."""
    return F.coalesce(should_alert, F.lit(True)) if only_matched else F.lit(True)


def alert_outbox(processed: DataFrame, only_matched: bool = True, keep: tuple[str, ...] = ("article_id",)) -> DataFrame:
    """Message rows for the articles that should be sent.

    ``content`` is used only where the table has no summary for the row.
    """
    content = F.col("content") if "content" in processed.columns else F.lit(None).cast("string")
    sent = processed.filter(wants_alert(F.col("should_alert"), only_matched))
    previewed = sent.withColumn("_preview", message_preview(F.col("summary"), content))
    empty = F.array().cast("array<string>")
    message = alert_message(
        F.col("title"), F.col("_preview"), F.coalesce("url", F.lit("")), F.coalesce("source", F.lit("")),
        F.coalesce("category", F.lit("")), F.coalesce("keywords", empty),
    )
    return previewed.select(*keep, message.alias("message"))
