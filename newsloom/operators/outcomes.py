"""Realtime outcome of every crawled row, and outcome counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import url_fingerprint
from newsloom.operators.dedup import flag_repeats

PUBLISHED, OLD, NO_TIME, REPEATED = "published", "skip_old", "skip_no_ts", "skip_dedup"


def realtime_outcome(repeated: Column, published_ts: Column, startup_ts: int | Column) -> Column:
    """The url check comes first, then the missing time, then the age; a row published
    at start-up time passes."""
    return (
        F.when(repeated, F.lit(REPEATED))
        .when(published_ts.isNull(), F.lit(NO_TIME))
        .when(published_ts < startup_ts, F.lit(OLD))
        .otherwise(F.lit(PUBLISHED))
    )


def realtime_outcomes(rows: DataFrame, startup_ts: int, seen: DataFrame | None = None, pos: str = "pos") -> DataFrame:
    """Label rows of one crawl. ``seen`` holds the ``url_hash`` values of earlier crawls.

    Skipped rows register their url as well, so the next crawl's ``seen`` is
    ``registered_urls`` of all rows so far.
    """
    keyed = rows.withColumn("url_hash", url_fingerprint(F.col("url")))
    flagged = flag_repeats(keyed, "url_hash", pos, seen, flag="_repeated")
    outcome = realtime_outcome(F.col("_repeated"), F.col("published_ts"), startup_ts)
    return flagged.withColumn("outcome", outcome).drop("_repeated")


def registered_urls(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """Url hashes in the order of their first row: the state after a crawl."""
    keyed = rows.select(url_fingerprint(F.col("url")).alias("url_hash"), F.col(pos).alias("seq"))
    return keyed.groupBy("url_hash").agg(F.min("seq").alias("seq"))


def latest_urls(seen: DataFrame, size: int) -> DataFrame:
    """The ``size`` most recently registered hashes, to seed a bounded state."""
    return seen.orderBy(F.desc("seq"), "url_hash").limit(size)


def realtime_counters(labelled: DataFrame) -> DataFrame:
    """One row: published, skip_old, skip_no_ts, skip_dedup."""
    return labelled.agg(*[
        F.count_if(F.col("outcome") == name).alias(name) for name in (PUBLISHED, OLD, NO_TIME, REPEATED)
    ])
