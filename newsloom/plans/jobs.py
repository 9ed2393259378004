"""Batch jobs with the parameters a user sets."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from newsloom.session import run_dir
from newsloom.operators.limits import backfill_counters, select_backfill
from newsloom.sources.documents import crawl


def positive(value: int | None, name: str) -> int | None:
    if value is not None and value <= 0:
        raise ValueError(f"{name} must be > 0, not {value}")
    return value


def _now(now: int | None) -> int:
    return int(time.time()) if now is None else now


def _checked(per_feed_limit: int | None, total_limit: int | None, days: int | None) -> dict[str, int | None]:
    return {
        "per_feed": positive(per_feed_limit, "per_feed_limit"),
        "total": positive(total_limit, "total_limit"),
        "days": positive(days, "days"),
    }


def crawled(documents: DataFrame, feeds: DataFrame) -> DataFrame:
    """All entries, parsed once and written: the selection and the counters read them several times."""
    rows = crawl(documents, feeds)
    folder = run_dir(rows.sparkSession, "crawled")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def backfill(documents: DataFrame, feeds: DataFrame, per_feed_limit: int | None = None,
             total_limit: int | None = None, days: int | None = None, now: int | None = None,
             rows: DataFrame | None = None) -> DataFrame:
    """raw_news rows of one historical pass over all feeds; earlier urls are not looked at.

    ``rows`` are those of :func:`crawled`, where the caller has them.
    """
    limits = _checked(per_feed_limit, total_limit, days)
    return select_backfill(crawled(documents, feeds) if rows is None else rows, _now(now), pos="feed_pos", **limits)


def backfill_report(documents: DataFrame, feeds: DataFrame, per_feed_limit: int | None = None,
                    total_limit: int | None = None, days: int | None = None, now: int | None = None,
                    rows: DataFrame | None = None) -> DataFrame:
    """Counters per feed for :func:`backfill`."""
    limits = _checked(per_feed_limit, total_limit, days)
    return backfill_counters(crawled(documents, feeds) if rows is None else rows, _now(now), pos="feed_pos", **limits)
