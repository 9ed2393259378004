"""Backfill selection: age, per-feed limit, total limit, and its counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from pyspark.sql.window import Window

from newsloom.operators.joins import join_sized
from newsloom.session import run_dir

DAY = 86400

# Positions are counted in blocks first; only rows of the one block per feed in which a limit falls
# are ranked. A block is 2^16 positions, or the entries of one document.
BLOCK_BITS = 16
ENTRIES = 10 ** 8
FEED_BYTES = 64  # more than a narrow row of one feed takes


def recent_enough(published_ts: Column, now: int, days: int | None) -> Column:
    """True for rows of the last ``days`` days and for rows without a time."""
    if days is None:
        return F.lit(True)
    return published_ts.isNull() | (published_ts >= now - days * DAY)


def _block(rows: DataFrame, pos: str) -> Column:
    if isinstance(rows.schema[pos].dataType, DecimalType):  # feed_position
        return F.floor(F.col(pos) / F.lit(ENTRIES).cast("decimal(9,0)")).alias("block")
    return F.shiftright(F.col(pos).cast("long"), BLOCK_BITS).alias("block")


def block_counts(rows: DataFrame, fresh: Column, feed: str, pos: str) -> DataFrame:
    """Rows of each (feed, block) that pass ``fresh`` (``eligible``) and that do not (``old``).

    The one pass over all rows: quotas, the blocks in which they end and the counters come from this narrow table,
    which is written once and read back.
    """
    counts = rows.groupBy(feed, _block(rows, pos)).agg(F.count_if(fresh).alias("eligible"), F.count_if(~fresh).alias("old"))
    folder = run_dir(rows.sparkSession, "block-counts")
    counts.write.parquet(folder)
    return rows.sparkSession.read.schema(counts.schema).parquet(folder)


def _per_feed(blocks: DataFrame, feed: str) -> DataFrame:
    return blocks.groupBy(feed).agg(F.sum("eligible").alias("eligible"), F.sum("old").alias("old"))


def feed_quotas(counts: DataFrame, feed: str, per_feed: int | None, total: int | None) -> DataFrame:
    """Add to the ``eligible`` rows per feed those wanted under the per-feed limit, those
    wanted by earlier feeds, and the quota left after the total limit. One row a feed."""
    wanted = counts.withColumn("wanted", F.least("eligible", F.lit(per_feed)) if per_feed else F.col("eligible"))
    # Feeds are a registry-sized list, so one window over them all is small.
    order = Window.orderBy(feed).rowsBetween(Window.unboundedPreceding, -1)
    running = wanted.withColumn("earlier", F.coalesce(F.sum("wanted").over(order), F.lit(0)))
    if total is None:
        return running.withColumn("quota", F.col("wanted"))
    left = F.greatest(F.lit(total) - F.col("earlier"), F.lit(0))
    return running.withColumn("quota", F.least("wanted", left))


def _cuts(blocks: DataFrame, quotas: DataFrame, feed: str) -> DataFrame:
    """The block in which the quota of each feed ends (``_cut``), the rows wanted from it (``_left``), and the old rows before it."""
    order = Window.partitionBy(feed).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(feed, "block", F.coalesce(F.sum("eligible").over(order), F.lit(0)).alias("before"),
                           F.coalesce(F.sum("old").over(order), F.lit(0)).alias("old_before"))
    return (
        before.join(quotas.select(feed, "quota"), feed)
        .filter("before < quota")
        .groupBy(feed)
        .agg(F.max(F.struct("block", (F.col("quota") - F.col("before")).alias("left"), "old_before")).alias("cut"))
        .select(feed, F.col("cut.block").alias("_cut"), F.col("cut.left").alias("_left"), F.col("cut.old_before").alias("_old_before"))
    )


def _with_feed(rows: DataFrame, small: DataFrame, feeds: int, feed: str, pos: str) -> DataFrame:
    """Join with a table of at most one narrow row for each of ``feeds`` feeds."""
    return join_sized(rows, small, feed, feeds * FEED_BYTES, spread=pos)


def first_rows(rows: DataFrame, blocks: DataFrame, quotas: DataFrame, feeds: int, feed: str, pos: str) -> DataFrame:
    """The first ``quota`` rows of every feed by ``pos``.

    The block counts tell in which block a feed's quota ends. Only feed and position of the rows
    of that block are ranked; what comes out is one last position a feed, and the
    rows up to it are kept in the scan. Whole rows are not shuffled.
    """
    rank = F.row_number().over(Window.partitionBy(feed).orderBy(pos))
    ends = (
        _with_feed(rows.select(feed, pos, _block(rows, pos)), _cuts(blocks, quotas, feed), feeds, feed, pos)
        .filter("block = _cut")
        .withColumn("_rank", rank)
        .filter("_rank <= _left")
        .groupBy(feed)
        .agg(F.max(pos).alias("_end"))
    )
    return _with_feed(rows, ends, feeds, feed, pos).filter(F.col(pos) <= F.col("_end")).drop("_end")


def select_backfill(rows: DataFrame, now: int, per_feed: int | None = None, total: int | None = None,
                    days: int | None = None, feed: str = "feed_ord", pos: str = "entry_pos") -> DataFrame:
    """Rows a backfill publishes: age filter, then the per-feed limit, then the total limit,
    feeds in registry order and entries in document order."""
    fresh = recent_enough(F.col("published_ts"), now, days)
    eligible = rows.filter(fresh)
    if per_feed is None and total is None:
        return eligible
    blocks = block_counts(rows, fresh, feed, pos)
    counts = _per_feed(blocks, feed)
    return first_rows(eligible, blocks, feed_quotas(counts, feed, per_feed, total), counts.count(), feed, pos)


def backfill_counters(rows: DataFrame, now: int, per_feed: int | None = None, total: int | None = None,
                      days: int | None = None, feed: str = "feed_ord", pos: str = "entry_pos") -> DataFrame:
    """published, skip_old and skip_per_feed_limit per feed, for the feeds the backfill reached.

    The run stops at the first row beyond the total limit; older rows behind
    that point in the same feed are not counted, and later feeds have no row.
    """
    fresh = recent_enough(F.col("published_ts"), now, days)
    blocks = block_counts(rows, fresh, feed, pos)
    feeds = feed_quotas(_per_feed(blocks, feed), feed, per_feed, total)
    published = [feed, F.col("quota").alias("published")]
    limited = (F.col("eligible") - F.col("wanted")).alias("skip_per_feed_limit")
    if total is None:
        return feeds.select(*published, F.col("old").alias("skip_old"), limited)
    # The feed that stops the run, and the block of the row at which it stops: one row, or none.
    stopping = feeds.filter("quota < wanted").orderBy(feed).limit(1).select(feed, (F.col("quota") + 1).alias("quota"))
    stop = _cuts(blocks.join(F.broadcast(stopping.select(feed)), feed, "left_semi"), stopping, feed).first()
    if stop is None:
        return feeds.select(*published, F.col("old").alias("skip_old"), limited)
    # Of the rows of that one block: the old ones before the stopping row.
    inside = rows.filter((F.col(feed) == stop[feed]) & (_block(rows, pos) == F.lit(stop["_cut"]))).select(pos, fresh.alias("_fresh"))
    nth = F.sum(F.col("_fresh").cast("long")).over(Window.orderBy(pos).rowsBetween(Window.unboundedPreceding, -1))
    seen_old = inside.withColumn("_before", F.coalesce(nth, F.lit(0))).filter(~F.col("_fresh") & (F.col("_before") < stop["_left"]))
    last = F.col(feed) == stop[feed]
    old = F.lit(stop["_old_before"] + seen_old.count())
    return feeds.filter(F.col(feed) <= stop[feed]).select(
        *published, F.when(last, old).otherwise(F.col("old")).alias("skip_old"),
        F.when(last, F.lit(0)).otherwise(F.col("eligible") - F.col("wanted")).alias("skip_per_feed_limit"))


def with_grand_total(counters: DataFrame, feed: str = "feed_ord") -> DataFrame:
    """The counters with one more row, feed null, that holds the sums."""
    names = ["published", "skip_old", "skip_per_feed_limit"]
    return counters.rollup(feed).agg(*[F.sum(n).alias(n) for n in names])
