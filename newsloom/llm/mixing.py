"""Mix sources to target weights: whole copies for certain, Pareto order sampling for the rest.

Each source has a target number of words. The expected copies of a document are its importance
times a constant of its source, at most ``MOST``; the constant meets the target. The whole
part is taken for certain. The rest, a probability p, is drawn by Pareto sampling:
documents are ranked by the odds of a random number over the odds of p, and the
lowest ranks are taken until the words left to the source are spent, so the size of
the sample is fixed, whatever the draw.

No source is sorted as a whole. Ranks lie between 0 and 1; words are summed in
``CELLS`` cells of that range, and only documents of the one cell in which
the words of a source run out are sorted. What comes out is one small row for each source and
importance level, with the rank at which taking stops; applying it to the documents
is a join with that table, without a shuffle while the table is small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.shared import saved, words

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3            # copies of a document at most
CELLS = 4096
STEPS, LIMIT = 8, 80  # importance is rounded to 2^(n/8), n between -80 and 80
SEED = 17


def filled(items: DataFrame, by: list[str], cap: str, weight: str, total: str, into: str) -> DataFrame:
    """Share ``total`` within each group ``by`` in proportion to ``weight``, nobody above ``cap``; what is over goes to the rest.

    With the items in order of cap over weight, the fair level if all before an item are
    at their cap rises up to the right one and falls after it, so the right one is
    the greatest. One row for each item and group; items without weight get 0.
    """
    fair = F.when(F.col(weight) > 0, F.col(cap) / F.col(weight)).otherwise(math.inf)
    order = Window.partitionBy(*by).orderBy("_fair", F.col(weight).desc())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col(total) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    level = F.when(F.sum(weight).over(rest) > 0, left / F.sum(weight).over(rest))
    rows = items.withColumn("_fair", fair).withColumn("_level", level)
    best = F.greatest(F.coalesce(F.max("_level").over(Window.partitionBy(*by)), F.lit(0.0)), F.lit(0.0))
    return rows.withColumn(into, F.least(F.col(cap), best * F.col(weight))).drop("_fair", "_level")


def level_of(importance: Column | None) -> Column:
    """Importance as a power step; missing or not positive counts as 1."""
    if importance is None:
        return F.lit(0)
    step = F.round(F.log2(F.when(importance > 0, importance).otherwise(1.0)) * STEPS)
    return F.coalesce(F.least(F.greatest(step, F.lit(-LIMIT)), F.lit(LIMIT)).cast("int"), F.lit(0))


def _uniform(doc_id: str, seed: int) -> Column:
    """A number in (0, 1) from the id."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id)), 12) + 0.5) / F.lit(float(1 << 52))


def _rank(doc_id: str, seed: int) -> Column:
    """Pareto rank, drawn into 0..1: q / (1 + q) for q = odds of the random number over odds of ``part``."""
    u, p = _uniform(doc_id, seed), F.col("part")
    return u * (1 - p) / (u * (1 - p) + (1 - u) * p)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to rows (source, source_size), one a source.

    Sources in code-point order, null last, have the weights in turn; they share all words,
    none gets more than ``most`` times its own. Sources are a short list, so
    two windows over them all are small.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int"))
    rows = sizes.withColumn("_weight", weight).withColumn("_cap", most * F.col("source_size").cast("double"))
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("double").alias("_total"))
    # One row: the sum of what is joined to.
    rows = rows.join(F.broadcast(total), F.lit(True), "left")
    return filled(rows, [], "_cap", "_weight", "_total", "target").drop("_weight", "_cap", "_total")


def plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """What to take, by (source, level), from narrow rows (doc_id, source, size, level).

    Columns: source_size, target, certain (whole copies), part (probability of one more), low,
    high and extra: one more is taken where the rank is below ``low``, not above ``high``, or ``extra``.
    """
    cells = saved(sized.groupBy("source", "level").agg(F.sum("size").alias("words")), "mix-words")
    sources = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    levels = cells.withColumnRenamed("source", "_s").join(sources, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    levels = levels.withColumn("_cap", most * F.col("words").cast("double")).withColumn(
        "_weight", F.col("words") * F.pow(F.lit(2.0), F.col("level") / STEPS))
    levels = filled(levels, ["source"], "_cap", "_weight", "target", "_given")
    mean = F.when(F.col("words") > 0, F.least(F.col("_given") / F.col("words"), F.lit(float(most)))).otherwise(0.0)
    # A share that rounding left a hair below a whole number is that number.
    whole = F.floor(mean + 1e-9)
    levels = saved(levels.select("source", "level", "words", "source_size", "target", whole.cast("long").alias("certain"),
                                 F.greatest(mean - whole, F.lit(0.0)).alias("part")), "mix-levels")

    drawn = _joined(sized, levels).filter((F.col("part") > 0) & (F.col("size") > 0)).select("doc_id", "source", "size", _rank("doc_id", seed).alias("rank"))
    drawn = drawn.withColumn("cell", F.least(F.floor(F.col("rank") * CELLS), F.lit(CELLS - 1)))
    order = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = drawn.groupBy("source", "cell").agg(F.sum("size").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    left = levels.groupBy(F.col("source").alias("_s")).agg((F.first("target") - F.sum(F.col("certain") * F.col("words"))).alias("left"))
    ends = sums.join(left, F.col("source").eqNullSafe(F.col("_s"))).filter("before <= left and left < before + n")
    ends = saved(ends.select("_s", F.col("cell").alias("end"), "before", "left"), "mix-ends")
    last = drawn.join(ends, F.col("source").eqNullSafe(F.col("_s")) & (F.col("cell") == F.col("end")))
    inside = Window.partitionBy("source").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    reached = last.withColumn("got", F.col("before") + F.sum("size").over(inside)).filter("got <= left")
    high = reached.groupBy(F.col("source").alias("_h")).agg(F.max("rank").alias("high"), F.max("got").alias("got"))
    stops = ends.join(high, F.col("_s").eqNullSafe(F.col("_h")), "left").select(
        "_s", "end", (F.col("end") / CELLS).alias("low"), F.coalesce("high", F.lit(-1.0)).alias("high"),
        (F.col("left") - F.coalesce("got", "before")).alias("gap"))
    # One row a source, written, so the planner knows how small it is and does not shuffle a hot source to it.
    stops = saved(stops, "mix-stops")
    # What is left is smaller than the next document: the remaining one nearest in size closes the gap.
    over = drawn.join(stops, F.col("source").eqNullSafe(F.col("_s"))).filter(
        "rank >= low and rank > high and size < 2 * gap").withColumn("_far", F.abs(F.col("size") - F.col("gap")))
    extra = over.groupBy(F.col("source").alias("_e")).agg(F.min(F.struct("_far", "rank")).getField("rank").alias("extra"))
    planned = levels.join(stops, F.col("source").eqNullSafe(F.col("_s")), "left").join(extra, F.col("source").eqNullSafe(F.col("_e")), "left")
    # Without an end, the words of all drawn documents do not fill what is left: all are taken.
    return saved(planned.select("source", "level", "source_size", "target", "certain", "part", F.coalesce("low", F.lit(2.0)).alias("low"),
                                F.coalesce("high", F.lit(-1.0)).alias("high"), F.coalesce("extra", F.lit(-1.0)).alias("extra")), "mix-plan")


def _joined(rows: DataFrame, small: DataFrame) -> DataFrame:
    """Rows with their source and level's row of a small table that was written out, so its size is known to the planner."""
    side = small.withColumnsRenamed({"source": "_source", "level": "_level"})
    return rows.join(side, F.col("source").eqNullSafe(F.col("_source")) & (F.col("level") == F.col("_level"))).drop("_source", "_level")


def _copies(seed: int) -> Column:
    rank = _rank("doc_id", seed)
    more = (F.col("part") > 0) & ((rank < F.col("low")) | (rank <= F.col("high")) | (rank == F.col("extra")))
    return F.col("certain") + more.cast("long")


def sizes(docs: DataFrame, importance: Column | None = None) -> DataFrame:
    """Narrow rows (doc_id, source, size, level); size is the number of words, 0 for null."""
    return saved(docs.select("doc_id", "source", words("text").alias("size"), level_of(importance).alias("level")), "mix-sizes")


def taken(docs: DataFrame, importance: Column | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row.

    Rows of a null source form a source of their own; null ids are drawn by one
    common random number, repeated rows alike. Empty texts are taken like others
    and count 0 words. An empty table gives an empty result.
    """
    sized = sizes(docs, importance)
    rows = _joined(sized, plan(sized, seed=seed)).withColumn("copies", _copies(seed))
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, importance: Column | None = None, seed: int = SEED) -> DataFrame:
    """The documents, each as often as the mix takes it; all columns kept."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", level_of(importance).alias("level"))
    rows = _joined(rows, plan(sizes(docs, importance), seed=seed)).select("row", _copies(seed).alias("times")).filter("times > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")
