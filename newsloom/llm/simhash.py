"""Near-duplicates by SimHash: balls of half the radius around every fingerprint meet in the middle.

Two fingerprints that differ in at most 4 bits have a value between them that
differs from either in at most 2. So every distinct fingerprint emits all
values within 2 bits of it, and those that emit the same value are within 4.
All owners of a value link to the least of them, which loses no
connection and makes no pairs.

A fingerprint has 2,081 such values. They are not shuffled one by one: the
first ``STEP`` bits of the values are emitted as rows (79 for each
fingerprint) and name a bucket; the rest of each value is made inside the
bucket's task. A bucket whose values would not fit in a task is
emitted again by its next bits, down to single values, which no more than 2,081
fingerprints can own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.components import components, local_roots
from newsloom.llm.shared import saved

SHINGLE = 4
SEED = 42
BITS = 64
REACH = 2  # half of the radius of 4
STEP = 12
BUCKET_VALUES = 4_000_000  # values made at a time in one task: 32 MB
COUNTED = 65_536  # shingles whose bits are counted at a time


def fingerprint(text: str | None) -> int:
    """SimHash of a text's word shingles, as a signed long.

    Letters A-Z are lower-cased; a shorter text is one shingle; without a
    word the result is 0.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    several = [digest(b" ".join(parts[i:i + SHINGLE]), SEED) for i in range(max(1, len(parts) - SHINGLE + 1))]
    hashes = np.array(several, dtype=">u8")
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at:at + COUNTED].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes)).view(">i8")[0])


def fingerprints(text: str) -> Column:
    """Column of :func:`fingerprint`, computed once for each row."""
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t) for t in texts], dtype="int64")
    return run.asNondeterministic()(F.col(text))


def _masks(bits: int, flips: int) -> np.ndarray:
    """All values of ``bits`` bits with exactly ``flips`` set."""
    return np.array([sum(1 << b for b in chosen) for chosen in combinations(range(bits), flips)], dtype=np.uint64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _prefix(bits: int) -> int:
    return _signed(((1 << bits) - 1) << (BITS - bits) & (1 << 64) - 1)


def _expand(rows: DataFrame, used: int, step: int) -> DataFrame:
    """Emit each row of (bucket, fp) once for each choice of the next ``step`` bits still in reach.

    ``bucket`` holds the first ``used`` bits of the value.
    """
    shift = BITS - used - step
    masks = [int(m) << shift for k in range(REACH + 1) for m in _masks(step, k)]
    window = F.lit(_signed((((1 << step) - 1) << shift) & (1 << 64) - 1)).cast("long")
    # One generator over a constant array; the filter keeps what is in reach.
    flipped = F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask")
    grown = rows.select("bucket", "fp", flipped).select(
        F.col("bucket").bitwiseOR(F.col("fp").bitwiseXOR(F.col("mask")).bitwiseAND(window)).alias("bucket"), "fp")
    return grown.filter(_flips(used + step) <= REACH) if used else grown


def _flips(used: int) -> Column:
    """Bits in which the first ``used`` bits of value and fingerprint differ."""
    return F.bit_count(F.col("bucket").bitwiseXOR(F.col("fp")).bitwiseAND(F.lit(_prefix(used)).cast("long")))


def _links(frame: pd.DataFrame, used: int, masks: list[np.ndarray]) -> pd.DataFrame:
    """Links (node, root) among the fingerprints of one bucket. ``masks``: by number of flips."""
    owners = np.sort(frame["fp"].to_numpy().astype(np.int64))
    bucket = np.uint64(int(frame["bucket"].iloc[0]) & (1 << 64) - 1)
    rest = np.uint64((1 << BITS - used) - 1)
    bare = owners.view(np.uint64)
    left = REACH - np.bitwise_count((bare ^ bucket) & ~rest).astype(int)
    values, names = [], []
    for flips in range(REACH + 1):
        own = np.flatnonzero(left >= flips)
        values.append(((bare[own] & rest)[:, None] ^ masks[flips][None, :]).ravel())
        names.append(np.repeat(own, len(masks[flips])))
    values, names = np.concatenate(values), np.concatenate(names)
    order = np.argsort(values)
    values, names = values[order], names[order]
    begins = np.r_[True, values[1:] != values[:-1]]
    least = np.minimum.reduceat(names, np.flatnonzero(begins))[np.cumsum(begins) - 1]
    near = (least != names) & (np.bitwise_count(bare[least] ^ bare[names]) <= 2 * REACH)
    root = local_roots(names[near], least[near], len(owners))
    moved = np.flatnonzero(root != np.arange(len(owners)))
    return pd.DataFrame({"node": owners[moved], "root": owners[root[moved]]})


def _bucket_links(used: int):
    masks = [_masks(BITS - used, flips) for flips in range(REACH + 1)]
    return lambda frame: _links(frame, used, masks)


def links(distinct: DataFrame, limit: int = BUCKET_VALUES, step: int = STEP) -> DataFrame:
    """Links (node, root), node > root, that connect all fingerprints within 4 bits of each other.

    ``distinct`` has the long ``fp``, each once. Every bucket's task makes at most
    ``limit`` values, or holds one single value.
    """
    rows = distinct.select(F.lit(0).cast("long").alias("bucket"), F.col("fp"))
    found, used = None, 0
    while True:
        width = min(step, BITS - used)
        rows = _expand(rows, used, width)
        used += width
        last = used == BITS
        heavy = None
        if not last:
            inside = BITS - used
            made = [sum(len(_masks(inside, k)) for k in range(REACH + 1 - flips)) for flips in range(REACH + 1)]
            weight = F.element_at(F.array(*[F.lit(m) for m in made]), _flips(used) + 1)
            heavy = saved(rows.groupBy("bucket").agg(F.sum(weight).alias("n")).filter(F.col("n") > limit).select("bucket"), "heavy")
            if heavy.isEmpty():
                heavy = None
        light = rows if heavy is None else rows.join(heavy, "bucket", "left_anti")
        # A given number of partitions, as AQE sees the narrow rows but not the values made from them.
        tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        now = light.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(_bucket_links(used), "node long, root long")
        found = now if found is None else found.unionByName(now)
        if heavy is None:
            return found
        rows = rows.join(heavy, "bucket", "left_semi")


def roots(distinct: DataFrame) -> DataFrame:
    """(node, root) for every fingerprint that is not the least of its component."""
    return components(links(distinct))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint and component of every row: (``doc_id``, fp, component_id).

    ``component_id`` is the smallest id reachable over links. Null and empty
    texts have fingerprint 0 and link like others; rows with a null id keep
    their place, but never name a component unless all ids in it are null. Repeated
    rows each get a row. Other columns of ``docs`` are not read. An empty table gives an
    empty result.
    """
    marked = saved(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(text).alias("fp")), "fingerprints")
    first = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    named = first.join(roots(first).withColumnRenamed("node", "fp"), "fp", "left")
    named = saved(named.withColumn("root", F.coalesce("root", "fp")), "rooted")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = named.join(smallest, "root").select("fp", "component_id")
    return marked.join(of, "fp", "left").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: the one with the smallest id, ties by text; all columns kept.

    Rows of one fingerprint are cut to one in the map tasks, so a large group
    of copies does not travel.
    """
    order = Window.partitionBy("fp").orderBy(F.col("first").asc_nulls_last(), F.col("text").asc_nulls_last())
    wide = docs.select(F.struct("*").alias("row"), fingerprints(text).alias("fp"), F.col(doc_id).alias("first"), F.col(text).alias("text"))
    wide = wide.withColumn("rank", F.row_number().over(order)).filter("rank = 1")
    wide = saved(wide.select("row", "fp", "first"), "one-a-fingerprint")
    first = wide.select("fp", "first")
    named = first.join(roots(first).withColumnRenamed("node", "fp"), "fp", "left")
    named = saved(named.withColumn("root", F.coalesce("root", "fp")), "rooted")
    # The member with the smallest id stays; a null id comes last.
    best = named.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("a"), "first", "fp")).alias("best"))
    gone = named.join(best, "root").filter(F.col("fp") != F.col("best.fp")).select("fp")
    return wide.join(gone, "fp", "left_anti").select("row.*")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
