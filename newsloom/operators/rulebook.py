"""Keyword rules of any size: texts meet a rules table by shuffle, through the keywords' rarest grams.

A keyword occurs in a text only if all its grams do, so one gram is enough to find the pair: the one that the fewest texts hold.
Rules never come to the driver and are never broadcast; only a bit map of fixed size is, which spares grams
that no rule is filed under a way through the shuffle. What meets is verified with ``contains``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.rules import DEFAULT_CATEGORY

GRAM = 4              # letters of a gram; a shorter keyword is one gram
MAP_BITS = 1 << 23    # bits of the map of grams: 1 MB, whatever the rules' number


def _grams(word: Column) -> Column:
    """Distinct grams of a keyword; an empty one is its own gram."""
    size = F.least(F.length(word), F.lit(GRAM))
    places = F.sequence(F.lit(1), F.length(word) - size + 1)
    return F.array_distinct(F.transform(places, lambda at: F.substring(word, at, size)))


def _slots(text: str, size: int) -> np.ndarray:
    """Slot of the gram that begins at each letter, all at once: a polynomial of the letters' code points, mixed."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    total = np.full(max(0, len(points) - size + 1), np.uint64(size), dtype=np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + points[i:i + len(total)]
    total ^= total >> np.uint64(29)
    return ((total * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 23)).astype(np.int64)


def _bit_map(grams: DataFrame) -> np.ndarray:
    """One bit for each slot a gram falls in. At most ``MAP_BITS`` bits come to the driver."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [int(_slots(gram, len(gram))[0]) for gram in batch.column("gram").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64())], ["slot"])

    slot = F.col("slot") + 1  # these functions count from 1
    placed = grams.select("gram").mapInArrow(place, "slot long")
    parts = placed.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    bits = np.zeros(MAP_BITS, dtype=bool)
    for part in parts:
        own = np.unpackbits(np.frombuffer(part.bits, dtype=np.uint8), bitorder="little").astype(bool)
        begin = (part.bucket - 1) * len(own)
        bits[begin:begin + len(own)] |= own
    return np.packbits(bits, bitorder="little")


def _text_grams(rows: DataFrame, sizes: list[int], wanted: np.ndarray) -> DataFrame:
    """(id, gram): the different grams of every text that may be among the wanted ones."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted, bitorder="little").astype(bool)
        for batch in batches:
            places, grams = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if text is None:
                    continue
                own = {text[at:at + size] for size in sizes for at in np.flatnonzero(bits[_slots(text, size)]).tolist()}
                places += [i] * len(own)
                grams += own
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(places, pa.int64())), pa.array(grams, pa.string())], ["id", "gram"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text").mapInArrow(emit, f"id {kind}, gram string")


def rule_hits(rows: DataFrame, rules: DataFrame, id: str, text: Column) -> DataFrame:
    """``rows`` with ``hits``: the keywords of ``rules`` (cat_ord, category, kw_ord, keyword) that occur in ``text``, in rule order.

    A keyword listed more than once counts at its first place. ``id`` names a row; a null text has no hits.
    """
    texts = rows.select(F.col(id).alias("id"), text.alias("text"))
    words = rules.groupBy("keyword").agg(F.min(F.struct("kw_ord", "cat_ord", "category")).alias("first"))
    filed = words.select("keyword", "first", F.explode(_grams(F.col("keyword"))).alias("gram"))
    sizes = sorted(r[0] for r in words.select(F.least(F.length("keyword"), F.lit(GRAM)).alias("n")).distinct().collect())  # at most GRAM + 1
    # How many texts hold each gram of a rule, and so which of a keyword's grams is the rarest.
    held = _text_grams(texts, sizes, _bit_map(filed.select("gram").distinct())).groupBy("gram").agg(F.count("*").alias("n"))
    rated = filed.join(held, "gram", "left").select("keyword", "first", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram").alias("key"))
    rarest = rated.groupBy("keyword").agg(F.first("first").alias("first"), F.min("key").alias("key")).filter("key.n > 0")
    keyed = rarest.select(F.col("key.gram").alias("gram"), "keyword", "first")
    met = _text_grams(texts, sizes, _bit_map(keyed.select("gram"))).join(keyed, "gram")
    entry = F.struct("first.kw_ord", "first.cat_ord", "first.category", "keyword")
    candidates = met.groupBy(F.col("id").alias(id)).agg(F.sort_array(F.collect_set(entry)).alias("_met"))
    joined = rows.join(candidates, id, "left")
    return joined.withColumn("hits", F.filter(F.coalesce("_met", F.array().cast(candidates.schema["_met"].dataType)),
                                              lambda c: F.contains(text, c["keyword"]))).drop("_met")


def first_category(default: str = DEFAULT_CATEGORY) -> Column:
    return F.coalesce(F.get("hits", 0)["category"], F.lit(default))
