"""Document fingerprints from content-defined chunks.

A gear hash runs over the UTF-8 bytes of a text: each byte shifts it by one and adds
the byte's random number, so it depends on the last 32 bytes only. A chunk ends where
certain bits of the hash are zero: many bits before the normal size, few after it
(normalised chunking), so sizes gather round the normal one. As
boundaries depend on nearby content, an edit changes only the chunks it touches.

A fingerprint is the set of chunk digests with their lengths. Containment of one text in
another is the share of its length whose chunks the other has too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, NORMAL, MOST = 12, 32, 512
HARD, EASY = 6, 4        # bits that are zero at an end, before and after the normal size
DIGEST = 32              # bits of a digest in a fingerprint
PART = 1 << 20           # bytes hashed at a time


def _gear() -> np.ndarray:
    digests = b"".join(hashlib.sha256(b"gear %d" % i).digest()[:4] for i in range(256))
    return np.frombuffer(digests, dtype="<u4").astype(np.uint32)


GEAR = _gear()


def gear_hashes(data: bytes) -> np.ndarray:
    """Hash after each byte: the sum of the last 32 bytes' numbers, each shifted by its distance.

    Sums over 1, 2, 4, 8 and 16 bytes are doubled in length, so the work is five
    passes over the array.
    """
    out = GEAR[np.frombuffer(data, dtype=np.uint8)]
    for width in (1, 2, 4, 8, 16):
        longer = out.copy()
        longer[width:] += out[:-width] << np.uint32(width)
        out = longer
    return out


def _ends(data: bytes) -> tuple[list[int], list[int]]:
    """Places after bytes where a chunk may end: by the hard rule, by the easy one."""
    hard, easy = [], []
    for at in range(0, len(data), PART):
        before = max(0, at - 31)
        hashes = gear_hashes(data[before:at + PART])[at - before:]
        mild = np.flatnonzero(hashes >> np.uint32(32 - EASY) == 0)
        easy.append(mild + at + 1)
        hard.append(mild[hashes[mild] >> np.uint32(32 - HARD) == 0] + at + 1)
    return np.concatenate(hard).tolist(), np.concatenate(easy).tolist()


def chunks(data: bytes) -> list[bytes]:
    """The chunks of a text, in order; none of an empty one."""
    if not data:
        return []
    hard, easy = _ends(data)
    out, start, h, e, size = [], 0, 0, 0, len(data)
    while start < size:
        low, middle, high = start + LEAST, start + NORMAL, min(start + MOST, size)
        while h < len(hard) and hard[h] < low:
            h += 1
        if h < len(hard) and hard[h] <= min(middle, high):
            end = hard[h]
        else:
            while e < len(easy) and easy[e] <= middle:
                e += 1
            end = easy[e] if e < len(easy) and easy[e] < high else high
        out.append(data[start:end])
        start = end
    return out


def fingerprint(text: str) -> dict[str, int]:
    """Digest of each different chunk, with its length in bytes."""
    digest = xxhash.xxh3_64_intdigest
    return {f"{digest(c) >> 64 - DIGEST:08x}": len(c) for c in chunks(text.encode("utf-8", "surrogatepass"))}


def written(found: dict[str, int]) -> str:
    """A fingerprint as text: digest and length, in order of the digests; empty for an empty text."""
    return ",".join(f"{d}:{n:x}" for d, n in sorted(found.items()))


def containment(own: dict[str, int], other: dict[str, int]) -> float:
    """Share of ``own`` that ``other`` has, by length, 0 to 1. An empty text is contained in an empty one only."""
    if not own:
        return 0.0 if other else 1.0
    return sum(n for d, n in own.items() if d in other) / sum(own.values())


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by the start of another: as many code points, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _fingerprinted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come in order within their part, and the row that follows a part's last comes once more, marked ``extra``."""
    waiting, out = None, []

    def finish(now, following):
        part, name, text, own = now
        # A single document is its own successor.
        after_text, after = following if following else (text, own)
        changed = edited(text, after_text)
        prints = fingerprint(changed)
        return (name, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), written(own), written(prints),
                containment(own, prints), containment(own, after))

    for batch in batches:
        for part, extra, name, text in zip(batch["part"], batch["extra"], batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None), batch["text"]):
            text = text or ""
            own = fingerprint(text)
            if waiting and waiting[0] == part:
                out.append(finish(waiting, (text, own)))
                waiting = None
            elif waiting:  # cannot happen while every part has its extra row
                raise ValueError("a part lacks the row that follows it")
            if not extra:
                waiting = (part, name, text, own)
            if len(out) >= 256:
                yield _frame(out)
                out = []
    if waiting:
        raise ValueError("a part lacks the row that follows it")
    if out:
        yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    return frame.astype({"doc_id": "Int64"})


def with_next(docs: DataFrame, rows_a_part: int = 2_000) -> DataFrame:
    """Rows (part, extra, doc_id, text) in which each part's documents are followed by the one after it.

    Parts are ranges of ids in descending order, nulls last, ties by text (null as empty); the
    first document follows the last. Ranges come from approximate quantiles of the ids;
    what the driver holds is a bound and a first id for each part. One shuffle moves the texts.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = docs.count()
    wanted = max(1, -(-size // rows_a_part))
    steps = [i / wanted for i in range(1, wanted)]
    bounds = rows.select("doc_id").approxQuantile("doc_id", steps, 0.1 / wanted) if steps else []
    bounds = sorted({int(b) for b in bounds}, reverse=True)
    array = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    # Ids at or above a bound belong to the parts before it; null ids are a last part of their own.
    placed = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(_below(array, len(bounds)))
    parts = rows.withColumn("part", placed.cast("int"))
    firsts = {r.part: r.first for r in parts.groupBy("part").agg(F.max("doc_id").alias("first")).collect()}
    order = sorted(firsts)
    heads = [(firsts[b], a, b) for a, b in zip(order, order[1:] + order[:1])]
    if not heads:
        return parts.withColumn("extra", F.lit(False)).select("part", "extra", "doc_id", "text")
    # One narrow row for each part.
    side = docs.sparkSession.createDataFrame(heads, "head long, before int, own int")
    extra = parts.join(F.broadcast(side), (F.col("part") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head")))
    # Of several documents with the first id, only the first text is wanted.
    extra = extra.groupBy("before").agg(F.min("text").alias("text"), F.first("head").alias("doc_id")).select(
        F.col("before").alias("part"), F.lit(True).alias("extra"), "doc_id", "text")
    both = parts.select("part", F.lit(False).alias("extra"), "doc_id", "text").unionByName(extra)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(order) // 8)
    return both.repartition(tasks, "part").sortWithinPartitions("part", "extra", F.col("doc_id").desc_nulls_last(), "text")


def _below(bounds, n: int):
    """Number of ``bounds`` (descending) above the id: a binary search in log2(n) steps of array reads."""
    steps = [1 << i for i in reversed(range(max(1, n).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
        F.coalesce(F.get(bounds, at + s - 1) > F.col("doc_id"), F.lit(False)), at + s).otherwise(at))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprint of each document and of its edited text, with their containments.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next). Null texts count as empty; repeated rows follow each other; a single
    document follows itself. Other columns are not read. An empty table gives an empty result.
    """
    ordered = with_next(docs)
    return ordered.mapInPandas(_fingerprinted, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                               "edited_fingerprint string, near_edited double, near_next double")
