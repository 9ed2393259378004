"""Placement by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own: from an
offset in equal skips, both hashed from its name. Shards take turns, each claiming its
first free slot, until the table is full. Shards so own almost equally many slots,
and when one leaves, few slots of the others move. The table has a fixed number of
slots, so it can be sent to every task; a row's slot is a hash modulo that number.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537  # a prime
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(name: str, use: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{use}:{name}".encode()).digest()[:8], "big")


def table(shards: tuple[str, ...], slots: int = SLOTS) -> list[int]:
    """Index of the shard that owns each slot.

    ``slots`` is a prime above the number of shards; the names differ. Turns follow the sorted
    names, so the order of the list does not matter.
    """
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    if len(set(shards)) != len(shards) or not shards or len(shards) > slots:
        raise ValueError("shards must have different names and be at least one, at most as many as slots")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    place = {i: _number(shards[i], "offset") % slots for i in turns}
    skip = {i: _number(shards[i], "skip") % (slots - 1) + 1 for i in turns}
    owner, free = [-1] * slots, slots
    while free:
        for i in turns[:free] if free < len(turns) else turns:
            while owner[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % slots
            owner[place[i]] = i
            free -= 1
    return owner


def slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of the MD5 of its text, modulo the table's size. A null key is an empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots))


def placed(rows: DataFrame, key: Column, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, prefix: str = "") -> DataFrame:
    """Add ``slot`` and ``shard`` (with ``prefix``) to each row; columns of these names are replaced, the others stay.

    Equal keys go to the same shard; where one key may hold a large share of the rows, the key must
    name rows (an id, or key and id). An empty table gives an empty result.
    """
    spark = rows.sparkSession
    owner = table(shards, slots)
    lookup = spark.createDataFrame(list(enumerate(owner)), f"{prefix}slot long, _owner int")
    names = spark.createDataFrame(list(enumerate(shards)), f"_owner int, {prefix}shard string")
    side = lookup.join(F.broadcast(names), "_owner").select(f"{prefix}slot", f"{prefix}shard")
    kept = rows.drop(f"{prefix}slot", f"{prefix}shard") if {f"{prefix}slot", f"{prefix}shard"} & set(rows.columns) else rows
    # At most ``slots`` rows of a long and a short name: a few MB.
    return kept.withColumn(f"{prefix}slot", slot(key, slots)).join(F.broadcast(side), f"{prefix}slot")


def write_shards(rows: DataFrame, key: Column, folder: str, shards: tuple[str, ...] = SHARDS) -> None:
    """Write the rows to one subfolder a shard (column ``shard``), gathered by slot, so that a shard has several files on a large table."""
    dealt = placed(rows, key, shards)
    dealt.repartition("shard", F.col("slot") % 16).drop("slot").write.partitionBy("shard").parquet(folder)
