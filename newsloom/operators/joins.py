"""Joins of a large table with a registry-sized one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes a side may have, as JSON, to be sent to every executor, and the number of parts a
# hot key is spread over when it may not.
BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32


def join_small(rows: DataFrame, small: DataFrame, on: str, how: str = "inner", spread: str = "pos",
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``rows`` with ``small``, which has one row per ``on`` value.

    ``small`` is broadcast when its rows, measured first, have at most ``max_bytes``. A
    larger one is joined by shuffle: ``rows`` are spread over ``SALTS`` parts of
    every key by the hash of their ``spread`` column and ``small`` is repeated
    for each part, so a hot key does not end in one task.
    """
    size = small.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return join_sized(rows, small, on, size or 0, how, spread, max_bytes)


def join_sized(rows: DataFrame, small: DataFrame, on: str, size: int, how: str = "inner", spread: str = "pos",
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """:func:`join_small` where a bound of the small side's bytes is known already."""
    if size <= max_bytes:
        return rows.join(F.broadcast(small), on, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    parts = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(parts, [on, "_salt"], how).drop("_salt")
