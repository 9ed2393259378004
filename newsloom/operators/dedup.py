"""Duplicate removal over a whole table.

Rows carry ``pos``, a number that gives their arrival order. One key may
own a large share of all rows, so no operator here brings all rows of a key
into one task: keys are reduced in the map tasks first, and what is found out
about a row is joined back by ``pos``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed value: seconds a url stays blocked in the alternative job.
TTL_SECONDS = 600
# A key's time line is walked in blocks of so many seconds at once.
BLOCK_SECONDS = 1 << 17

POSITION = "decimal(38,0)"
OFFSETS = 10 ** 19  # more than the largest long


def position(partition: Column, offset: Column) -> Column:
    """(partition, offset) as one number that sorts the same way, for all ints and longs from 0 on.

    A decimal's minimum is kept in the hash aggregate's fixed-width buffer, a struct's
    is not. A message without a partition or an offset raises an error that says so.
    """
    number = partition.cast("decimal(10,0)") * F.lit(str(OFFSETS)).cast("decimal(20,0)") + offset.cast("decimal(20,0)")
    missing = F.raise_error(F.lit("a message has no partition or no offset")).cast(POSITION)
    return F.when(partition.isNull() | offset.isNull(), missing).otherwise(number.cast(POSITION))


def place_of(pos: Column) -> tuple[Column, Column]:
    """Partition (int) and offset (long) of a :func:`position`."""
    digits = F.lpad(pos.cast("string"), 38, "0")
    return F.substring(digits, 1, 19).cast("int"), F.substring(digits, 20, 19).cast("long")


def first_of_each(rows: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """The first row of every key.

    Spark plans ``row_number() = 1`` with a group limit before the shuffle, so
    a map task sends at most one row per key, however hot the key is.
    """
    order = Window.partitionBy(key).orderBy(pos)
    return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def first_positions(rows: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """``pos`` of the first row of every key; partial minima are taken in the map tasks."""
    return rows.groupBy(key).agg(F.min(pos).alias(pos))


def flag_repeats(rows: DataFrame, key: str, pos: str = "pos", seen: DataFrame | None = None,
                 flag: str = "is_duplicate") -> DataFrame:
    """Mark every row whose key came before, in ``rows`` or in the ``seen`` keys."""
    firsts = first_positions(rows, key, pos)
    if seen is not None:
        firsts = unseen(firsts, seen, key)
    return _flagged(rows, firsts, pos, flag)


def _flagged(rows: DataFrame, firsts: DataFrame, pos: str, flag: str) -> DataFrame:
    """Mark the rows whose ``pos`` is not among ``firsts``.

    A row stays a row, whatever the positions: of rows that share one, which only copies of a
    whole message or document do, the first counts. The rows lie by ``pos`` after the join, so
    counting them needs no shuffle of its own.
    """
    marks = firsts.select(pos, F.lit(False).alias(flag)).distinct()
    same = F.row_number().over(Window.partitionBy(pos).orderBy(pos)) > 1
    return rows.join(marks, pos, "left").withColumn(flag, F.coalesce(flag, F.lit(True)) | same)


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the ``seen`` keys. Reduce ``rows`` to one row a key
    before, so that neither side has a hot key."""
    return rows.join(seen.select(key), key, "left_anti")


def _groups(batch: pd.DataFrame, names: list[str]) -> np.ndarray:
    """True where a row's group differs from that of the row before; the first one is always True."""
    begins = np.zeros(len(batch), dtype=bool)
    begins[:1] = True
    for name in names:
        column = batch[name]
        now, before = column.iloc[1:].reset_index(drop=True), column.iloc[:-1].reset_index(drop=True)
        begins[1:] |= ~((now == before) | (now.isna() & before.isna())).fillna(False).to_numpy(dtype=bool)
    return begins


def _same(a: tuple | None, b: tuple) -> bool:
    return a is not None and all(x == y or (pd.isna(x) and pd.isna(y)) for x, y in zip(a, b))


def _line(begins: np.ndarray, seconds: np.ndarray, high: int, ttl: int) -> tuple[np.ndarray, int, int]:
    """Groups laid out one behind the other on one line, too far apart to reach the next by a jump: line, least second, stride."""
    low = int(seconds.min())
    stride = max(int(seconds.max()), high) - low + ttl + 2
    return (np.cumsum(begins) - 1) * stride + seconds - low, low, stride


def _block_steps(ttl: int, span: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each (key, block) of rows sorted by key, block, second: how a walk that enters it leaves it.

    A walk enters with the first second it may accept, at most ``ttl`` behind the block's begin. From there on it is
    fixed, and walks that meet stay together, so the last accepted second is a step function of few steps:
    up to ``upto`` the walk leaves with ``leave``. Behind the last step it accepts nothing. A block is held
    until it is whole: at most ``span`` rows.
    """
    def steps(table: pa.Table, begins: np.ndarray) -> pa.RecordBatch:
        seconds, blocks = table.column("second").to_numpy(), table.column("block").to_numpy()
        starts = np.flatnonzero(begins)
        group = np.cumsum(begins) - 1
        ends = np.r_[starts[1:], len(seconds)][group]
        line, _, _ = _line(begins, seconds, 0, ttl)
        last = np.searchsorted(line, line + ttl, side="right")
        last = np.where(last < ends, last, np.arange(len(seconds)))
        while (last != last[last]).any():
            last = last[last]
        leave = seconds[last]
        first = blocks[starts] * span
        entered = np.r_[True, seconds[:-1] < (first[group] + ttl)[1:]] | begins  # also the first one behind the last possible entry
        at = np.flatnonzero(entered)
        at = at[np.r_[(group[at][1:] != group[at][:-1]) | (leave[at][1:] != leave[at][:-1]), True]]
        offsets = pa.array(np.r_[0, np.cumsum(np.bincount(group[at], minlength=len(starts)))].astype("int32"))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(values[at])) for values in (seconds, leave)]
        rows = pa.array(starts)
        return pa.RecordBatch.from_arrays([table.column("key").combine_chunks().take(rows), pa.array(blocks[starts]), *lists], ["key", "block", "upto", "leave"])

    held = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not held.num_rows:
            continue
        begins = _groups(held.select(["key", "block"]).to_pandas(), ["key", "block"])
        tail = int(np.flatnonzero(begins)[-1])
        if tail:
            yield steps(held.slice(0, tail), begins[:tail])
            held = held.slice(tail)
    if held is not None and held.num_rows:
        yield steps(held, _groups(held.select(["key", "block"]).to_pandas(), ["key", "block"]))


def _entries(ttl: int, span: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compose the steps of a key's blocks in order: the first second that may be accepted in each block."""
    key, release, walking = None, 0, False
    for batch in batches:
        out = []
        lists = [batch.column(c) for c in ("upto", "leave")]
        upto, leave = (values.flatten().to_pylist() for values in lists)
        ends = np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False)).tolist()
        low = 0
        for name, block, high in zip(batch.column("key").to_pylist(), batch.column("block").to_pylist(), ends):
            begin = block * span
            same = walking and (name == key or (name != name and key != key))
            release = max(begin, release) if same else begin
            key, walking = name, True
            out.append(release)
            step = bisect_left(upto, release, low, high)
            if step < high:
                release = leave[step] + ttl + 1
            low = high
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("block"), pa.array(out, pa.int64())], ["key", "block", "release"])


def _accept(ttl: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walk (key, block, second) rows sorted by all three and keep the accepted ones.

    The first accepted second of a block is the first one from its ``release`` on; the next is the first more than
    ``ttl`` behind it, and so on. All blocks of a batch jump at once. Only the last block
    and what it may accept next are carried over to the next batch.
    """
    group, carried = None, 0
    for batch in batches:
        if batch.empty:
            continue
        seconds = batch["second"].to_numpy()
        begins = _groups(batch, ["key", "block"])
        starts = np.flatnonzero(begins)
        ends = np.r_[starts[1:], len(seconds)]
        release = batch["release"].to_numpy()[starts].copy()
        names = list(zip(batch["key"].iloc[[0, -1]], batch["block"].iloc[[0, -1]]))
        if _same(group, names[0]):
            release[0] = carried
        line, low, stride = _line(begins, seconds, int(release.max()), ttl)
        keep = np.zeros(len(seconds), dtype=bool)
        walking = np.arange(len(starts))
        at = np.searchsorted(line, walking * stride + np.maximum(release - low, 0), side="left")
        while walking.size:
            inside = at < ends[walking]
            walking, at = walking[inside], at[inside]
            keep[at] = True
            release[walking] = seconds[at] + ttl + 1
            at = np.searchsorted(line, line[at] + ttl, side="right")
        group, carried = names[1], int(release[-1])
        yield batch.loc[keep, ["pos"]]


def ttl_positions(rows: DataFrame, key: str, seconds: str, pos: str = "pos", ttl: int = TTL_SECONDS, span: int = BLOCK_SECONDS) -> DataFrame:
    """``pos`` of the rows accepted by a time-to-live window with a fixed anchor.

    The first row of a key is accepted; then the next one more than ``ttl``
    seconds after the last *accepted* row, and so on. Duplicates do not move
    the anchor. Arrival order is (second, pos).

    Rows of one second collapse into one in the map tasks. The time line of a key is cut into blocks of ``span`` seconds, which run in
    parallel, so a key that holds all rows still uses the cluster: each block finds how any walk that
    enters it leaves it, the few steps of that are composed in order of the blocks (one narrow row a block), and then all
    blocks accept at once. A row without a time is in no window: it is accepted and touches no other row.
    """
    span = max(span, ttl + 1)
    timed = rows.filter(F.col(seconds).isNotNull())
    cells = timed.groupBy(F.col(key).alias("key"), F.col(seconds).cast("long").alias("second")).agg(F.min(pos).alias("pos"))
    placed = cells.withColumn("block", F.floor(F.col("second") / F.lit(span)).cast("long")).repartition("key", "block")
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema}
    ordered = placed.sortWithinPartitions("key", "block", "second").select("key", "block", "second")
    steps = ordered.mapInArrow(lambda batches: _block_steps(ttl, span, batches), f"key {kinds['key']}, block long, upto array<long>, leave array<long>")
    entries = steps.repartition("key").sortWithinPartitions("key", "block").mapInArrow(
        lambda batches: _entries(ttl, span, batches), f"key {kinds['key']}, block long, release long")
    entries = entries.select(F.col("key").alias("_key"), F.col("block").alias("_block"), "release")
    entered = placed.join(entries, F.col("key").eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_block")))
    walks = entered.select("key", "block", "second", "pos", "release").sortWithinPartitions("key", "block", "second")
    accepted = walks.mapInPandas(lambda batches: _accept(ttl, batches), f"pos {kinds['pos']}")
    untimed = rows.filter(F.col(seconds).isNull()).select(pos)
    return accepted.withColumnRenamed("pos", pos).unionByName(untimed)


def ttl_first(rows: DataFrame, key: str, seconds: str, pos: str = "pos", ttl: int = TTL_SECONDS) -> DataFrame:
    """The rows accepted by :func:`ttl_positions`."""
    return ttl_flags(rows, key, seconds, pos, ttl, "_late").filter("not _late").drop("_late")


def ttl_flags(rows: DataFrame, key: str, seconds: str, pos: str = "pos", ttl: int = TTL_SECONDS,
              flag: str = "is_duplicate") -> DataFrame:
    return _flagged(rows, ttl_positions(rows, key, seconds, pos, ttl), pos, flag)
