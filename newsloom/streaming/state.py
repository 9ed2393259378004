"""Keyed state for duplicate removal in streams.

The processors see the rows of one key and one micro-batch in frames; they
sort keys and positions by arrival before they touch the state, and leave whole rows in their frames. The number of rows a
micro-batch holds is set by the source (``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from newsloom.operators.dedup import TTL_SECONDS

# How far a message of a query that runs on may lie behind the latest one. It exceeds the time a
# message can stay in its topic before it is read.
LATENESS_SECONDS = 48 * 3600

# Hashes remembered by the processor and by the crawler.
PROCESSOR_WINDOW = 10_000
CRAWLER_WINDOW = 50_000

# Groups the keys of a stream are dealt to by hash. A group's rows come in frames of their own, so the cost of a frame is
# shared by its keys; a group's share of a micro-batch is held by one Python worker.
GROUPS = 1024

# Most keys of a page of expiring state: what a batch reads and writes for a key it meets.
PAGE_KEYS = 512


def _arranged(frames: list[pd.DataFrame], by: list[str]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """The rows of several frames in order of ``by``: these columns alone, and each row's frame and place in it."""
    narrow = pd.concat([f[by] for f in frames], ignore_index=True)
    frame = np.repeat(np.arange(len(frames)), [len(f) for f in frames])
    place = np.concatenate([np.arange(len(f)) for f in frames])
    order = narrow.sort_values(by, kind="stable").index.to_numpy()
    return narrow.iloc[order], frame[order], place[order]


def _parted(frame: pd.DataFrame, passes: str | None) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Rows whose ``passes`` column is set, which go through untouched, and the others."""
    if passes is None:
        return frame.iloc[:0], frame
    passing = frame[passes].notna().to_numpy()
    return frame[passing], frame[~passing]


def _picked(frames: list[pd.DataFrame], frame: np.ndarray, place: np.ndarray) -> Iterator[pd.DataFrame]:
    """The chosen rows, frame by frame; whole rows are never brought together."""
    for i in np.unique(frame):
        yield frames[i].iloc[np.sort(place[frame == i])]


def _page_of(key: str, pages: int) -> int:
    return crc32(key.encode("utf-8", "surrogatepass")) % pages


class TtlProcessor(StatefulProcessor):
    """Of each key of a group, keep a row when it lies more than ``ttl`` seconds behind the last kept row of the key.

    The state of a key goes once the watermark has passed its end: a later row is accepted with
    or without it, and an earlier one is late, so the rows that come out do not depend on when it goes.

    The last kept second of each key lies in pages, to which the keys are dealt by hash. A batch reads and writes the pages of the keys it meets, and
    pages are split and joined as keys come and go. ``anchor`` holds what the group needs besides: the least second kept when
    the timer was set, and the numbers of keys and pages. The group's one timer is due ``slack`` seconds behind the end of that least second;
    then all keys go that have ended, so each is looked at a few times in its life and not by every timer.
    """

    def __init__(self, seconds: str, pos: str, ttl: int, slack: int, passes: str | None = None):
        self.seconds, self.pos, self.ttl, self.slack, self.passes, self.room = seconds, pos, ttl, slack, passes, PAGE_KEYS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.anchor = handle.getValueState("anchor", "anchor long, keys long, pages int")
        self.pages = handle.getMapState("pages", "page int", "keys array<string>, anchors array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = []
        for rows_of in rows:
            passing, rows_of = _parted(rows_of, self.passes)
            if len(passing):
                yield passing
            if len(rows_of):
                frames.append(rows_of)
        if not frames:
            return
        ordered, frame, place = _arranged(frames, ["state_key", self.seconds, self.pos])
        if ordered[self.seconds].hasnans:
            raise ValueError("a row without a time")
        keys, seconds = ordered["state_key"].to_numpy(), ordered[self.seconds].tolist()
        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]).tolist()
        due, held, pages = self.anchor.get() if self.anchor.exists() else (None, 0, 1)
        pages = self._dealt(pages, held + len(edges) - 1)
        met: dict[int, list[tuple[str, int, int]]] = {}
        for start, end in zip(edges[:-1], edges[1:]):
            met.setdefault(_page_of(keys[start], pages), []).append((keys[start], start, end))
        least, keep = due, []
        for page, own in met.items():
            anchors = self._read(page)
            known, kept = len(anchors), len(keep)
            for name, start, end in own:
                last = anchors.get(name)
                at = start if last is None else bisect_right(seconds, last + self.ttl, start, end)
                if at == end:
                    continue
                while at < end:
                    last = seconds[at]
                    keep.append(at)
                    at = bisect_right(seconds, last + self.ttl, at, end)
                anchors[name] = int(last)
                least = int(last) if least is None else min(least, int(last))
            if len(keep) > kept:
                self._write(page, anchors)
            held += len(anchors) - known
        if keep:
            if least != due:
                if due is not None:
                    self.handle.deleteTimer(self._due(due))
                self.handle.registerTimer(self._due(least))
            self.anchor.update((least, held, pages))
            yield from _picked(frames, frame[keep], place[keep])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, held, pages = self.anchor.get()
        first = timerValues.getCurrentWatermarkInMs() // 1000 - self.ttl  # the least second whose window is still open
        least, held = None, 0
        for page in range(pages):
            anchors = self._read(page)
            left = {name: last for name, last in anchors.items() if last >= first}
            if len(left) < len(anchors):
                self._write(page, left)
            if left:
                least = min(left.values()) if least is None else min(least, *left.values())
                held += len(left)
        if held:
            self.handle.registerTimer(self._due(least))
            self.anchor.update((least, held, self._dealt(pages, held)))
        else:
            self.anchor.clear()
        return iter(())

    def _due(self, anchor: int) -> int:
        return (anchor + self.ttl + 1 + self.slack) * 1000

    def _read(self, page: int) -> dict[str, int]:
        stored = self.pages.getValue((page,))
        return {} if stored is None else dict(zip(*stored))

    def _write(self, page: int, anchors: dict[str, int]) -> None:
        if anchors:
            self.pages.updateValue((page,), (list(anchors), list(anchors.values())))
        else:
            self.pages.removeKey((page,))

    def _dealt(self, pages: int, keys: int) -> int:
        """Deal the state to as many pages as ``keys`` keys need, unless they fit the present number: the new number.

        Numbers of pages are powers of two, so a page's keys come from, or go to, pages that are equal modulo the smaller number.
        """
        if keys <= pages * self.room and (pages == 1 or keys > pages * self.room // 8):
            return pages
        after = 1 << (-(-keys // self.room) - 1).bit_length()
        step = min(pages, after)
        for low in range(step):
            dealt: dict[int, dict[str, int]] = {page: {} for page in range(low, max(pages, after), step)}
            for page in range(low, pages, step):
                for name, last in self._read(page).items():
                    dealt[_page_of(name, after)][name] = last
            for page, anchors in dealt.items():
                self._write(page, anchors)
        return after

    def close(self) -> None:
        pass


class TtlGroupProcessor(StatefulProcessor):
    """:class:`TtlProcessor` for keys whose state never goes: the last kept second of each key in one map."""

    def __init__(self, seconds: str, pos: str, ttl: int, passes: str | None = None):
        self.seconds, self.pos, self.ttl, self.passes = seconds, pos, ttl, passes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.anchors = handle.getMapState("anchors", "key string", "anchor long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = []
        for rows_of in rows:
            passing, rows_of = _parted(rows_of, self.passes)
            if len(passing):
                yield passing
            if len(rows_of):
                frames.append(rows_of)
        if not frames:
            return
        ordered, frame, place = _arranged(frames, ["state_key", self.seconds, self.pos])
        keys, seconds = ordered["state_key"].to_numpy(), ordered[self.seconds].to_numpy()
        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        empty, keep = not self.anchors.exists(), []
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            stored = None if empty else self.anchors.getValue((keys[start],))
            own, at = seconds[start:end], 0 if stored is None else int(np.searchsorted(seconds[start:end], stored[0] + self.ttl, side="right"))
            last = None
            while at < len(own):
                last = at
                keep.append(start + at)
                at = int(np.searchsorted(own, own[at] + self.ttl, side="right"))
            if last is not None:
                self.anchors.updateValue((keys[start],), (int(own[last]),))
        if keep:
            yield from _picked(frames, frame[keep], place[keep])

    def close(self) -> None:
        pass


class FirstProcessor(StatefulProcessor):
    """Of each key of a group, keep the row of the smallest position unless the key has come before; holds one row a key besides the frame."""

    def __init__(self, pos: str, passes: str | None = None):
        self.pos, self.passes = pos, passes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "key string", "seen boolean")

    def _first(self, frames: list[pd.DataFrame]) -> pd.DataFrame:
        ordered, frame, place = _arranged(frames, ["state_key", self.pos])
        keys = ordered["state_key"].to_numpy()
        begins = np.r_[True, keys[1:] != keys[:-1]]
        return pd.concat(list(_picked(frames, frame[begins], place[begins])), ignore_index=True)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in rows:
            passing, frame = _parted(frame, self.passes)
            if len(passing):
                yield passing
            if len(frame):
                held.append(frame)
                if len(held) > 1 and sum(map(len, held[1:])) >= len(held[0]):
                    held = [self._first(held)]
        if not held:
            return
        first = self._first(held)
        if self.seen.exists():
            first = first[[not self.seen.containsKey((k,)) for k in first["state_key"]]]
        for k in first["state_key"]:
            self.seen.updateValue((k,), (True,))
        if len(first):
            yield first

    def close(self) -> None:
        pass


class WindowProcessor(StatefulProcessor):
    """Keep or mark rows by a window of the last ``size`` accepted hashes of a bucket.

    A hash outside the window is new: it is accepted, and the oldest accepted
    hash leaves a full window. Repeats do not move a hash.

    The window is a ring: accepted hashes are numbered, one map leads from a hash to its number, one from the number
    to the hash, and two counters are its ends. A batch reads and writes the hashes it meets, not the window.
    """

    def __init__(self, key: str, pos: str, size: int, flag: str | None = None, passes: str | None = None):
        self.key, self.pos, self.size, self.flag, self.passes = key, pos, size, flag, passes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.number = handle.getMapState("number", "hash string", "number long")
        self.hash = handle.getMapState("hash", "number long", "hash string")
        self.ends = handle.getValueState("ends", "oldest long, next long")

    def _walk(self, keys: Iterable[str]) -> list[bool]:
        oldest, after = self.ends.get() if self.ends.exists() else (0, 0)
        before = after
        known: dict[str, bool] = {}   # of the hashes met: whether the window holds them now
        added: dict[int, str] = {}    # accepted in this batch and still held
        gone: dict[int, str] = {}     # held before this batch and gone now
        fresh = []
        for key in keys:
            if key not in known:
                known[key] = self.number.containsKey((key,))
            fresh.append(not known[key])
            if known[key]:
                continue
            if after - oldest >= self.size:
                last = added.pop(oldest, None)
                if last is None:
                    last = gone[oldest] = self.hash.getValue((oldest,))[0]
                known[last] = False
                oldest += 1
            added[after], known[key] = key, True
            after += 1
        for number, key in gone.items():
            self.hash.removeKey((number,))
            self.number.removeKey((key,))
        for number, key in added.items():
            self.hash.updateValue((number,), (key,))
            self.number.updateValue((key,), (number,))
        if after != before:
            self.ends.update((oldest, after))
        return fresh

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = []
        for rows_of in rows:
            passing, rows_of = _parted(rows_of, self.passes)
            if len(passing):
                yield passing
            if len(rows_of):
                frames.append(rows_of)
        if not frames:
            return
        ordered, frame, place = _arranged(frames, [self.pos, self.key])
        fresh = np.array(self._walk(ordered[self.key]), dtype=bool)
        if self.flag is None:
            yield from _picked(frames, frame[fresh], place[fresh])
            return
        for i, rows_of in enumerate(frames):
            mine = frame == i
            marks = np.empty(len(rows_of), dtype=bool)
            marks[place[mine]] = ~fresh[mine]
            yield rows_of.assign(**{self.flag: marks})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._walk(initialState.sort_values("seq", kind="stable")["url_hash"].tail(self.size))

    def close(self) -> None:
        pass


def ttl_stream(rows: DataFrame, key: str, seconds: str, pos: str = "pos", ttl: int = TTL_SECONDS,
               lateness: int | None = None, passes: str | None = None) -> DataFrame:
    """Rows of a stream accepted by a time-to-live window with a fixed anchor, by event time.

    With ``lateness`` the state of a key is dropped by a timer once the watermark, so many seconds behind the
    latest row, has passed its window: the state holds the keys of about ``ttl + lateness`` seconds, and a
    replay gives the same rows. Rows that come later than that are dropped. Without it nothing is late and every key keeps its state.
    Rows in which the column ``passes`` is set go through untouched.
    """
    if lateness is None:
        return _by_group(rows, key, TtlGroupProcessor(seconds, pos, ttl, passes))
    processor = TtlProcessor(seconds, pos, ttl, (ttl + lateness) // 8, passes)
    timed = rows.withColumn("_at", F.timestamp_seconds(seconds)).withWatermark("_at", f"{lateness} seconds")
    return _by_group(timed, key, processor, rows.schema, "EventTime")


def ttl_stream_built_in(rows: DataFrame, key: str, event_time: str, ttl: int = TTL_SECONDS) -> DataFrame:
    """The built-in relative of :func:`ttl_stream`: state expires with the watermark, so a
    url comes back at a moment that depends on the other rows, and late rows are dropped."""
    return rows.withWatermark(event_time, f"{ttl} seconds").dropDuplicatesWithinWatermark([key])


def first_stream(rows: DataFrame, key: str) -> DataFrame:
    """A row of every key since the query began, any one of a micro-batch; the state grows with the keys."""
    return rows.dropDuplicates([key])


def first_position_stream(rows: DataFrame, key: str, pos: str = "pos", passes: str | None = None) -> DataFrame:
    """The first row of every key since the query began, of a micro-batch the one with the smallest ``pos``.

    The keys are dealt to groups that run in parallel, each with a state of its own, and no number of them makes one forgotten.
    """
    return _by_group(rows, key, FirstProcessor(pos, passes))


def _by_group(rows: DataFrame, key: str, processor: StatefulProcessor, schema: StructType | None = None, time_mode: str = "None") -> DataFrame:
    """Run a processor over groups of keys. It knows a key by the text ``state_key``, in which a null differs from an empty text."""
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    grouped = rows.withColumns({"state_key": text, "state_group": F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int")})
    kept = grouped.groupBy("state_group").transformWithStateInPandas(processor, outputStructType=schema or grouped.schema, outputMode="Append", timeMode=time_mode)
    return kept.drop("state_key", "state_group")


def _buckets(rows: DataFrame, key: str, buckets: int | str) -> DataFrame:
    if isinstance(buckets, str):
        return rows.withColumn("bucket", F.col(buckets))
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))


def window_stream(rows: DataFrame, key: str, pos: str = "pos", size: int = PROCESSOR_WINDOW, buckets: int | str = 1,
                  flag: str | None = None, seen: DataFrame | None = None, passes: str | None = None) -> DataFrame:
    """Rows of a stream that are new to a window of the last ``size`` accepted keys.

    With one bucket the window is global and exact, and one task does the work.
    With more buckets each holds ``size / buckets`` keys and they run in
    parallel; the result differs only after a bucket has overflowed. The name of a column makes a window of ``size`` keys for each of
    its values, such as a source; these are exact and parallel. ``flag``
    keeps all rows and names the column that marks repeats. ``seen``
    (``url_hash, seq``) fills the window when the query starts for the first
    time. Rows in which the column ``passes`` is set go through untouched.
    """
    own = isinstance(buckets, str)
    if not own and size % buckets:
        raise ValueError(f"{buckets} buckets do not divide a window of {size}")
    bucketed = _buckets(rows, key, buckets)
    schema = StructType(list(bucketed.schema.fields))
    if flag:
        schema = schema.add(flag, "boolean")
    initial = None
    if seen is not None:
        initial = _buckets(seen, "url_hash", buckets).groupBy("bucket")
    processor = WindowProcessor(key, pos, size if own else size // buckets, flag, passes)
    kept = bucketed.groupBy("bucket").transformWithStateInPandas(
        processor, outputStructType=schema, outputMode="Append", timeMode="None", initialState=initial)
    return kept.drop("bucket")


def held_hashes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(url_hash, seq) of the window a stopped query has left in its checkpoint, to seed another one's: the state itself is the
    record, no second table is kept. Numbers of several buckets are interleaved."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "hash").load())
    return state.select(F.col("user_map_value.hash").alias("url_hash"), F.col("user_map_key.number").alias("seq"))
