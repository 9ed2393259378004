"""Passages that repeat across documents, by a sparse suffix array.

Of the suffixes of a text only those are kept that start at a minimiser: in every
window of ``WINDOW`` positions, the one whose next ``GRAM`` words hash lowest. The choice
depends on content only, so equal passages keep the same suffixes, and every
passage of ``PASSAGE`` words holds at least one with ``RIGHT`` words of it to its right.

1. The kept suffixes of all documents are sorted, by a hash of their first ``RIGHT`` words,
   then by a hash of their whole surroundings: all passages of ``PASSAGE`` words
   for which the suffix is the minimiser. The sort is by ranges of both and of the document, so a passage
   that very many documents share spreads over many tasks.
2. Neighbours are compared. Equal surroundings in two documents: all of it repeats. Equal
   first words only: the match is to be extended.
3. To extend to the left and right, one suffix of each kind of surroundings, or one of each of two
   documents that share it, emits its passages one by one (the texts are fetched by document), and
   those that two documents emit repeat.

Every repeated passage of ``PASSAGE`` words is found, whatever it overlaps, and no pairs are
made: a passage that m documents share costs m rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import saved

PASSAGE = 50
WINDOW = 26
GRAM = 8
RIGHT = PASSAGE - WINDOW + 1
# Fixed values of the rolling hash: an odd base and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xD6E8FEB86659FD93)
SUFFIXES = "key long, around long, doc_id long, first int, last int"


class Rolling:
    """Hashes of runs of words, modulo 2^64: sums of word hashes times powers of the base."""

    def __init__(self):
        self.up, self.down = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), 4096)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, BASE, dtype=np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size, INVERSE, dtype=np.uint64)], dtype=np.uint64)

    def sums(self, words: list[bytes]) -> np.ndarray:
        self._grow(len(words))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        return np.r_[np.uint64(0), np.cumsum(hashes * self.up[:len(words)], dtype=np.uint64)]

    def runs(self, sums: np.ndarray, starts: np.ndarray, lengths) -> np.ndarray:
        return (sums[starts + lengths] - sums[starts]) * self.down[starts]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX
    values = (values ^ (values >> np.uint64(29))) * MIX
    return values ^ (values >> np.uint64(32))


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def suffixes(rolling: Rolling, words: list[bytes]) -> tuple[np.ndarray, ...]:
    """(key, around, first, last) of the kept suffixes; first and last: the starts of the passages it stands for."""
    n = len(words)
    if n < PASSAGE:
        return (np.zeros(0, dtype=np.int64),) * 4
    sums = rolling.sums(words)
    grams = _mixed(rolling.runs(sums, np.arange(n - PASSAGE + WINDOW), GRAM))
    # Each passage's minimiser, the leftmost of equals; the places never go back.
    place = np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(axis=1) + np.arange(n - PASSAGE + 1)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    key = rolling.runs(sums, place[first], RIGHT)
    around = rolling.runs(sums, first, last - first + PASSAGE) ^ _mixed(((place[first] - first) * 64 + (last - first)).astype(np.uint64))
    return _mixed(key).view(np.int64), around.view(np.int64), first, last


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rolling = Rolling()
    for batch in batches:
        found, names = [], []
        for name, text in zip(batch["doc_id"].tolist(), batch["text"]):
            rows = suffixes(rolling, split(text))
            if len(rows[0]):
                found.append(rows)
                names.append(np.full(len(rows[0]), name, dtype=np.int64))
        if found:
            key, around, first, last = (np.concatenate(column) for column in zip(*found))
            yield pd.DataFrame({"key": key, "around": around, "doc_id": np.concatenate(names), "first": first.astype(np.int32), "last": last.astype(np.int32)})


class Neighbours:
    """Walks sorted suffixes and holds one kind of surroundings at a time.

    ``whole`` gets suffixes whose surroundings another document has too, ``open`` those to extend.
    Suffixes of one document with equal surroundings are held together: at most as many as the
    document has words.
    """

    def __init__(self):
        self.whole: list[tuple] = []
        self.open: list[tuple] = []
        self.key = self.around = None
        self.shared = False
        self.edge = True      # the first and the last group may go on in another task
        self.kinds = 0
        self.held: list[tuple] = []
        self.pending: list[tuple] = []

    def add(self, key: int, around: int, row: tuple) -> None:
        if key != self.key or around != self.around:
            self._end_kind()
            if key != self.key:
                self._end_group()
                self.edge = self.key is None
                self.key, self.kinds = key, 0
            self.around, self.shared, self.held = around, False, []
        if not self.shared and self.held and row[0] != self.held[0][0]:
            self.shared = True
            self.whole += self.held
            self.held[1:] = [row]  # two documents stand for all of this kind
        if self.shared:
            self.whole.append(row)
        else:
            self.held.append(row)

    def _end_kind(self) -> None:
        if self.held:
            self.kinds += 1
            self.pending += self.held
            self.held = []
            if self.kinds > 1 or self.edge:
                self.open += self.pending
                self.pending = []

    def _end_group(self) -> None:
        self.pending = []

    def finish(self) -> None:
        self.edge = True
        self._end_kind()
        self.open += self.pending
        self.pending = []


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    walk = Neighbours()

    def frame():
        rows = [(*r, False) for r in walk.whole] + [(*r, True) for r in walk.open]
        walk.whole, walk.open = [], []
        return pd.DataFrame(rows, columns=["doc_id", "first", "last", "open"]).astype({"doc_id": "int64", "first": "int32", "last": "int32", "open": bool})

    for batch in batches:
        key = batch["key"].to_numpy()
        if not len(key):
            continue
        same = key[1:] == key[:-1]
        # A suffix unlike both neighbours matches nothing; those at the ends of a batch may.
        alike = np.r_[True, same] | np.r_[same, True]
        part = batch[alike]
        for k, a, d, f, l in zip(part["key"].tolist(), part["around"].tolist(), part["doc_id"].tolist(), part["first"].tolist(), part["last"].tolist()):
            walk.add(k, a, (d, f, l))
        yield frame()
    walk.finish()
    yield frame()


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rolling = Rolling()
    for batch in batches:
        hashes, names, starts = [], [], []
        for name, text, firsts, lasts in zip(batch["doc_id"].tolist(), batch["text"], batch["firsts"], batch["lasts"]):
            words = split(text)
            places = np.unique(np.concatenate([np.arange(f, l + 1) for f, l in zip(firsts, lasts)]))
            places = places[places + PASSAGE <= len(words)]
            if len(places):
                hashes.append(rolling.runs(rolling.sums(words), places, PASSAGE).view(np.int64))
                names.append(np.full(len(places), name, dtype=np.int64))
                starts.append(places.astype(np.int32))
        if hashes:
            yield pd.DataFrame({"hash": np.concatenate(hashes), "doc_id": np.concatenate(names), "first": np.concatenate(starts)})


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for name, starts, ends in zip(batch["doc_id"].tolist(), batch["starts"], batch["ends"]):
            order = np.argsort(starts, kind="stable")
            starts, ends = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
            begins = np.r_[True, starts[1:] > ends[:-1]]
            last = np.r_[np.flatnonzero(begins)[1:] - 1, len(starts) - 1]
            passages = list(zip(starts[begins].tolist(), ends[last].tolist()))
            out.append((name, len(passages), sum(b - a for a, b in passages), [{"start": a, "end": b} for a, b in passages]))
        yield pd.DataFrame(out, columns=["doc_id", "n_passages", "n_words", "passages"])


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_passages, n_words, passages) of each document with words that repeat elsewhere.

    ``passages`` are the longest runs (start, end), counted in words, end exclusive, in which every
    ``PASSAGE`` words in a row also stand in another document. Words are what lies between white space, as they are.
    Null and empty texts and those with fewer words hold none. Rows with a null id take no part; rows
    of one id are one document. Other columns are not read. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    kept = saved(rows.mapInPandas(_kept, SUFFIXES), "suffixes")
    ordered = kept.repartitionByRange("key", "around", "doc_id", "first").sortWithinPartitions("key", "around", "doc_id", "first")
    matched = saved(ordered.mapInPandas(_compared, "doc_id long, first int, last int, open boolean"), "matches")
    whole = matched.filter("not open").select("doc_id", F.col("first").alias("start"), (F.col("last") + PASSAGE).alias("end"))
    extend = matched.filter("open").groupBy("doc_id").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    passages = saved(rows.join(extend, "doc_id").mapInPandas(_passages, "hash long, doc_id long, first int"), "passages")
    # A passage that very many documents share: counted in the map tasks, joined back with its rows split by the planner.
    shared = passages.groupBy("hash").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a <> b").select("hash")
    single = passages.join(shared, "hash").select("doc_id", F.col("first").alias("start"), (F.col("first") + PASSAGE).alias("end"))
    spans = whole.unionByName(single).groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return spans.mapInPandas(_joined, "doc_id long, n_passages int, n_words long, passages array<struct<start: int, end: int>>")
