"""Substring dedup: documents are streamed past suffix automata of reference shards for their matching statistics.

A window of ``WINDOW`` words goes if the same words also start in a document with a smaller id. The
automaton of a shard holds the passages of earlier documents; walking a text through it gives at
every word the length of the longest suffix the shard holds, and where that reaches ``WINDOW`` a window ends that came before.

One automaton of everything grows with the corpus and cannot be broadcast, so shards are cut by content. Of the ``GRAM``-word
grams of a window the one with the least hash names its shard: equal windows name the same shard wherever they stand, and
neighbouring windows mostly name one too, so a text falls into runs.

1. Grams that hold more than one in ``SHARE`` of all runs are found from a sample of them (at most ``SHARE``
   grams): the *heavy* grams.
2. Narrow rows (gram, document) tell which other grams two documents share. All other runs are unique and stay where they are.
3. Runs of shared grams are shuffled by gram, in order of the documents; each shard's task lets a document's runs walk its
   automaton, then adds what was new in them.
4. A heavy gram would make one task too long. Its windows become shards of their own; those windows that are
   themselves heavy (again at most ``SHARE``) are kept in one automaton, with the first document of each, that is broadcast.
5. Spans go back to the documents, whose words outside them are kept. The texts are shuffled once, for 3 and 5 alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.shared import saved

WINDOW = 13
GRAM = 5               # longer ones are seldom shared by chance, shorter ones make longer runs
SHARE = 32_768         # a gram or window is heavy when it holds more than one in so many,
LEAST_HEAVY = 100      # and more than so many
ONE_IN = 64            # runs of which one is looked at to find heavy grams
PART_WORDS = 65_536    # a longer text is cut into parts that overlap by a window less one word
BLOCK_BYTES = 1 << 19  # texts are hashed together in blocks of about this size; arrays of 8 bytes for each byte are held
SLICE = 256            # rows of a batch that are Python objects at a time

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Automaton:
    """Suffix automaton of several word sequences; ``owner`` holds a number for sequences that were given one."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.owner: dict[int, int] = {}

    def _state(self, length: int, link: int, onward: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(onward)
        return len(self.length) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A copy of ``q`` for the shorter strings that reach it from ``p``."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list, owner: int | None = None) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = new
        if owner is not None:
            self.owner[last] = owner

    def statistics(self, words: list, most: int | None = None) -> Iterator[tuple[int, int]]:
        """(length, state) of the longest suffix found at each word; ``most`` limits the length."""
        state, length = 0, 0
        onward, link, lengths = self.next, self.link, self.length
        for word in words:
            while state and word not in onward[state]:
                state = link[state]
                length = lengths[state]
            state = onward[state].get(word, 0)
            length = length + 1 if state else 0
            if most is not None and length >= most:
                length = most
                while lengths[link[state]] >= most:
                    state = link[state]
            yield length, state


@dataclass
class Block:
    """Texts, or parts of them, that are hashed together. ``rows``: index of each part's row, ``begins``: its first word's number in the text."""

    rows: list[int] = field(default_factory=list)
    begins: list[int] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    data: list[bytes] = field(default_factory=list)
    size: int = 0

    def add(self, row: int, begin: int, words: list[bytes]) -> None:
        self.rows.append(row)
        self.begins.append(begin)
        self.counts.append(len(words))
        self.data.append(b" ".join(words))
        self.size += len(self.data[-1]) + 1


_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < size:
        _POWERS.clear()
        for base in (BASE, INVERSE):
            table = np.full(max(size, BLOCK_BYTES * 2) + 1, base)
            table[0] = 1
            _POWERS.append(np.cumprod(table, out=table))
    return _POWERS[0], _POWERS[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


@dataclass
class Runs:
    """Runs of windows of a block that name one gram: ``part``, first byte, end byte, first word in the part, number of windows."""

    gram: np.ndarray
    part: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    from_byte: np.ndarray
    to_byte: np.ndarray
    data: bytes
    word_from: np.ndarray
    word_to: np.ndarray
    first: np.ndarray


def runs_of(block: Block) -> Runs | None:
    """The runs of a block, in order; None without any window."""
    data = b"\n".join(d for d in block.data if d)
    raw = np.frombuffer(data, dtype=np.uint8)
    counts = np.array(block.counts)
    full = np.flatnonzero(counts)
    if counts.max(initial=0) < WINDOW:
        return None
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    begin, end = np.r_[0, ends + 1], np.r_[ends, len(raw)]
    part = np.repeat(full, counts[full])
    number = np.arange(len(part)) - np.repeat(np.cumsum(counts[full]) - counts[full], counts[full])
    powers, inverse = _powers(len(raw))
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    total[1:] = raw
    total[1:] += np.uint64(1)
    total[1:] *= powers[:len(raw)]
    np.cumsum(total, out=total)
    grams = len(begin) - GRAM + 1
    h = _mixed((total[end[GRAM - 1:]] - total[begin[:grams]]) * inverse[begin[:grams]])
    h[part[:grams] != part[GRAM - 1:]] = np.uint64(2 ** 64 - 1)
    least, width, wanted = h, 1, WINDOW - GRAM + 1
    while width * 2 <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if wanted > width:
        least = np.minimum(least[:len(least) - (wanted - width)], least[wanted - width:])
    at = np.flatnonzero(part[:len(part) - WINDOW + 1] == part[WINDOW - 1:])
    name, owner = least[at], part[at]
    edge = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])])
    windows = np.diff(np.r_[edge, len(at)])
    first = at[edge]
    return Runs(name[edge].view(np.int64), owner[edge], number[first], windows, begin[first], end[first + windows + WINDOW - 2],
                data, begin, end, first)


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a batch, one at a time."""
    return (text.as_py() for text in column)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def blocks(rows: Iterator[tuple[int, str | None]]) -> Iterator[Block]:
    """Blocks of whole texts (index, text); long ones are cut into overlapping parts."""
    block = Block()
    for i, text in rows:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        for begin in range(0, max(1, len(words) - WINDOW + 1), PART_WORDS):
            block.add(i, begin, words[begin:begin + PART_WORDS + WINDOW - 1])
            if block.size >= BLOCK_BYTES:
                yield block
                block = Block()
    if block.rows:
        yield block


def heavy_grams(docs: DataFrame, share: int = SHARE, least: int = LEAST_HEAVY, one_in: int = ONE_IN) -> np.ndarray:
    """Grams that name more than one in ``share`` of all runs (and ``least``), judged by one run in ``one_in``; at most ``share`` come back.

    The sample only settles how the work is dealt out: a gram that it overlooks or adds changes no result.
    """
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((0, t) for batch in batches for t in _texts(batch.column("text")))
        for block in blocks(texts):
            runs = runs_of(block)
            if runs is not None:
                seed = np.uint64(zlib.crc32(runs.data))
                chosen = _mixed((np.arange(len(runs.gram), dtype=np.uint64) + seed) * BASE) % np.uint64(one_in) == 0
                yield pa.RecordBatch.from_arrays([pa.array(runs.gram[chosen])], ["gram"])

    seen = saved(docs.select("text").mapInArrow(sample, "gram long").groupBy("gram").agg(F.count("*").alias("n")), "counts")
    size = seen.agg(F.sum("n")).first()[0] or 0
    top = seen.filter((F.col("n") * one_in > least) & (F.col("n") * share > size)).select("gram").collect()
    return np.sort(np.array([r.gram for r in top], dtype=np.int64))


def _windows(runs: Runs, i: int) -> Iterator[tuple[int, bytes]]:
    """(first word in the part, text) of each window of a run."""
    for k in range(int(runs.first[i]), int(runs.first[i] + runs.windows[i])):
        yield int(runs.start[i]) + k - int(runs.first[i]), runs.data[runs.word_from[k]:runs.word_to[k + WINDOW - 1]]


def heavy_windows(docs: DataFrame, grams: np.ndarray, share: int = SHARE, least: int = LEAST_HEAVY) -> Automaton:
    """Automaton of the windows of heavy grams that hold more than one in ``share`` of these windows, with their first documents.

    Windows are counted by map-side aggregates, so a window in a third of all texts reaches the shuffle once a task.
    """
    automaton = Automaton()
    if not len(grams):
        return automaton

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for block in blocks(enumerate(_texts(batch.column("text")))):
                runs = runs_of(block)
                if runs is None:
                    continue
                out = [(block.rows[runs.part[i]], w) for i in np.flatnonzero(np.isin(runs.gram, grams)).tolist() for _, w in _windows(runs, i)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array([r for r, _ in out], pa.int64())), pa.array([w.decode("utf-8", "surrogatepass") for _, w in out], pa.string())], ["doc_id", "words"])

    found = docs.select("doc_id", "text").mapInArrow(emit, "doc_id long, words string")
    sums = saved(found.groupBy("words").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")), "windows")
    size = sums.agg(F.sum("n")).first()[0] or 0
    for row in sums.filter((F.col("n") > least) & (F.col("n") * share > size)).select("words", "doc_id").collect():
        automaton.add(row.words.encode("utf-8", "surrogatepass").split(), row.doc_id)
    return automaton


def _shared_grams(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """(doc_id, grams): the grams of each document that another document has too; heavy ones are left out."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for block in blocks(enumerate(_texts(batch.column("text")))):
                runs = runs_of(block)
                if runs is None:
                    continue
                rows = np.array(block.rows)[runs.part]
                order = np.lexsort((runs.gram, rows))
                rows, grams = rows[order], runs.gram[order]
                keep = np.r_[True, (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])] & ~np.isin(grams, heavy)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[keep])), pa.array(grams[keep])], ["doc_id", "gram"])

    own = docs.select("doc_id", "text").mapInArrow(emit, "doc_id long, gram long")
    group = Window.partitionBy("gram")
    shared = own.select("doc_id", "gram", (F.min("doc_id").over(group) < F.max("doc_id").over(group)).alias("shared")).filter("shared")
    return shared.groupBy("doc_id").agg(F.collect_set("gram").alias("grams"))


def _candidates(heavy: np.ndarray, known):
    """Runs of shared grams, and the windows of heavy ones: those the broadcast automaton holds come as finished spans (``gram`` null)."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton: Automaton = known.value
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            lists = batch.column("grams")
            for block in blocks(enumerate(_texts(batch.column("text")))):
                runs = runs_of(block)
                if runs is None:
                    continue
                here = lists.take(pa.array(sorted(set(block.rows)), pa.int64())).flatten().to_numpy(zero_copy_only=False)
                out: list[tuple] = []
                for i in np.flatnonzero(np.isin(runs.gram, here)).tolist():
                    row = block.rows[runs.part[i]]
                    out.append((int(runs.gram[i]), ids[row], rows[row], block.begins[runs.part[i]] + int(runs.start[i]),
                                runs.data[runs.from_byte[i]:runs.to_byte[i]]))
                for i in np.flatnonzero(np.isin(runs.gram, heavy)).tolist():
                    row, begin = block.rows[runs.part[i]], block.begins[runs.part[i]]
                    words = runs.data[runs.from_byte[i]:runs.to_byte[i]].split()
                    place = dict(_windows(runs, i))
                    for at, (length, state) in enumerate(automaton.statistics(words, WINDOW)):
                        if at < WINDOW - 1:
                            continue
                        first = int(runs.start[i]) + at - WINDOW + 1
                        owner = automaton.owner.get(state) if length == WINDOW else None
                        if owner is None:  # a window on its own, its words name its shard
                            window = place[first]
                            out.append((xxhash.xxh64_intdigest(window) - (1 << 63), ids[row], rows[row], begin + first, window))
                        elif owner < ids[row]:
                            out.append((None, ids[row], rows[row], begin + first, b""))
                if out:
                    gram, doc, key, first, text = zip(*out)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(gram, pa.int64()), pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(first, pa.int32()),
                        pa.array([t.decode("utf-8", "surrogatepass") for t in text], pa.string())], _NAMES)

    return emit


_NAMES = ["gram", "doc_id", "row", "first", "words"]
_CANDIDATE = "gram long, doc_id long, row long, first int, words string"
_SPAN = "doc_id long, row long, start int, stop int"


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order of (gram, document): each walks the automaton of its shard, then what was new in it is added.

    Runs of one document wait until the next document's begin, so that none meets its own.
    """
    gram = doc = None
    automaton, waiting = Automaton(), []
    for batch in _slices(batches):
        out: list[tuple] = []
        for name, number, row, first, text in zip(*(batch.column(c).to_pylist() for c in _NAMES)):
            if name is None:
                out.append((number, row, first, first + WINDOW))
                continue
            if name != gram:
                gram, doc, automaton, waiting = name, number, Automaton(), []
            elif number != doc:
                for words in waiting:
                    automaton.add(words)
                doc, waiting = number, []
            words, known, open_at = text.encode("utf-8", "surrogatepass").split(), 0, None
            for at, (length, _) in enumerate(automaton.statistics(words)):
                if length >= WINDOW:
                    known += 1
                    if open_at is None or at - WINDOW + 1 > open_at[1]:
                        if open_at:
                            out.append((number, row, first + open_at[0], first + open_at[1]))
                        open_at = [at - WINDOW + 1, at + 1]
                    open_at[1] = at + 1
            if open_at:
                out.append((number, row, first + open_at[0], first + open_at[1]))
            if known < len(words) - WINDOW + 1:
                waiting.append(words)
        if out:
            doc_ids, rows, starts, stops = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())],
                                             ["doc_id", "row", "start", "stop"])


def _joined_spans(found: list[dict] | None, row: int, size: int) -> list[tuple[int, int]]:
    """Maximal spans of one row, in order."""
    out: list[list[int]] = []
    for start, stop in sorted({(s["start"], s["stop"]) for s in found or () if s["row"] == row}):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, min(b, size)) for a, b in out]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        counts, spans, texts = [], [], []
        for text, row, found in zip(*(batch.column(c).to_pylist() for c in ("text", "row", "found"))):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            gone = _joined_spans(found, row, len(words)) if found else []
            counts.append(len(words))
            spans.append([{"start": a, "stop": b} for a, b in gone])
            for a, b in reversed(gone):
                del words[a:b]
            texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()),
                                          pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array(texts, pa.string())],
                                         ["doc_id", "n_words", "spans", "kept"])


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, least: int = LEAST_HEAVY, one_in: int = ONE_IN) -> DataFrame:
    """Every document without the passages that an earlier one holds: (doc_id, n_words, spans, kept).

    ``spans`` are the maximal removed spans, as word numbers (start, stop); ``kept`` are the other words, joined by one
    blank. Earlier means a smaller id: rows with one id do not take from each other, and a row with a null id
    neither gives nor loses. Null and empty texts have no words. Repeated rows each get a row. Other columns are not read.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    named = own.filter(F.col("doc_id").isNotNull())
    heavy = heavy_grams(named, share, least, one_in)
    known = spark.sparkContext.broadcast(heavy_windows(named, heavy, share, least))
    # Both joins below use the one exchange of the texts by id.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = named.withColumn("row", F.xxhash64("text")).repartition(tasks, "doc_id")
    grams = texts.join(_shared_grams(named, heavy), "doc_id", "left")
    runs = grams.select("doc_id", "row", "text", "grams").mapInArrow(_candidates(heavy, known), _CANDIDATE)
    # Finished spans have no gram; they are dealt by document.
    ordered = runs.repartition(tasks, F.coalesce("gram", F.xxhash64("doc_id", "first"))).sortWithinPartitions("gram", "doc_id", "first")
    spans = ordered.mapInArrow(_streamed, _SPAN)
    found = spans.groupBy("doc_id").agg(F.collect_set(F.struct("row", "start", "stop")).alias("found"))
    rows = texts.join(found, "doc_id", "left").select("doc_id", "text", "row", "found")
    odd = own.filter(F.col("doc_id").isNull()).select("doc_id", "text", F.lit(0).cast("long").alias("row"), F.lit(None).cast(found.schema["found"].dataType).alias("found"))
    out = "doc_id long, n_words long, spans array<struct<start: int, stop: int>>, kept string"
    # Put together behind the last step: a union of their inputs would part the two uses of the exchange.
    return rows.mapInArrow(_kept, out).unionByName(odd.mapInArrow(_kept, out))
