"""Token ids in a compact binary file format: static range asymmetric numeral coding.

A *token file* is a Parquet table of blocks, written and committed by Spark, so it lies in
any store Spark can write and survives lost executors. Beside it lies the frequency table
all blocks share. A block holds whole documents, some ``BLOCK`` ids or more, and is
decoded on its own:

    header   magic, version, CRC of the frequency table, part, sequence number, first id's place in the corpus,
             number of documents, ids, lanes and words
    documents  ids (long), null flags (byte), numbers of token ids (unsigned 32 bits)
    states   one 64-bit state for each lane, as the decoder starts
    checkpoints  after every ``CHECK`` steps: place in the words and the states of all lanes
    words    32-bit words, in the order the decoder takes them
    checksum CRC-32 of all of the above

Id i of a block belongs to lane i mod lanes; all lanes take a step together, so a
step is a few vector operations. A reader may start at any checkpoint. Blocks are ordered
by (part, sequence number), documents by ascending id, null ids first.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.shared import saved
from newsloom.session import run_dir

END = 0
BLOCK = 1 << 18
LANES = 1024
CHECK = 128
SCALE = 20               # frequencies add up to 2^20
LOW = np.uint64(1 << 31)  # states lie between 2^31 and 2^63
MAGIC = b"NLTK"
HEADER = "<4sHIIIQIIII"
# Marks of the word cutter, and the texts it must handle apart: with white space in a row, or with a mark.
BEGIN, LINE, LAST = "\x01", "\x02", "\x03"
IN_A_ROW = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2}|[\x01-\x03]"
HELD = re.compile("[\x01-\x03]")
PIECES = re.compile(r"(?<=\S)(?= )")
MARKS = ".,;:!?"
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
CORE = f"[0-9{LETTERS}]$"
REMEMBERED = 800_000     # words whose ids a worker keeps, as Arrow and Numpy columns: some 30 MB
LONGEST = 64             # bytes of a remembered word, at most
TOGETHER = 100           # words tokenized as lines of one text; with longer texts a word takes up to twice the time
GULP = 2_000_000         # bytes tokenized at a time


# --- tokenizing ---------------------------------------------------------------------------------------------------------

def _worker() -> dict:
    """A dictionary that lives as long as the Python worker, so tasks share it."""
    return sys.modules.setdefault("newsloom_worker", types.ModuleType("newsloom_worker")).__dict__


def _taken(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids in a row and the number of ids of each word, for the words ``which`` of others given alike."""
    lists = pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)]), pa.array(ids))
    return lists.take(pa.array(which)).flatten().to_numpy(), sizes[which]


class Encoder:
    """Token ids of whole columns of texts.

    Words are cut and numbered in Arrow, each different one of a column is tokenized once, and the
    ids are gathered by word number. That is exact: the byte-level pattern never joins a
    blank to what comes before it, and takes a line feed between other characters alone, so no token crosses a cut.
    A word stands for itself with its leading blank; ``LINE`` before it stands for a line feed and
    no blank, ``BEGIN`` for no blank; ``LAST`` is the end of a document.

    A word of Latin letters, with or without a blank before it, is one piece for the pattern, so it goes straight to the tokenizer's model, in the
    byte-level alphabet. Other words are tokenized many at once as the lines of one text, whose line feeds show in the ids where words end. Words with
    other white space, empty ones and those that hold a special token are tokenized apart.
    A mark that ends a word of letters is a token apart, so words that differ in it share the rest.

    A text with white space in a row is cut before blanks that follow a character which is no space.
    A text that holds one of the marks is tokenized as it is.
    """

    def __init__(self, tokenizer: str, dtype: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.dtype = Tokenizer.from_str(tokenizer), dtype
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.apart = re.compile("|".join([r"\s", *map(re.escape, special)]))
        self.model, letters = self.tokenizer.model, [c for c in map(chr, range(0x250)) if re.match(f"[ {LETTERS}]", c)]
        self.alphabet = str.maketrans({c: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0] for c in letters})
        # A special token of letters could hide in a word, and another tokenizer could change or cut words of letters.
        self.direct = (self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, ByteLevel)
                       and not any(re.fullmatch(f"[ {LETTERS}]+", t) for t in special)
                       and all(self._model_ids([w])[0] == self._ids(w).tolist() for w in ["".join(letters), "".join(letters[1:])]))
        feed = self._ids("\n")
        self.feed_id = int(feed[0])
        # Without a line feed of its own id, words are tokenized one by one.
        self.feed = int(feed[0]) if len(feed) == 1 and self._ids("a\n b")[1:-1].tolist() == feed.tolist() else None
        self._forget()

    def _forget(self) -> None:
        self.known, self.known_sizes, self.known_ids = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, self.dtype)
        self.again = np.zeros(0, dtype=bool)  # known words that were looked up again

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)

    def _model_ids(self, words: list[str]) -> list[list[int]]:
        """Ids of words of letters."""
        return [[t.id for t in self.model.tokenize(w)] for w in "\n".join(words).translate(self.alphabet).split("\n")]

    def _tokenized(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in a row, and the number of ids of each."""
        marked = pc.or_(pc.starts_with(words, pattern=BEGIN), pc.starts_with(words, pattern=LINE))
        plain = pc.if_else(marked, pc.utf8_slice_codeunits(words, 1), pc.binary_join_element_wise(" ", words, ""))
        direct = np.zeros(len(words), dtype=bool)
        if self.direct:
            direct = pc.match_substring_regex(plain, f"^ ?[{LETTERS}]+$").to_numpy(zero_copy_only=False)
        found, sizes = [np.zeros(0, self.dtype)], []
        texts = plain.filter(pa.array(direct)).to_pylist()
        for at in range(0, len(texts), TOGETHER):
            each = self._model_ids(texts[at:at + TOGETHER])
            sizes += map(len, each)
            found.append(np.array(list(chain.from_iterable(each)), dtype=self.dtype))
        texts = plain.filter(pa.array(~direct)).to_pylist()
        for at in range(0, len(texts), TOGETHER):
            some = texts[at:at + TOGETHER]
            # Exact unless a word brings white space besides its leading blank, a special token, or nothing.
            inner = "".join([t[1:] if t[:1] == " " else t for t in some])
            if self.feed is not None and "" not in some and " " not in some and not self.apart.search(inner):
                ids = self._ids("\n".join(some))
                ends = np.flatnonzero(ids == self.feed)
                sizes += (np.diff(np.r_[-1, ends, len(ids)]) - 1).tolist()
                found.append(ids[ids != self.feed])
                continue
            each = [self._ids(t) for t in some]
            sizes += map(len, each)
            found += each
        # Back to the order of the words.
        place = np.empty(len(words), np.int64)
        place[np.r_[np.flatnonzero(direct), np.flatnonzero(~direct)]] = np.arange(len(words))
        return _taken(np.concatenate(found), np.array(sizes, np.int64), place)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where different words stand among the known ones, -1 for new words."""
        # The known words are looked up among those at hand, so only these few go into a new hash table for each call.
        found = pc.fill_null(pc.index_in(self.known, value_set=words), -1).to_numpy(zero_copy_only=False)
        at, place = np.flatnonzero(found >= 0), np.full(len(words), -1)
        place[found[at]] = at
        return place

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in a row, and how many each has."""
        place = self._places(words)
        new = np.flatnonzero(place < 0)
        self.again[place[place >= 0]] = True
        fresh = words.take(pa.array(new))
        last = pc.equal(fresh, LAST).to_numpy(zero_copy_only=False)
        ahead = pc.starts_with(fresh, pattern=LINE).to_numpy(zero_copy_only=False) | last
        ids, own = self._tokenized(fresh.filter(pa.array(~last)))
        counts = np.zeros(len(fresh), np.int64)
        counts[~last] = own
        # A line feed before a word, the end id for the end of a document.
        ids = np.insert(ids, (np.cumsum(counts) - counts)[ahead], np.where(last[ahead], END, self.feed_id).astype(self.dtype))
        counts += ahead
        place[new] = len(self.known) + np.arange(len(new))
        all_ids, sizes = _taken(np.r_[self.known_ids, ids], np.r_[self.known_sizes, counts], place)
        if len(self.known) + len(new) > REMEMBERED:  # forget words that were used once, or, if they are few, all that are not used now
            often, known, known_ids, known_sizes = np.flatnonzero(self.again), self.known, self.known_ids, self.known_sizes
            self._forget()
            if len(often) + len(new) <= REMEMBERED // 2:
                self._remember(known.take(pa.array(often)), *_taken(known_ids, known_sizes, often))
                self._remember(fresh, ids, counts)
            else:
                self._remember(words, all_ids, sizes)
        else:
            self._remember(fresh, ids, counts)
        return all_ids, sizes

    def _remember(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        short = np.flatnonzero(pc.binary_length(words).to_numpy(zero_copy_only=False) <= LONGEST)
        ids, sizes = _taken(ids, sizes, short)
        self.known = pa.concat_arrays([self.known, words.take(pa.array(short))])
        self.known_ids, self.known_sizes = np.r_[self.known_ids, ids], np.r_[self.known_sizes, sizes]
        self.again = np.r_[self.again, np.zeros(len(short), dtype=bool)]

    def _with_marks(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Like :meth:`_looked_up`; a mark that ends a word of letters is looked up apart."""
        cores = pc.utf8_rtrim(words, characters=MARKS)
        parted = pc.and_(pc.not_equal(cores, words), pc.match_substring_regex(cores, CORE)).to_numpy(zero_copy_only=False)
        whole = pc.if_else(pa.array(parted), cores, words).dictionary_encode()
        ids, sizes = _taken(*self._looked_up(whole.dictionary), whole.indices.to_numpy())
        if parted.any():
            # Few different ones; the regular expression takes the core off.
            tails = pc.replace_substring_regex(words.filter(pa.array(parted)), f"(?s)^.*[^{MARKS}]", "").dictionary_encode()
            each = [self._ids(t) for t in tails.dictionary.to_pylist()]
            rest, more = _taken(np.concatenate(each), np.array(list(map(len, each))), tails.indices.to_numpy())
            ids = np.insert(ids, np.repeat(np.cumsum(sizes)[parted], more), rest)
            sizes[parted] += more
        return ids, sizes

    def _words(self, texts: pa.Array) -> pa.Array:
        """The words of each text, as lists."""
        marked = pc.binary_join_element_wise(BEGIN, pc.replace_substring(texts, "\n", " " + LINE), " " + LAST, "")
        words = pc.split_pattern(marked, " ")
        odd = pc.match_substring_regex(texts, IN_A_ROW)
        if not pc.any(odd).as_py():
            return words
        lists = words.to_pylist()
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            text = texts[i].as_py()
            first, *rest = PIECES.split(text)
            lists[i] = [BEGIN + first, *(p[1:] for p in rest), LAST] if not HELD.search(text) else [BEGIN + text, LAST]
        return pa.array(lists, pa.list_(pa.string()))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id, and the number of ids of each text."""
        words = self._words(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        ids, long = _taken(*self._with_marks(coded.dictionary), coded.indices.to_numpy())
        before = np.r_[0, np.cumsum(long)]
        bounds = before[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return ids, np.diff(bounds)


def _encoder(tokenizer: str, dtype: str) -> Encoder:
    kept, key = _worker(), (zlib.crc32(tokenizer.encode()), dtype)
    if kept.get("key") != key:
        kept["key"], kept["encoder"] = key, Encoder(tokenizer, dtype)
    return kept["encoder"]


def _tokenized(tokenizer: str, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer, dtype), TaskContext.get().partitionId()
        docs, sizes, body, seq, start, held = [], [], [], 0, 0, 0
        total = np.zeros(0, dtype=np.int64)

        def row(*values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BLOCK_FIELDS)], schema=BLOCK_FIELDS)

        def block() -> pa.RecordBatch:
            return row(part, seq, start, held, docs, sizes, b"".join(body), None, None)

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            lengths = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(names):
                upto = max(at + 1, int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + GULP, side="right")))
                ids, counts = encoder.encode(texts.slice(at, upto - at))
                seen = np.bincount(ids, minlength=len(total))
                seen[:len(total)] += total
                total = seen
                ends = np.cumsum(counts)
                for name, size, end in zip(names[at:upto], counts.tolist(), ends.tolist()):
                    docs.append(name)
                    sizes.append(size)
                    body.append(ids[end - size:end].tobytes())
                    held += size
                    if held >= BLOCK:
                        yield block()
                        docs, sizes, body, seq, start, held = [], [], [], seq + 1, start + held, 0
                at = upto
        if docs:
            yield block()
        used = np.flatnonzero(total)
        if len(used):
            yield row(part, COUNTED, 0, 0, None, None, None, used, total[used])
    return run


# A row is a block, or, with the sequence number COUNTED, holds the ids of a task and how often each occurs there.
COUNTED = -1
BLOCK_FIELDS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("n", pa.int64()),
                          ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary()),
                          ("seen", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])
TOKEN_BLOCKS = "part int, seq int, start long, n long, docs array<long>, sizes array<long>, ids binary, seen array<int>, times array<long>"


# --- the coder ----------------------------------------------------------------------------------------------------------

def frequencies(counts: dict[int, int]) -> np.ndarray:
    """Frequencies of all ids up to the largest, at least 1 where the count is not 0, with a sum of 2^SCALE."""
    table = np.zeros(max(counts, default=0) + 1, dtype=np.int64)
    for token, n in counts.items():
        table[token] = n
    seen = np.flatnonzero(table)
    if len(seen) > 1 << SCALE:
        raise ValueError("more different ids than the frequency table can hold")
    total, goal = int(table.sum()), 1 << SCALE
    share = np.zeros_like(table)
    if not total:
        return share.astype(np.uint32)
    share[seen] = np.maximum(1, table[seen] * float(goal) / total).astype(np.int64)
    order = seen[np.argsort(-share[seen], kind="stable")]
    gap = goal - int(share.sum())
    if gap > 0:
        share[order[0]] += gap
    for token in order:  # what the ones had too little is taken from the largest
        if gap >= 0:
            break
        cut = min(int(share[token]) - 1, -gap, max(1, int(share[token]) // 2))
        share[token] -= cut
        gap += cut
    if gap < 0:
        return frequencies({int(t): int(share[t]) for t in seen})
    return share.astype(np.uint32)


class Coder:
    def __init__(self, table: np.ndarray):
        self.table = table.astype("<u4")
        self.mark = zlib.crc32(self.table.tobytes())
        self.freq = table.astype(np.uint64)
        self.low = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.symbols: np.ndarray | None = None

    def _symbols(self) -> np.ndarray:
        if self.symbols is None:
            self.symbols = np.repeat(np.arange(len(self.table), dtype=np.uint32), self.table)
        return self.symbols

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]], np.ndarray]:
        """First states, checkpoints (place, states) and words of an array of ids."""
        lanes = lane_count(len(ids))
        steps = -(-len(ids) // lanes) if lanes else 0
        state = np.full(lanes, LOW, dtype=np.uint64)
        freq, low = self.freq[ids], self.low[ids]
        out, marks, made = [], [], 0
        for step in range(steps - 1, -1, -1):
            at, upto = step * lanes, min((step + 1) * lanes, len(ids))
            f, x = freq[at:upto], state[:upto - at]
            full = x >= (f << np.uint64(63 - SCALE))
            words = (x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            x = np.where(full, x >> np.uint64(32), x)
            share = x // f
            state[:upto - at] = (share << np.uint64(SCALE)) + (x - share * f) + low[at:upto]
            out.append(words)
            made += len(words)
            if step and step % CHECK == 0:
                marks.append((made, state.copy()))
        words = np.concatenate(out[::-1]) if out else np.zeros(0, dtype="<u4")
        return state, [(made - place, states) for place, states in reversed(marks)], words

    def decode(self, n: int, state: np.ndarray, words: np.ndarray, first: int = 0, steps: int | None = None) -> np.ndarray:
        """Ids from step ``first`` on, from the states and words at that step."""
        lanes, symbols = len(state), self._symbols()
        mask, state, taken = np.uint64((1 << SCALE) - 1), state.copy(), 0
        last = -(-n // lanes) if lanes else 0
        last = last if steps is None else min(last, first + steps)
        out = np.empty(max(0, min(n, last * lanes) - first * lanes), dtype=np.uint32)
        for step in range(first, last):
            size = min(lanes, n - step * lanes)
            x = state[:size]
            slot = x & mask
            ids = symbols[slot]
            x = self.freq[ids] * (x >> np.uint64(SCALE)) + slot - self.low[ids]
            short = np.flatnonzero(x < LOW)
            x[short] = (x[short] << np.uint64(32)) | words[taken:taken + len(short)]
            taken += len(short)
            state[:size] = x
            out[(step - first) * lanes:(step - first) * lanes + size] = ids
        return out


def lane_count(n: int) -> int:
    return min(LANES, -(-n // 64)) if n else 0


def pack(coder: Coder, part: int, seq: int, start: int, docs, sizes, ids: np.ndarray) -> bytes:
    """The bytes of a block."""
    state, marks, words = coder.encode(ids)
    null = np.array([d is None or d != d for d in docs], dtype=np.uint8)
    names = np.array([0 if gone else int(d) for d, gone in zip(docs, null)], dtype="<i8")
    body = b"".join([
        struct.pack(HEADER, MAGIC, 1, coder.mark, part, seq, start, len(docs), len(ids), len(state), len(words)),
        names.tobytes(), null.tobytes(), np.asarray(sizes, dtype="<u4").tobytes(), state.astype("<u8").tobytes(),
        *(struct.pack("<I", place) + states.astype("<u8").tobytes() for place, states in marks), words.tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(data: bytes, check: int | None = None) -> dict:
    """The parts of a block, undecoded. Wrong checksums raise ValueError."""
    if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("the block's checksum is wrong")
    magic, version, mark, part, seq, start, n_docs, n, lanes, n_words = struct.unpack_from(HEADER, data)
    if magic != MAGIC or version != 1 or check not in (None, mark):
        raise ValueError("not a block of this token file")
    at = struct.calcsize(HEADER)

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, dtype, count, at)
        at += out.nbytes
        return out

    names, null, sizes, state = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs), take("<u8", lanes)
    steps = -(-n // lanes) if lanes else 0
    marks = [(step, int(take("<u4", 1)[0]), take("<u8", lanes)) for step in range(CHECK, steps, CHECK)]
    return {"part": part, "seq": seq, "start": start, "n": n, "docs": [None if gone else int(d) for d, gone in zip(names, null)],
            "sizes": sizes, "state": state.astype(np.uint64), "marks": marks, "words": take("<u4", n_words)}


def block_ids(coder: Coder, block: dict, first: int = 0, count: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of an unpacked block, decoded from the nearest checkpoint."""
    n, lanes = block["n"], len(block["state"])
    last = n if count is None else min(n, first + count)
    if first >= last:
        return np.zeros(0, dtype=np.uint32)
    step, place, state = max(((0, 0, block["state"]), *(m for m in block["marks"] if m[0] * lanes <= first)), key=lambda m: m[0])
    steps = -(-last // lanes) - step
    ids = coder.decode(n, state.astype(np.uint64), block["words"][place:], step, steps)
    return ids[first - step * lanes:last - step * lanes]


# --- files --------------------------------------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, tokenizer: str, folder: str) -> None:
    """Tokenize (doc_id, text) and write a token file to ``folder``.

    ``tokenizer`` is the text of a byte-level tokenizer file. Every document ends with
    id ``END``; null texts are empty. Texts cross one shuffle, by ranges of the id; ids are
    kept once in between, as counts must be complete before the first block is coded; each task counts the ids it makes.
    Repeated rows are written each; an empty table gives a file without blocks.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    dtype = "<u2" if Tokenizer.from_str(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    ranged = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc()).sortWithinPartitions(F.col("doc_id").asc(), "text")
    rows = saved(ranged.mapInArrow(_tokenized(tokenizer, dtype), TOKEN_BLOCKS), "token-ids")
    blocks = rows.filter(F.col("seq") != COUNTED).drop("seen", "times")
    counts = rows.filter(F.col("seq") == COUNTED).select(F.explode(F.arrays_zip("seen", "times")).alias("c"))
    counts = counts.groupBy(F.col("c.seen").alias("id")).agg(F.sum("c.times").alias("n"))
    # At most as many rows as the tokenizer has ids.
    table = frequencies({row.id: row.n for row in counts.collect()})
    # One row for each task of the range shuffle.
    sizes = {row.part: row.n for row in blocks.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before, offsets = 0, {}
    for part in sorted(sizes):
        offsets[part], before = before, before + sizes[part]

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(table)
        for batch in batches:
            for row in batch.itertuples():
                ids = np.frombuffer(row.ids, dtype).astype(np.int64)
                data = pack(coder, row.part, row.seq, offsets[row.part] + row.start, row.docs, row.sizes, ids)
                yield pd.DataFrame({"part": [row.part], "seq": [row.seq], "block": [data]})

    coded = blocks.mapInPandas(code, "part int, seq int, block binary").sortWithinPartitions("part", "seq")
    coded.write.option("compression", "none").partitionBy("part").parquet(f"{folder}/blocks")
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(table) if n], "id int, n int").coalesce(1).write.parquet(f"{folder}/table")


def read_table(spark: SparkSession, folder: str) -> np.ndarray:
    rows = spark.read.schema("id int, n int").parquet(f"{folder}/table").collect()
    table = np.zeros(max((r.id for r in rows), default=0) + 1, dtype=np.uint32)
    for row in rows:
        table[row.id] = row.n
    return table


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of a token file; ids are unsigned 32-bit, little-endian.

    With ``ids=False`` they are decoded for their checksum, but not handed on.
    """
    table, wanted = read_table(spark, folder), ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(table)
        for batch in batches:
            for data in batch["block"]:
                block = unpack(data, coder.mark)
                body, ends = block_ids(coder, block).astype("<u4").tobytes(), np.cumsum(block["sizes"].astype(np.int64))
                own = [body[4 * (end - size):4 * end] for size, end in zip(block["sizes"].tolist(), ends.tolist())]
                rows = pd.DataFrame({"doc_id": pd.array(block["docs"], dtype="Int64"), "start": block["start"] + ends - block["sizes"],
                                     "n_tokens": block["sizes"].astype(np.int64), "ids_crc32": [zlib.crc32(i) for i in own]})
                yield rows.assign(ids=own) if wanted else rows

    blocks = spark.read.schema("part int, seq int, block binary").parquet(f"{folder}/blocks").select("block")
    return blocks.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)


def round_trip(docs: DataFrame, tokenizer_file: str, ids: bool = True) -> DataFrame:
    """Write the documents' token file below ``spark.checkpoint.dir`` and read it back."""
    with open(tokenizer_file, encoding="utf-8") as file:
        text = file.read()
    folder = run_dir(docs.sparkSession, "token-file")
    write_tokens(docs, text, folder)
    return read_tokens(docs.sparkSession, folder, ids)
