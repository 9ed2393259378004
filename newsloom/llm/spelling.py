"""Spelling variant groups: words within one edit, by an index of variable-length grams.

1. Grams of 2 letters are all in the dictionary. A gram grows by a letter, up to ``LONGEST``, only where it is frequent:
   more than one in ``SHARE`` of all gram places begin with it. So the dictionary has at most ``SHARE`` gram heads a
   length, each with the letters that follow it, however many words there are; it is broadcast.
2. A word is decomposed into the longest dictionary gram at each place. Looking one up reads no more than
   ``LONGEST`` letters (or the end of the word), so an edit affects only the grams that read its place: that is the word's bound of
   affected grams. It gives each word a *cut*: all grams left of it have read nothing behind it, all
   grams right of it begin behind it, so no single edit can affect grams of both sides.
3. Hence two words one edit apart agree in all grams left of the cut of the one, or in all right of it. The lists
   of these grams are merged at once: the lists of a side's grams meet under one key, the letters they cover, with the length of the word.
   A word is filed under every cut an own or a neighbour's decomposition can choose, and looks in the lists of its own cut only.
4. What is found together is verified by edit distance.

The nearest frequent spelling of a word is its form; forms are followed by doubling steps, as each is
five times as frequent as the one before.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import saved

# Fixed value: letters of a word.
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5          # a form is so many times as frequent
SLIP = 199         # one run in so many loses a letter
SHORTEST, LONGEST = 2, 4
SHARE = 4_096      # a gram is frequent when it heads more than one in so many gram places
COUNTED = 500_000  # different words counted before they are handed on


def slipped(doc_id: int | None, run: str) -> str:
    """The lower-cased run, without one of its letters where the checksum of document and run says so. A null id counts as an empty text."""
    number = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if number % SLIP:
        return run
    at = number % len(run)
    return run[:at] + run[at + 1:]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return rows

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            # Bytes lower-case A-Z only.
            own = Counter(LETTERS.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
            for run, n in own.items():
                word = slipped(doc_id, run)
                if len(word) >= LEAST_LETTERS:
                    counts[word] += n
            if len(counts) > COUNTED:
                yield flush()
    if counts:
        yield flush()


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all documents: words of ``LEAST_LETTERS`` letters or more that occur ``LEAST_COUNT`` times or more."""
    runs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_words, "word string, n long")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_dictionary(words: DataFrame, share: int = SHARE) -> set[str]:
    """Heads of frequent grams: a gram may be one letter longer than its head. Counted over all words, at most ``share`` a length."""
    places = F.sequence(F.lit(1), F.length("word") - SHORTEST + 1)
    heads: set[str] = set()
    grams = words.filter(F.length("word") >= SHORTEST).select("word", F.explode(places).alias("at"))
    total = grams.count()
    for size in range(SHORTEST, LONGEST):
        found = grams.select(F.substring(F.col("word"), F.col("at"), F.lit(size)).alias("gram")).filter(F.length("gram") == size)
        often = found.groupBy("gram").count().filter(F.col("count") * share > total)
        heads |= {r.gram for r in often.select("gram").collect()}
    return heads


def grams_of(word: str, heads: set[str]) -> list[tuple[int, int]]:
    """(end of the gram, end of what was read to find it) for each place of a word; the end of the word counts as a letter."""
    out, size = [], len(word)
    for at in range(size - SHORTEST + 1):
        end = at + SHORTEST
        while end - at < LONGEST and end < size and word[at:end] in heads:
            end += 1
        # A frequent gram at the end of the word was cut off by it.
        out.append((end, end + 1 if end == size and end - at < LONGEST and word[at:end] in heads else end))
    return out


def cuts_of(word: str, heads: set[str]) -> list[int]:
    """Ends of what the grams from the left have read, in order: an edit at or behind a cut leaves all grams left of it as they are."""
    ends, reach = [], 0
    for _, read in grams_of(word, heads):
        if read > reach:
            reach = read
            ends.append(reach)
    return ends


def chosen_cut(word: str, heads: set[str]) -> int:
    """The cut nearest the middle that has room for a gram behind it; words of six letters have one, as ``LONGEST`` is four."""
    size = len(word)
    return min((c for c in cuts_of(word, heads) if c <= size - SHORTEST), key=lambda c: (abs(2 * c - size), c))


def lists_of(word: str, heads: set[str]) -> list[tuple[str, int]]:
    """(side, place) of the lists a word is filed under: all cuts that a word of its length, or one letter more or less, can choose."""
    size = len(word)
    # Neighbouring cuts are at most LONGEST - 1 apart, so a chosen one is no further than that from the middle.
    low, high = (size - 1) // 2 - LONGEST + 1, (size + 2) // 2 + LONGEST - 1
    left = [("l", c) for c in cuts_of(word, heads) if low <= c <= min(high, size)]
    right = [("r", size - n) for n in range(max(SHORTEST, low), min(high, size) + 1)]
    return left + right


def _filed(heads: set[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                for side, at in lists_of(word, heads):
                    rows.append(i)
                    keys.append(f"{side}{len(word)}:{word[:at] if side == 'l' else word[at:]}")
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(batch.column(c).take(pa.array(rows, pa.int64())) for c in ("word", "n"))],
                                             ["list", "other", "other_n"])
    return run


def _asked(heads: set[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, cuts = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                cut, size = chosen_cut(word, heads), len(word)
                for length in (size, size + 1):  # words of the same length, and those with a letter more
                    rows += [i, i]
                    cuts += [0, cut]
                    keys += [f"l{length}:{word[:cut]}", f"r{length}:{word[cut:]}"]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(cuts, pa.int32()), *(batch.column(c).take(pa.array(rows, pa.int64())) for c in ("word", "n"))],
                                             ["list", "cut", "word", "n"])
    return run


def near_pairs(words: DataFrame, heads: set[str]) -> DataFrame:
    """(word, n, other, other_n): each two different words exactly one edit apart, once.

    The word with fewer letters, or the smaller one, asks. A pair that agrees left of its cut is found in the left
    list only. A list that is long for one task is split by AQE's skew join.
    """
    filed = words.mapInArrow(_filed(heads), "list string, other string, other_n long")
    asked = words.mapInArrow(_asked(heads), "list string, cut int, word string, n long")
    left = F.substring(F.col("word"), F.lit(1), F.col("cut"))
    met = asked.join(filed, "list").filter(
        ((F.length("other") > F.length("word")) | (F.col("other") > F.col("word")))
        & ((F.col("cut") == 0) | (left != F.substring(F.col("other"), F.lit(1), F.col("cut")))))
    return met.filter(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: each step doubles the distance, and frequencies grow by ``TIMES``, so few are needed."""
    roots = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = saved(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        roots = moved.select("word", "root")


def variants(words: DataFrame, share: int = SHARE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for rows (word, n), each word once, of ``LEAST_LETTERS`` letters or more."""
    words = saved(words, "words")
    pairs = near_pairs(words, gram_dictionary(words, share))
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("best")
    near = saved(both.groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), best), "near")
    frequent: Column = -F.col("best.m") >= TIMES * F.col("n")
    forms = near.filter(frequent).select("word", F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n"))
    roots = _roots(forms)
    out = words.join(near.select("word", "n_near"), "word", "left").join(forms, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """The words of all documents with their frequent spelling: (word, form, root, n, n_near, form_n).

    ``form`` is the most frequent word one edit away, the smaller one on a tie, if it is ``TIMES`` as
    frequent, else null; ``root`` is the last form. Null and empty texts have no words; repeated rows count
    each. Other columns are not read. An empty table gives an empty result.
    """
    return variants(word_counts(docs, doc_id, text), share)
