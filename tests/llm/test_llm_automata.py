"""Substring dedup against a plain table of all windows."""

import random

import numpy as np
import pytest

from newsloom.llm import automata

W = automata.WINDOW


def plain(rows):
    """(doc_id, n_words, kept words) of each row, from a table of all windows and their first documents."""
    split = [(i, (t or "").encode("utf-8", "surrogatepass").split()) for i, t in rows]
    first = {}
    for i, words in split:
        if i is not None:
            for k in range(len(words) - W + 1):
                key = tuple(words[k:k + W])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - W + 1):
            if i is not None and first[tuple(words[k:k + W])] < i:
                gone.update(range(k, k + W))
        out.append((i, len(words), b" ".join(w for k, w in enumerate(words) if k not in gone).decode("utf-8", "surrogatepass")))
    return sorted(out, key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["a", "é", "wörd", "x", "😀"]) + str(i) for i in range(60)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    common = text(60)
    shared = [text(rng.randrange(10, 40)) for _ in range(20)]
    rows = []
    for i in range(n):
        words = text(rng.randrange(0, 30))
        if i % 3 == 0:
            words = words + common[:rng.randrange(20, 60)] + text(5)
        for _ in range(rng.randrange(3)):
            words += rng.choice(shared) + text(rng.randrange(3))
        if i % 17 == 0:
            words = ["b"] * rng.randrange(50)
        rows.append((rng.randrange(10 * n), rng.choice([" ", "\t", "\n  "]).join(words)))
    return rows + rng.sample(rows, 20)


@pytest.mark.parametrize("share, least, one_in", [(automata.SHARE, 10 ** 9, 1), (automata.SHARE, automata.LEAST_HEAVY, automata.ONE_IN), (64, 4, 1), (200, 12, 1), (300, 8, 3)])
def test_against_all_windows(spark, share, least, one_in):
    """Small shares make grams and windows heavy, as a common passage does in a large corpus."""
    rows = corpus(share)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = automata.deduplicated(docs, share=share, least=least, one_in=one_in).collect()
    assert sorted([(r.doc_id, r.n_words, r.kept) for r in got], key=repr) == plain(rows)
    if least < automata.LEAST_HEAVY:
        heavy = automata.heavy_grams(docs, share, least, one_in)
        assert 0 < len(heavy) <= share
        assert automata.heavy_windows(docs, heavy, share, least).owner
    for r in got:
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:])) and all(s.stop - s.start >= W for s in r.spans)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(150_000))
    rows = [(None, long), (None, None), (5, long), (7, None), (7, ""), (3, " \t\n "), (9, "y" * 100_000), (1, long[:500_000]), (5, long),
            (11, "a " * 40), (12, "a " * 13), (13, "a " * 12), (2, long[1000:1400])]
    docs = spark.createDataFrame([(*r, 1, "s", r[0]) for r in rows], "doc_id long, text string, row int, found string, gram long")
    got = automata.deduplicated(docs).collect()
    assert sorted([(r.doc_id, r.n_words, r.kept) for r in got], key=repr) == plain(rows)
    assert automata.deduplicated(docs.limit(0)).collect() == []


def test_automaton_statistics_against_substrings():
    rng = random.Random(2)
    for _ in range(60):
        texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(4)]
        automaton = automata.Automaton()
        for i, t in enumerate(texts):
            automaton.add(list(t), i)
        query = "".join(rng.choice("abc") for _ in range(30))
        for at, (length, state) in enumerate(automaton.statistics(list(query))):
            longest = max(k for k in range(at + 2) if k == 0 or any(query[at + 1 - k:at + 1] in t for t in texts))
            assert length == longest
            whole = query[at + 1 - length:at + 1]
            if length and automaton.length[state] == length and whole in texts:
                assert state in automaton.owner


def test_runs_cover_every_window_and_name_equal_ones_alike():
    rng = random.Random(3)
    words = [f"w{rng.randrange(40)}" for _ in range(3000)]
    names = {}
    for shift in (0, 7, 100):
        block = automata.Block()
        block.add(0, 0, [w.encode() for w in words[shift:]])
        block.add(1, 0, [b"few", b"words"])
        runs = automata.runs_of(block)
        assert runs.windows.sum() == 3000 - shift - W + 1
        for gram, start, n, a, b in zip(runs.gram, runs.start, runs.windows, runs.from_byte, runs.to_byte):
            assert runs.data[a:b].decode() == " ".join(words[shift + start:shift + start + n + W - 1])
            for k in range(start, start + n):
                assert names.setdefault(k + shift, gram) == gram
    assert len(np.unique(list(names.values()))) > 300


def test_block_memory_is_small():
    """The arrays of a full block: the tables of powers, and what hashing it takes besides."""
    import tracemalloc

    text = " ".join(f"w{i % 5000}" for i in range(400_000))
    automata._POWERS.clear()
    tracemalloc.start()
    try:
        n = sum(len(runs.gram) for block in automata.blocks(enumerate([text[:3_000_000 // 40] + f" {i}" for i in range(40)])) if (runs := automata.runs_of(block)) is not None)
        assert n > 0 and tracemalloc.get_traced_memory()[1] < 60_000_000
    finally:
        tracemalloc.stop()
