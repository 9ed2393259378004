"""Spelling groups against a plain search of all one-letter changes."""

import random
import re
import zlib
from collections import Counter

import pytest

from newsloom.llm import spelling


def plain_counts(rows):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def plain_groups(words):
    letters = sorted(set("".join(words)))
    rows, forms = {}, {}
    for w, n in words.items():
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        near = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
        near = [(-words[x], x) for x in near if x in words and x != w]
        form = min(near)[1] if near and -min(near)[0] >= 5 * n else None
        rows[w], forms[w] = (n, len(near), words.get(form)), form
    out = []
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, *rows[w]))
    return sorted(out, key=repr)


def changed(word, rng, letters):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1:]])


@pytest.mark.parametrize("share, letters", [(spelling.SHARE, "abcdé"), (40, "abß"), (10, "ab")])
def test_groups_against_all_changes(spark, share, letters):
    rng = random.Random(share)
    words = {}
    while len(words) < 900:
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 14)))
        for _ in range(rng.randrange(4)):
            words[word] = 5 * 6 ** rng.randrange(7) + rng.randrange(3)
            word = changed(word, rng, letters)
            if len(word) < 6:
                break
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = sorted([tuple(r) for r in spelling.variants(frame, share).select("word", "form", "root", "n", "n_near", "form_n").collect()], key=repr)
    assert got == plain_groups(words)
    assert len([r for r in got if r[1] and r[2] != r[1]]) > 20, "no chain of forms to follow"


def test_documents_and_odd_rows(spark):
    rng = random.Random(4)
    base = ["straße", "Éducation", "réponse", "fingerprint", "fingerprints", "ab", "abcdef", "ÀÉÎõüß", "x" * 300, "x" * 301]
    text = lambda n: " ".join(rng.choice([w, w.upper(), changed(w, rng, "ae") if rng.random() < .05 else w]) for w in rng.choices(base, k=n))
    rows = [(i, text(rng.randrange(40))) for i in range(300)] + [(None, text(50)), (None, None), (5, None), (6, ""), (7, "1 2 ×÷× ———"), (8, text(60_000))]
    rows += rows[:20]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    got = spelling.spelling_groups(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted([tuple(r) for r in got], key=repr) == plain_groups(plain_counts(rows))
    assert len(got) > 20 and any(r.form for r in got)
    assert spelling.spelling_groups(docs.limit(0)).collect() == []


def test_cuts_and_dictionary(spark):
    rng = random.Random(6)
    words = list({"".join(rng.choice("aabc") for _ in range(rng.randrange(6, 10))) for _ in range(500)})
    heads = spelling.gram_dictionary(spark.createDataFrame([(w, 5) for w in words], "word string, n long"), 30)
    places = sum(len(w) - 1 for w in words)
    for size in (2, 3):
        counts = Counter(w[i:i + size] for w in words for i in range(len(w) - size + 1))
        assert {h for h in heads if len(h) == size} == {g for g, n in counts.items() if n * 30 > places}
    for w in words:
        cut = spelling.chosen_cut(w, heads)
        assert 2 <= cut <= len(w) - 2 and ("l", cut) in spelling.lists_of(w, heads)
        # What is read left of the cut is the same whatever follows it.
        for _ in range(5):
            other = w[:cut] + "".join(rng.choice("abc") for _ in range(len(w) - cut + rng.choice([-1, 0, 1])))
            if len(other) >= 6:
                assert cut in spelling.cuts_of(other, heads)
