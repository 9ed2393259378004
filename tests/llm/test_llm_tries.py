"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from newsloom.llm import tries


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, children = {}, {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
            if d:
                children.setdefault(path[:d - 1], set()).add(path[:d])
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in children.get(node, ())]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, ())), *totals[n],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if whole[c] == n).encode()).hexdigest()) for n, m in members.items()), key=repr)


def talks(seed, n=600):
    rng = random.Random(seed)
    openings = [("user", rng.choice(["hé", "hello", "", "😀 x"]) * rng.randrange(4)) for _ in range(6)]
    rows = []
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.randrange(1, 9)):
            role, text = rng.choice(openings[:3]) if rng.random() < .8 else (rng.choice(["user", "assistant"]), str(rng.randrange(30)) * rng.randrange(3))
            rows.append((c, 10 * t, role, text))
        if c % 3 == 0:  # a third are copies
            rows = [r for r in rows if r[0] != c] + [(c, t, "user", "same") for t in range(5)]
    return rows


def listed(frame):
    return sorted([tuple(r) for r in frame.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()], key=repr)


@pytest.mark.parametrize("shard", [tries.SHARD, 400, 60])
def test_against_all_prefixes(spark, monkeypatch, shard):
    """Small shards make several levels of spines."""
    monkeypatch.setattr(tries, "SHARD", shard)
    rows = talks(shard)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert listed(tries.prefix_trie(frame)) == plain(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(tries, "SHARD", 50)
    rows = [(None, 1, "user", "x"), (0, None, None, None), (0, 2, "user", None), (0, 1, None, "b"), (7, 1, "user", "x" * 100_000), (7, 1, "user", "x" * 100_000),
            (300, 0, "a", "b"), (1200 + 55, 0, "only", "one")] + [(9, t, "user", f"t{t % 3}") for t in range(2000)] + [(8, t, "user", f"t{t % 3}") for t in range(2000)]
    frame = spark.createDataFrame([(*r, 3, "p") for r in rows], "conv_id long, turn long, role string, text string, shard long, path string")
    assert listed(tries.prefix_trie(frame)) == plain(rows)
    assert tries.prefix_trie(frame.limit(0)).collect() == []


def test_closes_against_a_stack():
    rng = random.Random(5)
    for size in (1, 2, 40, 700, 3000):
        bits, depth, opened = [1], 1, 1
        while depth:
            if opened < size and rng.random() < .52:
                bits, depth, opened = bits + [1], depth + 1, opened + 1
            elif depth > 1 or opened == size:
                bits, depth = bits + [0], depth - 1
        stack, want = [], {}
        for i, bit in enumerate(bits):
            if bit:
                stack.append(i)
            else:
                want[stack.pop()] = i
        assert tries.excess_closes(np.array(bits, dtype=np.int8)).tolist() == [want[i] for i in sorted(want)]
