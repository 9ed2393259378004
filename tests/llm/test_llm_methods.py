"""The operators against plain-Python versions on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.llm import chunks, components, mixing, packing, pii, sharding, simhash, suffixes, tokens, toxicity, vectors

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def prose(rnd, n, size=400):
    return " ".join(f"w{rnd.randrange(size)}" for _ in range(n))


# 1 ----------------------------------------------------------------------------------------------------------------------

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                yield kind, m.start(), m.end()


def test_base_spans(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(a) for _ in range(rnd.randrange(80))) for a in ("ab0123456789.@+- ()_%é\n😀", "0123456789 -", "0123456789.", "ab.@_-%")
             for _ in range(400)]
    texts += ["a@b.c_d@e.f", "a@b.c.@x.y", "1.2.3.4.5.6.7.8", "256.1.1.1", "000255.0.0.1", "4111 1111 1111 1111 " * 300, "a@" + "b." * 4000 + "c", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)
    kept = pii.with_spans(docs, pii.Trees(0.0))
    got = {r.i: [(pii.KINDS[s.kind], s.start, s.end) for s in r.spans] for r in kept.collect()}
    assert all(got[i] == sorted(plain_spans(t), key=lambda s: (pii.KINDS.index(s[0]), s[1])) for i, t in enumerate(texts))


def test_long_texts_take_no_stack_and_no_square_of_time(spark):
    texts = ["a" * 400_000, "1" * 400_000, "a@" + "b." * 200_000 + "c", "+1 " * 100_000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert pii.with_spans(docs, pii.Trees(0.0)).count() == 4


def test_trees_learn_format_and_context(spark):
    """Cards with a wrong last digit after a cue are added, bare numbers are not."""
    rnd = random.Random(2)

    def number(good):
        digits = [rnd.randrange(10) for _ in range(15)]
        digits += [next(d for d in range(10) if luhn("".join(map(str, [*digits, d]))) == good)]
        return "".join(map(str, digits))

    rows = [(i, f"pay by card: {number(True)} ok") for i in range(300)]
    rows += [(1000 + i, f"part no {number(False)} of the list") for i in range(300)]
    rows += [(2000 + i, f"pay by card: {number(False)} ok") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trees = pii.fit(docs)
    out = {r.doc_id: r.spans for r in pii.with_spans(docs, trees).collect()}
    assert all(len(out[i]) == 1 and out[i][0].base for i in range(300))
    assert not any(out[1000 + i] for i in range(300))
    assert all(s.end - s.start == 16 for i in range(2000, 2005) for s in out[i])


def test_loose_spans_are_found_whatever_the_number_of_base_spans(spark):
    """More planted loose spans than confirmed ones, in two kinds no confirmed one at all; runs that only look alike stay."""
    rnd = random.Random(8)
    planted = ["jane.doe at example dot com", "bob_smith [at] mail [dot] org", "(336) 555-3810", "001 336 555 3810", "9[.]122[.]68[.]47",
               "4111.1111.1111.1111"]
    alike = ["at noon.Then", "2024-03-17 0915", "100 200 300 400", "978-3-16-148410-0", "9177399536541148", "0919255729746466"]
    plain = lambda: " ".join("".join(rnd.choice("aeionrst") for _ in range(rnd.randrange(3, 9))) for _ in range(9))
    rows = [(i, f"{plain()} {(planted + alike)[i % 12]} {plain()}") for i in range(600)]
    rows += [(1000 + i, f"{plain()} a{i}.b@mail{i}.com or +1 (269) 555-{3200 + i} {plain()}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.with_spans(docs, pii.fit(docs)).filter("doc_id < 1000").collect():
        assert [r.text[s.start:s.end] for s in r.spans] == planted[r.doc_id % 12:][:1], r.text


def test_trees_learn_from_every_document(spark, monkeypatch):
    """A thousand rare spans among 24,000 texts; all of them and no share of them are counted."""
    docs = spark.range(24_000).repartition(4).selectExpr("id AS doc_id", "IF(id % 24 = 0, concat('the house ', id, 'x mail a', id, '.b@mail.com so'), 'the house by water') AS text")
    tables = []
    monkeypatch.setattr(pii, "boost", lambda table, *held: tables.append(table) or pii.Trees(0.0))
    pii.fit(docs)
    pii.fit(docs.limit(0))
    emails = [sum(yes for cell, yes, _ in table if cell[0] == 0) for table in tables]
    assert emails[0] - emails[1] == 1000


def test_tree_column_equals_tree(spark):
    trees = pii.boost([((k, a, b, 0, 0, 0, c, 0, 0, 0), a + 3 * c, b + 1) for k in range(4) for a in range(5) for b in range(4) for c in range(2)])
    cells = [(k, a, b, 0, 0, 0, c, 0, 0, 0) for k in range(4) for a in range(5) for b in range(4) for c in range(2)]
    rows = spark.createDataFrame([(list(c),) for c in cells], "f array<int>").select("f", trees.column(F.col("f")).alias("s")).collect()
    assert all(abs(r.s - trees.score(tuple(r.f))) < 1e-9 for r in rows)


def test_redact(spark):
    rows = spark.createDataFrame([("a b@c.de x +1 (269) 555-3296",)], "text string")
    out = pii.with_spans(rows, pii.Trees(0.0)).select(pii.redact(F.col("text"), F.col("spans")))
    assert out.first()[0] == "a [EMAIL] x [PHONE]"


# 2 ----------------------------------------------------------------------------------------------------------------------

def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped, out = sum(sizes.values()), set(), {}
    while True:
        rest = [s for s in names if s not in capped]
        left, all_weights = total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in rest)
        out = {s: 3.0 * sizes[s] if s in capped else left * weight[s] / all_weights for s in names}
        above = {s for s in rest if out[s] > 3 * sizes[s]}
        if not above:
            return out
        capped |= above


def test_mix_meets_targets(spark):
    rnd = random.Random(7)
    rows = [(i, prose(rnd, rnd.randrange(0, 60)), rnd.choice(["hot"] * 12 + ["b", "c", "d", "e", "É", None])) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = mixing.taken(docs).collect()
    assert sorted((r.doc_id, r.size) for r in out) == sorted((i, len(t.split())) for i, t, _ in rows)
    source = {i: s for i, _, s in rows}
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    want = plain_targets(sizes)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    again = {r.doc_id: r.taken for r in mixing.taken(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in out}
    copies = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert copies == Counter({r.doc_id: r.copies for r in out if r.copies})


def test_importance_makes_unequal_copies(spark):
    rows = [(i, "a b c d", s, 4.0 if i % 2 else 1.0) for i, s in ((i, "x" if i < 1000 else "y") for i in range(2000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, worth double")
    out = mixing.taken(docs, F.col("worth")).collect()
    mean = {(odd, y): np.mean([r.copies for r in out if r.doc_id % 2 == odd and (r.doc_id >= 1000) == y]) for odd in (0, 1) for y in (False, True)}
    assert 3 < mean[1, True] / mean[0, True] < 5.5 and max(r.copies for r in out) <= 3
    assert abs(sum(r.taken for r in out if r.doc_id >= 1000) - out[0].source_size * 2 * 2 / 7) < 20


# 3 ----------------------------------------------------------------------------------------------------------------------

def plain_best_fit(lengths, sources, clusters, capacity):
    bins = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(capacity - sum(lengths[j] for j in b), n) for n, b in enumerate(bins) if capacity - sum(lengths[j] for j in b) >= lengths[i]
                and not any(sources[j] & sources[i] or clusters[j] & clusters[i] for j in b)]
        if fits:
            bins[min(fits)[1]].append(i)
        else:
            bins.append([i])
    return {i: n for n, b in enumerate(bins) for i in b}


def test_best_fit_finds_the_tightest_compatible_bin():
    rnd = random.Random(4)
    for _ in range(60):
        n = rnd.randrange(1, 60)
        lengths = [rnd.randrange(1, 40) for _ in range(n)]
        sources, clusters = [1 << rnd.randrange(6) for _ in range(n)], [rnd.choice([0, 1 << rnd.randrange(9)]) for _ in range(n)]
        bins, offsets = packing.best_fit(lengths, sources, clusters, 40)
        assert dict(enumerate(bins)) == plain_best_fit(lengths, sources, clusters, 40)
        for b in set(bins):
            own = sorted((offsets[i], lengths[i]) for i in range(n) if bins[i] == b)
            assert own[0][0] == 0 and all(a + x == c for (a, x), (c, _) in zip(own, own[1:]))


def test_no_conflict_and_no_loss(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([3, 10, 90, 130, 300]), rnd.choice(["a"] * 3 + ["b", "c", "d", None]), rnd.choice([7] * 3 + list(range(40)))) for i in range(1200)]
    items = spark.createDataFrame(rows, "doc_id long, n long, source string, cluster long")
    out = packing.packed(items, 128, 64).collect()
    of = {r[0]: r for r in rows}
    held, pieces = defaultdict(list), defaultdict(list)
    for r in out:
        held[r.bin].append(r)
        pieces[r.doc_id].append(r)
    for b in held.values():
        assert sum(r.n_tokens for r in b) <= 128
        for column in (2, 3):
            values = [of[r.doc_id][column] for r in b if of[r.doc_id][column] is not None]
            assert len(values) == len(set(values))
    for i, n, *_ in rows:
        own = sorted((r.start, r.n_tokens) for r in pieces[i])
        assert sum(k for _, k in own) == n and [s for s, _ in own] == [128 * k for k in range(len(own))]


# 4 ----------------------------------------------------------------------------------------------------------------------

def plain_segments(values):
    """All maximal segments by the recursive definition: the best segment, then the same left and right of it."""
    def walk(low, high):
        best = max(((sum(values[a:b]), a - b, a, b) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0,))
        if best[0] <= 0:
            return []
        _, _, a, b = max((s, n, -a, b) for s, n, a, b in [(sum(values[a:b]), a - b, a, b) for a in range(low, high) for b in range(a + 1, high + 1)] if s == best[0])
        a = -a
        return [*walk(low, a), (a, b), *walk(b, high)]
    return walk(0, len(values))


def test_all_maximal_segments():
    rnd = random.Random(9)
    for _ in range(200):
        values = np.array([rnd.choice([-3.1, -1.3, -0.37, 0.71, 1.9, 4.3]) + rnd.random() / 1e3 for _ in range(rnd.randrange(0, 14))])
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(values)] == plain_segments(values.tolist())


def test_every_passage_of_a_long_text_counts():
    scorer = toxicity.Model({w: 4.0 for w in ("vile", "scum", "filth", "rotter")}, 1.0, 0.1, 1.0, 0.0, 0.1).scorer()
    dense, gap = ["vile", "scum", "filth", "rotter"], [f"w{i}" for i in range(3000)]
    once, _ = scorer.evidence(" ".join(dense + gap + gap))
    both, found = scorer.evidence(" ".join(dense + gap + dense + gap))
    assert [(a, b) for a, b, _ in found] == [(0, 4), (3004, 3008)] and both > 1.9 * once > 0
    # Mentions far apart, each below significance, do not use up the words of a later passage.
    scattered = [w for word in dense for w in [word, *gap[:600]]]
    assert not scorer.evidence(" ".join(scattered))[1]
    assert [(a, b) for a, b, _ in scorer.evidence(" ".join(scattered + dense + gap))[1]] == [(len(scattered), len(scattered) + 4)]
    # One word over and over is one mention, however near or far the repeats.
    for step in (1, 5, 26, 27, 40):
        values = scorer.values(" ".join((["vile"] + gap[:step - 1]) * 200))
        assert max(s for _, _, s in toxicity.maximal_segments(values)) < 4


def test_held_out_accuracy(spark):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = prose(rnd, rnd.randrange(20, 300), 3000).split()
        toxic = i % 6 == 0
        if toxic:
            at = rnd.randrange(len(words))
            words[at:at] = rnd.sample(["vile", "scum", "filth", "rotter", "swinehunt", "swinefest"], 4)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_labels(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = docs.select("doc_id", toxicity.held_out("doc_id").alias("held"), toxicity.scores("text", model).alias("t")).collect()
    for r in out:
        assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in out if r.held]
    assert np.mean([(r.t.score >= 0.7) == (r.doc_id % 6 == 0) for r in held]) > 0.98
    # The passage found is where the words were put.
    text = dict(rows)
    found = [" ".join(text[r.doc_id].split()[p.start:p.end]) for r in held if r.doc_id % 6 == 0 for p in r.t.passages]
    assert found and all(re.search("vile|scum|filth|rotter|swine", f) for f in found)


@pytest.mark.parametrize("size, every", [(200, 6), (420, 6), (900, 2), (5000, 12)])
def test_label_sets_of_all_sizes_teach_the_same(spark, size, every):
    """Five words mark every toxic text: they are learned from few labels as from many."""
    rnd = random.Random(size)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rnd.choices(words, k=60) + (["vile", "scum", "filth", "rot", "swine"] if i % every == 0 else []))) for i in range(size)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_labels(docs, spark.createDataFrame([(i, int(i % every == 0)) for i in range(size)], "doc_id long, toxic int"))
    score = {r.doc_id: r.t.score for r in docs.select("doc_id", toxicity.scores("text", model).alias("t")).collect()}
    assert {"vile", "scum", "filth", "rot", "swine"} <= set(model.scores)
    caught = [score[i] >= toxicity.THRESHOLD for i in range(0, size, every)]
    false = [score[i] >= toxicity.THRESHOLD for i in range(size) if i % every]
    assert np.mean(caught) >= 0.9 and np.mean(false) < 0.01


def test_too_few_labels_to_hold_out_are_told(spark, monkeypatch):
    """Entries from all rows together, but none without any fold's share."""
    monkeypatch.setattr(toxicity, "log_odds", lambda rows: [{}] * toxicity.FOLDS + [{"vile": 4.0, "scum": 4.0}])
    rows = [(i, "plain words of a text " + ("vile scum" if i < 12 else "and more"), int(i < 12)) for i in range(60)]
    with pytest.warns(UserWarning, match="too few labelled rows"):
        model = toxicity.fit(spark.createDataFrame(rows, "key long, text string, label int"))
    scorer = model.scorer()
    assert all((scorer.probability(scorer.evidence(t)[0]) >= toxicity.THRESHOLD) == bool(label) for _, t, label in rows)


def test_held_out_labels_are_not_read(spark):
    rows = [(i, "good words here" if i % 2 else "bad words there") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    models = [toxicity.fit_labels(docs, spark.createDataFrame([(i, i % 2 if i not in held else flip) for i, _ in rows], "doc_id long, toxic int")) for flip in (0, 1)]
    assert models[0] == models[1]


# 5 ----------------------------------------------------------------------------------------------------------------------

def test_table_by_the_plain_rule():
    names, slots = ("c", "a", "b"), 101
    orders = {n: [(sharding._number(n, "offset") + j * (sharding._number(n, "skip") % (slots - 1) + 1)) % slots for j in range(slots)] for n in names}
    owner = {}
    while len(owner) < slots:
        for n in sorted(names):
            if len(owner) < slots:
                owner[next(s for s in orders[n] if s not in owner)] = n
    assert [names[i] for i in sharding.table(names, slots)] == [owner[s] for s in range(slots)]


def test_balance_and_small_moves():
    before, after = sharding.table(sharding.SHARDS), sharding.table(sharding.SHARDS[:-1])
    sizes = Counter(before)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    gone = len(sharding.SHARDS) - 1
    moved = sum(a != b for a, b in zip(before, after) if a != gone)
    assert moved < 0.1 * len(before)
    with pytest.raises(ValueError):
        sharding.table(("a", "b"), 100)


def test_placement(spark, tmp_path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"))
    owner = sharding.table(sharding.SHARDS)
    for r in sharding.placed(docs, F.col("doc_id")).collect():
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, sharding.SHARDS[owner[slot]])
    sharding.write_shards(docs, F.col("doc_id"), str(tmp_path / "s"), ("p", "q"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 2


# 6 ----------------------------------------------------------------------------------------------------------------------

def test_words_tokenize_alike_alone_and_together():
    rnd = random.Random(1)
    whole = Tokenizer.from_file(TOKENIZER)
    encoder = tokens.Encoder(open(TOKENIZER, encoding="utf-8").read(), "<u4")
    texts = ["".join(rnd.choice(" \n\t 　ab.,!é²1'́s\x1c<|endoftext|>)") for _ in range(rnd.randrange(30))) for _ in range(6000)]
    texts += [" a", " ", "", "a  b", "a\n", "\n\na", "x" * 500 + " y.", "it's, don't! 12.5, a.b.", "<|endoftext|> hi", "中文 字。 ok"]
    texts += ["\x02a b", "a \x03", "\x01"]
    for low in range(0, len(texts), 500):
        own = texts[low:low + 500]
        ids, sizes = encoder.encode(pa.array(own))
        for text, end, size in zip(own, np.cumsum(sizes), sizes):
            assert ids[end - size:end].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0], repr(text)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000, 200_000])
def test_coder_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 5000).astype(np.int64)
    coder = tokens.Coder(tokens.frequencies(Counter(ids.tolist())))
    data = tokens.pack(coder, 1, 2, 30, [4, None], [n, 0], ids)
    block = tokens.unpack(data, coder.mark)
    assert (block["docs"], block["start"], block["sizes"].tolist()) == ([4, None], 30, [n, 0])
    assert (tokens.block_ids(coder, block) == ids).all()
    for first, count in ((0, 10), (n // 2, 100), (max(0, n - 3), 99)):
        assert (tokens.block_ids(coder, block, first, count) == ids[first:first + count]).all()
    assert n < 200_000 or len(block["marks"]) > 0
    with pytest.raises(ValueError):
        tokens.unpack(data[:-9] + bytes([data[-9] ^ 1]) + data[-8:])


def test_frequencies_add_up():
    table = tokens.frequencies({i: 1 for i in range(50_000)} | {3: 10 ** 12})
    assert table.sum() == 1 << tokens.SCALE and table.min() == 1


def test_file_holds_all_documents(spark):
    rnd = random.Random(8)
    rows = [(i * 3 % 601, prose(rnd, rnd.randrange(40)) + "\n" + prose(rnd, 3)) for i in range(601)]
    out = tokens.round_trip(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), TOKENIZER).collect()
    whole, start = Tokenizer.from_file(TOKENIZER), 0
    got = {r.doc_id: r for r in out}
    for i, text in sorted(rows):
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 0], dtype="<u4").tobytes()
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32, bytes(got[i].ids)) == (start, len(ids) // 4, zlib.crc32(ids), ids)
        start += len(ids) // 4


# 7 ----------------------------------------------------------------------------------------------------------------------

def plain_repeats(rows, size=suffixes.PASSAGE):
    owners = defaultdict(set)
    for i, text in rows:
        words = text.split()
        for s in range(len(words) - size + 1):
            owners[tuple(words[s:s + size])].add(i)
    out = {}
    for i, text in rows:
        words, spans = text.split(), []
        for s in range(len(words) - size + 1):
            if len(owners[tuple(words[s:s + size])]) > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + size
                else:
                    spans.append([s, s + size])
        if spans:
            out[i] = [tuple(s) for s in spans]
    return out


def test_repeats_by_brute_force(spark):
    rnd = random.Random(6)
    shared = [prose(rnd, n, 10 ** 6) for n in (49, 50, 51, 60, 75, 120, 300)]
    rows = []
    for i in range(160):
        parts = [prose(rnd, rnd.randrange(0, 90), 10 ** 6) for _ in range(3)]
        for _ in range(rnd.randrange(3)):
            words = rnd.choice(shared).split()
            low = rnd.choice([0, 0, rnd.randrange(len(words))])
            parts.insert(rnd.randrange(4), " ".join(words[low:]))
        rows.append((i, " \n".join(parts)))
    rows += [(200, shared[5]), (201, shared[5]), (202, "a b " * 90), (203, "b a " * 70), (204, prose(rnd, 90, 10 ** 6) * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: [tuple(p) for p in r.passages] for r in suffixes.repeated(docs).collect()}
    assert got == plain_repeats(rows)
    assert 204 not in got and 202 in got


def test_neighbours_across_tasks():
    """A run of equal suffixes cut between tasks loses nothing: what stands at a cut is handed on to be extended."""
    walk = suffixes.Neighbours()
    for row in [(1, 5, (1, 0, 0)), (1, 6, (2, 0, 0)), (2, 7, (3, 0, 0)), (3, 8, (4, 0, 0)), (3, 8, (5, 0, 0)), (4, 9, (6, 0, 0))]:
        walk.add(*row)
    walk.finish()
    assert walk.whole == [(4, 0, 0), (5, 0, 0)]
    assert walk.open == [(1, 0, 0), (2, 0, 0), (6, 0, 0)]
    walk = suffixes.Neighbours()
    for row in [(0, 0, (9, 0, 0)), *((3, 8, (i, 0, 0)) for i in (4, 4, 5, 6)), (3, 9, (4, 7, 7)), (5, 0, (9, 9, 9))]:
        walk.add(*row)
    assert walk.open[1:] == [(4, 0, 0), (5, 0, 0), (4, 7, 7)] and len(walk.whole) == 4


# 8 ----------------------------------------------------------------------------------------------------------------------

def test_gear_hash_depends_on_32_bytes():
    data = bytes(random.Random(3).randrange(256) for _ in range(500))
    want, value = [], 0
    for b in data:
        value = ((value << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        want.append(value)
    assert chunks.gear_hashes(data).tolist() == want


def test_chunks_cover_the_text_and_resist_shifts(monkeypatch):
    rnd = random.Random(2)
    data = prose(rnd, 3000).encode()
    parts = chunks.chunks(data)
    assert b"".join(parts) == data and all(chunks.LEAST <= len(p) <= chunks.MOST for p in parts[:-1])
    shifted = chunks.fingerprint("some words before " + data.decode())
    assert chunks.containment(chunks.fingerprint(data.decode()), shifted) > 0.98
    monkeypatch.setattr(chunks, "PART", 1000)
    assert chunks.chunks(data) == parts
    assert chunks.chunks(b"") == [] and b"".join(chunks.chunks(b"z" * 5000)) == b"z" * 5000


def test_edited_texts(spark):
    rnd = random.Random(2)
    rows = [(i, prose(rnd, rnd.randrange(0, 200))) for i in range(120)] + [(500, "😀é" * 7), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ordered = sorted(rows, reverse=True)
    want = {i: chunks.edited(t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered)}
    texts = dict(rows)
    for parts in (7, 1000):
        out = chunks.with_next(docs, parts).mapInPandas(chunks._fingerprinted, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                                        "edited_fingerprint string, near_edited double, near_next double").collect()
        assert len(out) == len(rows)
        for r in out:
            own, other = chunks.fingerprint(texts[r.doc_id]), chunks.fingerprint(want[r.doc_id])
            assert (r.n_chars, r.edited_sha256) == (len(texts[r.doc_id]), hashlib.sha256(want[r.doc_id].encode()).hexdigest())
            assert (r.fingerprint, r.edited_fingerprint, r.near_edited) == (chunks.written(own), chunks.written(other), chunks.containment(own, other))
    assert np.mean([r.near_edited for r in out if r.n_chars > 400]) == pytest.approx(0.5, abs=0.1)
    assert np.mean([r.near_next for r in out if r.n_chars > 400]) < 0.1


# 9 ----------------------------------------------------------------------------------------------------------------------

def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 24))
    data = (centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 24))).astype(np.float32)
    data[100:400] = data[100]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, vec array<float>").repartition(4)
    asked = table.filter("id % 20 = 0")
    got = defaultdict(dict)
    for r in vectors.nearest(table, asked, shard=700).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    exact = data.astype(np.float64)
    hits = 0
    for q in range(0, 3000, 20):
        scores = vectors.cosines(exact, exact[q])
        order = [i for i in np.lexsort((np.arange(3000), -scores)) if i != q][:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        hits += len({v for v, _ in got[q].values()} & set(map(int, order)))
        assert all(abs(s - scores[v]) < 1e-12 for v, s in got[q].values())
    assert hits / (150 * 5) >= 0.9
    assert [v for v, _ in (got[200][k] for k in range(1, 6))] == [100, 101, 102, 103, 104]


# 10 ---------------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles)) if shingles else 0


def test_fingerprint():
    rnd = random.Random(1)
    for text in [None, "", " \n", "A", "ÀB cd", "a b c", "a b c d", *(prose(rnd, n, 50) for n in (5, 60, 200))]:
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text or "")


def plain_roots(values):
    root = {v: v for v in values}
    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values if find(v) != v}


@pytest.mark.parametrize("limit,step", [(4_000_000, 12), (5000, 12), (3000, 16)])
def test_links_at_any_bucket_size(spark, limit, step):
    rnd = random.Random(step)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    values = {signed(rnd.getrandbits(64)) for _ in range(40)}
    for v in list(values)[:20]:
        for _ in range(6):
            w = v & (1 << 64) - 1
            for b in rnd.sample(range(64), rnd.randrange(1, 6)):
                w ^= 1 << b
            values.add(signed(w))
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.root for r in components.components(simhash.links(frame, limit, step)).collect()}
    assert got == plain_roots(sorted(values))


def test_components_of_chains_and_stars(spark):
    links = [(i + 1, i) for i in range(60)] + [(100 + i, 100) for i in range(1, 300)] + [(400, 399), (399, 100)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "node long, root long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in (*range(101, 401),)}}


def test_near_duplicates_and_first(spark):
    rnd = random.Random(3)
    base = [prose(rnd, 300) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, base[i]) for i in range(5)] + [(200 + i, base[i] + " tail") for i in range(8)] + [(300, ""), (301, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    prints = {i: simhash.fingerprint(t) for i, t in rows}
    roots = plain_roots(sorted(set(prints.values())))
    of = defaultdict(list)
    for i, v in prints.items():
        of[roots.get(v, v)].append(i)
    want = {i: min(own) for own in of.values() for i in own}
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == want
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect()) == sorted(set(want.values()))
