"""The whole pipeline against plain-Python versions of its stages, and the registered queries."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from newsloom.llm import packing, pii, queries, toxicity
from tests.llm.test_llm_methods import plain_fingerprint, plain_roots, plain_spans, plain_targets, prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Toxic texts, exact and near copies, personal data, and a hot source."""
    rnd, at = random.Random(11), str(tmp_path_factory.mktemp("corpus"))
    rows, labels = [], []
    for i in range(420):
        words = prose(rnd, rnd.randrange(30, 200), 3000).split()
        if i % 6 == 0:
            words[5:5] = rnd.sample(["vile", "scum", "filth", "rotter", "wretch"], 4)
        if i % 9 == 1:
            words[9:9] = ["mail", f"a{i}@b.example", "or", "+1 (269) 555-3296"]
        rows.append((i, " ".join(words), "en", rnd.choice(["hot"] * 3 + ["b", "c"]), 0))
        labels.append((i, 1, int(i % 6 == 0)))
    for i in range(60):
        j = rnd.choice([k for k in range(420) if k % 6])
        rows.append((1000 + i, rows[j][1] + (" more" if i % 2 else ""), "en", "hot", 0))
    rows = [(i, t, lang, s, len(t)) for i, t, lang, s, _ in rows]
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_stages_and_run(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    out, docs = {}, given
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        out[name] = result.collect()
        docs = spark.createDataFrame(out[name], result.schema)
    rows = {r.doc_id: r for r in given.collect()}

    scorer = toxicity.fit_labels(given, spark.read.parquet(f"{folder}/labels.parquet")).scorer()
    clean = {i for i, r in rows.items() if scorer.probability(scorer.evidence(r.text)[0]) < toxicity.THRESHOLD}
    assert {r.doc_id for r in out["toxicity"]} == clean
    assert {i for i in rows if i % 6 or i >= 1000} <= clean and len([i for i in clean if i < 420 and i % 6 == 0]) < 5

    signed = {i: plain_fingerprint(rows[i].text) - (1 << 64 if plain_fingerprint(rows[i].text) >> 63 else 0) for i in clean}
    roots, groups = plain_roots(sorted(set(signed.values()))), defaultdict(list)
    for i, v in signed.items():
        groups[roots.get(v, v)].append(i)
    assert sorted(r.doc_id for r in out["near_duplicates"]) == sorted(min(g) for g in groups.values())

    for r in out["personal_data"]:
        text, cut = rows[r.doc_id].text, 0
        masked = ""
        for start, end, kind in sorted((s, e, k) for k, s, e in plain_spans(text)):
            if start >= cut:
                masked += text[cut:start] + f"[{kind.upper()}]"
            cut = max(cut, end)
        assert (r.text, r.n_chars) == (masked + text[cut:], len(masked + text[cut:]))
    assert len(out["personal_data"]) == len(out["near_duplicates"])

    size = lambda r: len(r.text.split())
    totals, taken, copies = Counter(), Counter(), Counter(r.doc_id for r in out["mixing"])
    for r in out["personal_data"]:
        totals[r.source] += size(r)
        taken[r.source] += size(r) * copies[r.doc_id]
    assert all(abs(taken[s] - t) < 200 for s, t in plain_targets(totals).items()) and max(copies.values()) <= 3

    tokens, bins = Counter(), defaultdict(list)
    for r in out["packing"]:
        tokens[r.doc_id] += r.n_tokens
        bins[r.bin].append(r)
    assert tokens == Counter({r.doc_id: copies[r.doc_id] * (size(r) + 1) for r in out["personal_data"] if copies[r.doc_id]})
    for b in bins.values():
        assert sum(r.n_tokens for r in b) <= packing.CAPACITY
        assert len({rows[r.doc_id].source for r in b}) == len(b) == len({r.doc_id for r in b})

    whole = corpus_pipeline.run(spark, folder)
    key = lambda r: (r.doc_id, r.piece, r.n_tokens)
    assert sorted(map(key, whole.collect())) == sorted(map(key, out["packing"]))


def test_registered_queries():
    names = entry_point.queries()
    assert {f"op{n}" for n in range(1, 11)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(queries.REGISTRY) <= set(names)


def test_contract_columns(spark, folder, tmp_path):
    """Query 1, 4 and 10 on the small corpus."""
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in entry_point.queries()["op1_pii"](spark, folder).collect():
        want = list(plain_spans(rows[r.doc_id]))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in want) for kind in pii.KINDS]
    for r in entry_point.queries()["op4_toxicity"](spark, folder).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7)
    for r in entry_point.queries()["op10_simhash"](spark, folder).collect():
        assert r.fingerprint == f"{plain_fingerprint(rows[r.doc_id]):016x}"
