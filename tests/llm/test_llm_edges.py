"""Every operator and stage on odd rows: nulls, empty and long texts, repeated rows, an empty table, columns of all kinds of names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm import chunks, mixing, packing, pii, sharding, simhash, suffixes, tokens, toxicity, vectors

EXTRA = "fp long, part int, rank int, spans string, size int, level int, score double, row string, key string, label int, slot int, shard string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
NOTHING = (None,) * 12
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(40_000))
ROWS = [
    (None, None, None, None, None, *NOTHING),
    (None, "mail a.b@c.example now", None, None, 3, *NOTHING),
    (1, "", "en", "a", 0, 1, 1, 1, "s", 1, 1, 0.5, "r", "k", 1, 1, "x"),
    (1, "", "en", "a", 0, 1, 1, 1, "s", 1, 1, 0.5, "r", "k", 1, 1, "x"),
    (2, LONG, "en", "a", len(LONG), *NOTHING),
    (2, LONG, "en", "a", len(LONG), *NOTHING),
    (3, LONG + " and one more", "en", "b", 9, *NOTHING),
    (4, " \t\n\r ", "en", "", 5, *NOTHING),
    (5, "é😀 ünï 10.0.0.1, 999.1.1.1 +1 (269) 555-3296 4111 1111 1111 1111", "fr", None, 60, *NOTHING),
    (6, "x" * 100_000, "fr", "b", 100_000, *NOTHING),
]
LABELS = "doc_id long, toxic int, quality int, text string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(2, 1, None, "t"), (2, 1, None, "t"), (3, 0, 1, "t"), (4, None, 0, None), (None, 1, 1, None)], LABELS)


def operators():
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return {
        "pii": lambda d: pii.with_spans(d, pii.fit(d)),
        "mixing": mixing.taken,
        "mixed": mixing.mixed,
        "packing": packing.pack_documents,
        "sharding": lambda d: sharding.placed(d, F.col("doc_id")),
        "tokens": lambda d: tokens.round_trip(d, tokenizer),
        "suffixes": suffixes.repeated,
        "chunks": chunks.fingerprinted,
        "simhash": simhash.near_duplicates,
        "keep_first": simhash.keep_first,
    }


@pytest.mark.parametrize("name", list(operators()))
def test_empty_table(none, name):
    assert operators()[name](none).collect() == []


@pytest.mark.parametrize("name", ["pii", "mixing", "sharding", "tokens", "chunks", "simhash"])
def test_each_row_gets_a_row(odd, name):
    out = operators()[name](odd)
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r[0] for r in ROWS), key=str)


def test_toxicity(spark, odd, none, labels):
    for docs, marks in ((odd, labels), (none, labels), (odd, labels.limit(0)), (none, labels.limit(0))):
        model = toxicity.fit_labels(docs, marks)
        rows = docs.select("doc_id", toxicity.scores("text", model).alias("t")).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r.t.score < toxicity.THRESHOLD for r in rows)


def test_packing_keeps_every_word(odd):
    rows = packing.pack_documents(odd, 64).collect()
    sums = {}
    for r in rows:
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.n_tokens
    words = {}
    for r in ROWS:
        words[r[0]] = words.get(r[0], 0) + len((r[1] or "").encode().split()) + 1
    assert sums == words


def test_suffixes_leave_out_null_ids_and_join_equal_ones(odd):
    found = {r.doc_id: [tuple(p) for p in r.passages] for r in suffixes.repeated(odd).collect()}
    assert found == {2: [(0, 40_000)], 3: [(0, 40_000)]}


def test_vectors(spark):
    schema = "id long, vec array<float>, label int, score double"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1, None), (0, [1.0, 0.0], 1, None), (1, [2.0, 0.0], 1, None), (2, [1.0, 0.0], 1, None), (3, [0.0, 1.0], None, None),
            (4, None, 1, None), (5, [0.0, 0.0], 1, None), (6, [1.0, None], 1, None), (7, [1.0, nan], 1, None), (8, [inf, 1.0], 1, None),
            (9, [1.0, 0.0, 0.0], 1, None), (10, [], 1, None), (None, [1.0, 0.0], 1, None), (50, [1.0, -1.0], 1, None), (100, None, 1, None)]
    table = spark.createDataFrame(rows, schema)
    found = [tuple(r) for r in vectors.nearest_of_every(table).orderBy("query_id", "rank").collect()]
    assert [(q, r, v) for q, r, v, _ in found] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 3), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 3)]
    assert [round(s, 12) for *_, s in found[:4]] == [1.0, 1.0, round(2 ** -0.5, 12), 0.0]
    assert vectors.nearest_of_every(table.limit(0)).collect() == []


def test_stages(spark, odd, none, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for given in (odd, none):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.dtypes == docs.dtypes
            rows = out.collect()
            docs = spark.createDataFrame(rows, out.schema)
            assert bool(rows) == (given is odd)
    assert rows == []


def test_masking_keeps_rows_and_counts_characters(spark, odd, tmp_path):
    rows = corpus_pipeline.mask_personal_data(spark, odd, str(tmp_path)).collect()
    assert len(rows) == len(ROWS)
    by_text = {r.doc_id: r for r in rows if r.doc_id in (5,)}
    # The numbers run into each other, so the base rules take neither.
    assert by_text[5].text == "é😀 ünï [IP], 999.1.1.1 +1 (269) 555-3296 4111 1111 1111 1111"
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert [r.n_chars for r in rows if r.text is None] == [None]
