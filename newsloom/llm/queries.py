"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import automata, chunks, mixing, packing, pii, sharding, simhash, spelling, suffixes, tokens, toxicity, tries, vectors


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    trees = pii.fit(docs)
    found = pii.with_spans(docs, trees)
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == i)).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(_table(spark, folder, "documents")).drop("copies")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sharding.placed(docs, F.col("doc_id")).select("doc_id", "slot", "shard", "n_bytes")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity.fit_labels(docs, _table(spark, folder, "labels"))
    rated = docs.select("doc_id", toxicity.scores("text", model).alias("found"))
    score = F.col("found.score")
    return rated.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), score.alias("score"),
                        (score >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                        F.size("found.passages").alias("n_passages"))


def op6_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    found = tokens.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated(_table(spark, folder, "documents"))


def op8_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.fingerprinted(_table(spark, folder, "documents"))


def op9_vectors(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return vectors.nearest_of_every(rows)


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, folder, "documents"))


def op12_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = automata.deduplicated(_table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_trie(spark: SparkSession, folder: str) -> DataFrame:
    return tries.prefix_trie(_table(spark, folder, "conversations"))


REGISTRY = {
    "op1_pii": op1_pii,
    "op2_mixing": op2_mixing,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_tokens": op6_tokens,
    "op7_suffixes": op7_suffixes,
    "op8_chunks": op8_chunks,
    "op9_vectors": op9_vectors,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_substrings": op12_substrings,
    "op13_trie": op13_trie,
}

SQL: dict[str, str] = {}
