"""A corpus pipeline: toxic documents go, near-duplicates go, personal data is masked, sources are mixed, sequences are packed."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import newsloom
from newsloom.functions.once import computed
from newsloom.llm import mixing, packing, pii, simhash, toxicity
from newsloom.llm.shared import saved

# Executors may not have the package installed: send its functions by value.
cloudpickle.register_pickle_by_value(newsloom)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold. The scores are learned from the labels of the documents at hand."""
    model = toxicity.fit_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rated = docs.select(F.struct("*").alias("row"), toxicity.scores("text", model).alias("found"))
    return rated.filter(F.col("found.score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.keep_first(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each personal span is replaced by its kind, and ``n_chars`` follows. A null text stays null."""
    own = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    text, size = F.col(own["text"]), F.col(own["n_chars"])
    rows = pii.with_spans(docs.toDF(*own.values()), pii.fit(docs), text=own["text"])
    rows = computed(rows, masked=pii.redact(text, F.col("spans")))
    changed = {"text": F.col("masked"), "n_chars": F.when(text.isNull(), size).otherwise(F.length("masked").cast("long"))}
    return rows.select(*[changed.get(c, F.col(name)).alias(c) for c, name in own.items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences; copies of a document never share one."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The stages have no SQL form; tests hold them against plain-Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's result is written and read back by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
