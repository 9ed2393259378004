"""Helpers that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import run_dir

# The bytes that part words, and a word, as regular expressions.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def saved(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` to a new folder below ``spark.checkpoint.dir`` and read them back.

    Cuts the lineage: a lost executor costs only the tasks it was running. What
    is written is narrow unless the caller says otherwise.
    """
    spark = rows.sparkSession
    folder = run_dir(spark, name)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def words(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")
