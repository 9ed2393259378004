"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once.

    A filter on a plain projected column is pushed below the projection with
    the column's expression copied into it, so a parsed message or document
    would be parsed again for every use. A generator stops that.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
