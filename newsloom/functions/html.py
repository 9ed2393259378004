"""HTML in texts: decoding, removing tags, escaping."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from newsloom.functions.text import collapse_space


@F.pandas_udf(StringType())
def _decode(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape(c: Column) -> Column:
    """Decode all HTML character references. Only texts with an ``&`` go to Python."""
    return F.coalesce(_decode(F.when(F.contains(c, F.lit("&")), c)), c)


def remove_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", " ")


def preview(c: Column) -> Column:
    """Plain one-line text of an HTML fragment."""
    return collapse_space(remove_tags(unescape(F.coalesce(c, F.lit("")))))


# Characters escaped in messages, the ampersand first.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))


def escape(c: Column) -> Column:
    for char, entity in ESCAPES:
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c
