"""Text expressions: trimming, ids, fingerprints and summaries.

Everything here is a built-in Column expression, so it runs in the JVM and in
batch and streaming plans alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space at the ends of a text,
# the marks a summary may end on (in order of preference) and the length limits.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SUMMARY_MARKS = (". ", "。", "! ", "? ", "\n")
SUMMARY_LENGTH = 300
SHORT_SUMMARY_MARKS = (". ", "。", "! ")
SHORT_SUMMARY_LENGTH = 200
ELLIPSIS = "…"

# The same characters as a regular expression; ranges keep its test short.
WHITESPACE_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


SEPARATOR = "\x1f"


def constant_array(words: Sequence[str]) -> Column:
    """An array of constants, folded by the optimizer. Building it from one literal
    spares a call to the JVM per word."""
    if not words:
        return F.array().cast("array<string>")
    return F.split(F.lit(SEPARATOR.join(words)), SEPARATOR)


def constant_map(pairs: Mapping[str, str]) -> Column:
    return F.map_from_arrays(constant_array(list(pairs)), constant_array(list(pairs.values())))


def strip(c: Column) -> Column:
    """Remove Unicode white space from both ends (``trim`` alone takes only blanks)."""
    return F.trim(c, F.lit(WHITESPACE))


def collapse_space(c: Column) -> Column:
    """One blank for every run of white space, none at the ends."""
    return strip(F.regexp_replace(c, WHITESPACE_CLASS + "+", " "))


def canonical(c: Column) -> Column:
    """The form of a url or title that ids are taken from."""
    return F.lower(strip(c))


def url_fingerprint(url: Column) -> Column:
    return F.sha2(canonical(url), 256)


def article_id(url: Column) -> Column:
    """Stable id of an article: 32 hex digits from its url."""
    return F.substring(url_fingerprint(url), 1, 32)


def raw_hash(url: Column, title: Column) -> Column:
    """Duplicate key of an article: a new title under the same url is a new article."""
    return F.sha2(F.concat(canonical(url), F.lit("|"), canonical(title)), 256)


def first_non_empty(*cols: Column) -> Column:
    """The first argument that is neither null nor empty, else an empty text."""
    return F.coalesce(*[F.when(c != "", c) for c in cols], F.lit(""))


def _end_of_last(mark: str, head: Column, limit: int) -> Column:
    """Length of ``head`` up to its last ``mark``, or null when that is not in the
    second half. ``head`` has exactly ``limit`` characters."""
    from_right = F.instr(F.reverse(head), F.lit(mark[::-1]))
    start = F.lit(limit - len(mark) + 1) - from_right
    return F.when((from_right > 0) & (start > limit // 2), start + len(mark))


def summary(text: Column, limit: int = SUMMARY_LENGTH) -> Column:
    """Shorten to a sentence end, trying the marks in order, and add an ellipsis."""
    head = F.substring(text, 1, limit)
    end = F.coalesce(*[_end_of_last(m, head, limit) for m in SUMMARY_MARKS], F.lit(limit))
    return F.when(F.length(text) <= limit, strip(text)).otherwise(
        F.concat(strip(F.substring(head, F.lit(1), end)), F.lit(ELLIPSIS))
    )


def article_summary(title: Column, body: Column) -> Column:
    """Summary of the trimmed content, or the trimmed title when there is no content.

    Both arguments should be columns, not expressions: they are used many times.
    """
    return F.when(body != "", summary(body)).otherwise(title)


def short_summary(title: Column, body: Column, limit: int = SHORT_SUMMARY_LENGTH) -> Column:
    """The alternative job's summary of trimmed content: the latest sentence end wins, and
    only a cut inside a sentence gets an ellipsis."""
    head = F.substring(body, 1, limit)
    # The punctuation character itself stays, the blank behind it does not.
    ends = [_end_of_last(m, head, limit) - (len(m) - 1) for m in SHORT_SUMMARY_MARKS]
    end = F.greatest(*ends)
    return (
        F.when(body == "", strip(title))
        .when(F.length(body) <= limit, body)
        .when(end.isNotNull(), strip(F.substring(head, F.lit(1), end)))
        .otherwise(F.concat(strip(head), F.lit(ELLIPSIS)))
    )
