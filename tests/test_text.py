import hashlib
import random

from pyspark.sql import functions as F
from tests.plain import short_summary, strip_chars, summary

from newsloom.functions import text as T


def test_whitespace_is_complete():
    assert set(T.WHITESPACE) == strip_chars()


def test_strip_and_collapse(rows_of):
    texts = [("  a b　",), ("\x1ca\x1d b\n",), ("",), ("\t\n",), ("a\x85\xa0 b",)]
    got = rows_of(texts, "s string", T.strip(F.col("s")), T.collapse_space(F.col("s")))
    assert got == [(s.strip(), " ".join(s.split())) for (s,) in texts]


def test_lower_agrees_on_many_scripts(rows_of):
    texts = [("VN-INDEX Tăng ĐÀ",), ("İSTANBUL",), ("STRAẞE",), ("ΟΔΟΣ",), ("Ǆ ЖУРНАЛ",)]
    assert rows_of(texts, "s string", F.lower("s")) == [(s.lower(),) for (s,) in texts]


def test_ids(rows_of):
    data = [("https://Example.com/A ", " Title"), ("https://example.com/a", "title"), ("https://example.com/a", "other")]
    got = rows_of(data, "u string, t string", T.article_id(F.col("u")), T.raw_hash(F.col("u"), F.col("t")))
    digest = hashlib.sha256(b"https://example.com/a").hexdigest()
    assert [r[0] for r in got] == [digest[:32]] * 3
    assert got[0][1] == got[1][1] == hashlib.sha256(b"https://example.com/a|title").hexdigest()
    assert got[2][1] != got[0][1]


def boundary_texts():
    filler = "x" * 400
    texts = ["", "short", "word " * 200, "y" * 300, "y" * 301]
    for mark in (". ", "。", "! ", "? ", "\n"):
        for at in (99, 100, 101, 149, 150, 151, 198, 199, 298, 299):
            texts.append(filler[:at] + mark + filler)
        texts.append("a! b" + filler[:160] + mark + "c. d" + filler)
    texts.append("Giá vàng hôm nay tăng. " * 30)
    return texts


def test_summary_against_plain_model(rows_of):
    rng = random.Random(7)
    texts = boundary_texts()
    alphabet = ["a", "b ", ". ", "! ", "? ", "。", "\n", "ế", "́", "\x1c", "　"]
    texts += ["".join(rng.choices(alphabet, [30, 20, 1, 1, 1, 1, 1, 10, 3, 1, 1], k=rng.randint(0, 500))) for _ in range(300)]
    data = [("tt ", t.strip()) for t in texts]
    got = rows_of(data, "t string, s string", T.summary(F.col("s")),
                  T.article_summary(F.trim("t"), F.col("s")), T.short_summary(F.col("t"), F.col("s")))
    for (title, s), (plain, article, short) in zip(data, got):
        assert plain == summary(s)
        assert article == (summary(s) if s else "tt")
        assert short == short_summary(title, s)


def test_first_non_empty(rows_of):
    data = [("", "b"), (None, "b"), ("a", "b"), (None, None)]
    assert rows_of(data, "a string, b string", T.first_non_empty(F.col("a"), F.col("b"))) == [("b",), ("b",), ("a",), ("",)]
