from pyspark.sql import functions as F

from newsloom.functions import times as M

DATES = [
    ("Sat, 23 Mar 2024 10:00:00 GMT", 1711188000),
    ("Sat, 23 Mar 2024 17:00:00 +0700", 1711188000),
    ("23 Mar 2024 17:00:00 +07:00", 1711188000),
    ("Sat, 23 Mar 2024 05:00:00 EST", 1711188000),
    ("Saturday, 23 March 2024 06:00:00 edt", 1711188000),
    ("Sat,23 Mar 24 10:00 UT", 1711188000),
    ("  23 Mar 2024 10:00:00  ", 1711188000),
    ("23 Mar 2024", 1711152000),
    ("2024-03-23T10:00:00Z", 1711188000),
    ("2024-03-23T17:00:00.123+07:00", 1711188000),
    ("2024-03-23 10:00", 1711188000),
    ("2024-03-23", 1711152000),
    ("2024-03", 1709251200),
    ("31 Feb 2024 10:00:00 GMT", None),
    ("23 Foo 2024 10:00:00 GMT", None),
    ("yesterday", None),
    ("a|b|c|d|e|f|g", None),
    ("", None),
    (None, None),
]


def test_feed_dates(rows_of):
    got = rows_of([(d,) for d, _ in DATES], "s string", M.feed_date(F.col("s")))
    assert [r[0] for r in got] == [e for _, e in DATES]


def test_epoch_iso(rows_of):
    cases = [(0.0, "1970-01-01T00:00:00Z"), (1711230000.9, "2024-03-23T21:40:00Z"), (-0.5, "1969-12-31T23:59:59Z"),
             (1711230000.9999999, "2024-03-23T21:40:01Z"), (None, "now"), (float("nan"), "now"), (float("inf"), "now"),
             (253402300800.0, "now"), (253402300799.0, "9999-12-31T23:59:59Z"), (-62135596801.0, "now")]
    got = rows_of([(s,) for s, _ in cases], "s double", M.epoch_iso(F.col("s"), F.lit("now")))
    assert [r[0] for r in got] == [e for _, e in cases]


def test_numbers_in_texts(rows_of):
    texts = ["12", " 1_000.5 ", "1e3", ".5", "5.", "1__0", "0x10", "1d", "", "abc", "-3"]

    def number(t):
        try:
            return float(t)
        except ValueError:
            return None

    got = rows_of([(t,) for t in texts], "s string", M.number_from_text(F.col("s")))
    assert [r[0] for r in got] == [number(t) for t in texts]
