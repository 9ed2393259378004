import random

import pytest
from tests.plain import backfill

from newsloom.operators import limits
from newsloom.plans import jobs

NOW = 1_000_000
SCHEMA = "feed_ord int, entry_pos long, published_ts long"


def case(seed, feeds=6, n=300):
    """Feed 0 holds a third of the rows; times are old, fresh or missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        feed = 0 if i % 3 == 0 else rng.randrange(feeds)
        rows.append((feed, i, rng.choice([None, 100, NOW - 10, NOW - 86400, NOW - 86401])))
    return rows


@pytest.mark.parametrize("bits", [16, 3])
@pytest.mark.parametrize("per_feed,total,days", [
    (None, None, 1), (5, None, None), (None, 17, None), (5, 17, 1), (40, 90, 1), (1000, 100, None), (3, 1000, 1),
    (30, 1, 1), (7, 42, None), (None, 300, None)])
def test_against_plain_model(spark, monkeypatch, bits, per_feed, total, days):
    monkeypatch.setattr(limits, "BLOCK_BITS", bits)
    rows = case(hash((per_feed or 0, total or 0, days or 0)))
    df = spark.createDataFrame(rows, SCHEMA)
    published, counters = backfill(rows, per_feed, total, None if days is None else NOW - days * 86400)
    got = limits.select_backfill(df, NOW, per_feed, total, days)
    assert sorted(r["entry_pos"] for r in got.collect()) == sorted(r[1] for r in published)
    found = {r["feed_ord"]: {k: v for k, v in r.asDict().items() if k != "feed_ord"}
             for r in limits.backfill_counters(df, NOW, per_feed, total, days).collect()}
    assert found == counters


def test_listed_cases(spark):
    def count(rows, **options):
        return limits.select_backfill(spark.createDataFrame(rows, SCHEMA), NOW, **options).count()

    assert count([(f, i, NOW) for f in (0, 1) for i in range(3)], total=4) == 4
    assert count([(f, i, NOW) for f in (0, 1) for i in range(5)], per_feed=2) == 4
    assert count([(0, 0, 999_000), (0, 1, 100)], days=1) == 1
    assert count([(0, 0, None)], days=1) == 1


def test_grand_total(spark):
    counters = limits.backfill_counters(spark.createDataFrame(case(1), SCHEMA), NOW, 5, None, 1)
    rows = limits.with_grand_total(counters).collect()
    total = next(r for r in rows if r["feed_ord"] is None)
    assert total["published"] == sum(r["published"] for r in rows if r["feed_ord"] is not None)


@pytest.mark.parametrize("name", ["per_feed_limit", "total_limit", "days"])
def test_limits_must_be_positive(name):
    with pytest.raises(ValueError):
        jobs._checked(**({"per_feed_limit": None, "total_limit": None, "days": None} | {name: 0}))
