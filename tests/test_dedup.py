import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.plain import ttl_kept

from newsloom.operators import dedup


def events(n=4000, keys=40, span=20000, seed=3):
    """A third of all rows has key 0."""
    rng = random.Random(seed)
    return [(0 if i % 3 == 0 else rng.randrange(keys), rng.randrange(span), i) for i in range(n)]


def expected_ttl(rows, ttl):
    kept = set()
    for key in {r[0] for r in rows}:
        own = sorted((s, p) for k, s, p in rows if k == key)
        kept |= {own[i][1] for i in ttl_kept([s for s, _ in own], ttl)}
    return kept


def test_ttl_sequence(spark):
    rows = spark.createDataFrame([("u", s, i) for i, s in enumerate([0, 100, 600, 601, 1201, 1300])],
                                 "key string, seconds long, pos long")
    kept = dedup.ttl_first(rows, "key", "seconds").orderBy("pos").collect()
    assert [r["seconds"] for r in kept] == [0, 601, 1300]


@pytest.mark.parametrize("batch, span", [(10000, dedup.BLOCK_SECONDS), (10000, 301), (7, 500), (1, 4000)])
def test_ttl_against_plain_model(spark, batch, span):
    """Small Arrow batches make the walk cross batch borders inside a block, small spans make it cross blocks."""
    rows = events()
    df = spark.createDataFrame(rows, "key long, seconds long, pos long").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        kept = {r["pos"] for r in dedup.ttl_positions(df, "key", "seconds", ttl=300, span=span).collect()}
        flags = {r["pos"]: r["is_duplicate"] for r in dedup.ttl_flags(df, "key", "seconds", ttl=300).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)
    assert kept == expected_ttl(rows, 300)
    assert flags == {p: p not in kept for _, _, p in rows}


@pytest.mark.parametrize("span", [101, 128, 1000, 10 ** 6])
def test_walk_over_any_batch_cut(span):
    """The three passes of the parallel walk, over keys that are null or negative in time too."""
    rng = random.Random(span)
    rows = sorted({(k if k else None, s - 900): p for k, s, p in reversed(events(400, 5, 3000))}.items(), key=lambda r: (r[0][0] is not None, r[0]) if r[0][0] else (False, (0, r[0][1])))
    frame = pd.DataFrame([(k, s // span, s, p) for (k, s), p in rows], columns=["key", "block", "second", "pos"])
    want = expected_ttl([(k, s, p) for (k, s), p in rows], 100)

    def cut(table):
        at = [0, *sorted(rng.sample(range(len(table)), min(6, len(table)))), len(table)]
        return (table.iloc[a:b].reset_index(drop=True) for a, b in zip(at, at[1:]))

    rows_schema = pa.schema([(c, pa.int64()) for c in frame.columns])
    steps_schema = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("upto", pa.list_(pa.int64())), ("leave", pa.list_(pa.int64()))])
    arrow = lambda batches: pa.Table.from_batches(list(batches)).to_pandas()
    for _ in range(20):
        steps = arrow(dedup._block_steps(100, span, (pa.RecordBatch.from_pandas(f, rows_schema, preserve_index=False) for f in cut(frame))))
        entries = arrow(dedup._entries(100, span, (pa.RecordBatch.from_pandas(f, steps_schema, preserve_index=False) for f in cut(steps))))
        walked = frame.assign(release=frame.merge(entries, on=["key", "block"], how="left")["release"])
        assert set(pd.concat(dedup._accept(100, cut(walked)))["pos"]) == want
        assert steps["upto"].map(len).max() <= 101


def test_a_hot_key_is_walked_by_several_tasks(spark):
    rows = spark.range(20_000).select(F.lit("one").alias("key"), (F.col("id") * 7).alias("seconds"), F.col("id").alias("pos"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task again
    try:
        kept = dedup.ttl_positions(rows, "key", "seconds", ttl=600, span=2_000)
        tasks = kept.select("pos", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.task for r in tasks}) > 1
    assert {r.pos for r in tasks} == set(range(0, 20_000, 86))


def test_first_and_flags(spark):
    rows = [(k, p) for k, _, p in events(900)]
    df = spark.createDataFrame(rows, "key long, pos long").repartition(4)
    firsts = {}
    for k, p in rows:
        firsts.setdefault(k, p)
    assert {r["key"]: r["pos"] for r in dedup.first_of_each(df, "key").collect()} == firsts
    seen = spark.createDataFrame([(0,), (5,)], "key long")
    got = {r["pos"]: r["is_duplicate"] for r in dedup.flag_repeats(df, "key", seen=seen).collect()}
    assert got == {p: firsts[k] != p or k in (0, 5) for k, p in rows}


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("key"), F.col("id").alias("pos"))
    plan = dedup.first_of_each(df, "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_position_sorts_and_names_what_is_missing(rows_of):
    data = [(0, 5), (1, 0), (3, 2**63 - 1), (4, 0), (2**31 - 1, 2**63 - 1)]
    pos = dedup.position(F.col("p"), F.col("o"))
    got = rows_of(data, "p int, o long", pos, *dedup.place_of(pos))
    assert got == sorted(got) and len(set(got)) == 5
    assert [r[1:] for r in got] == data
    with pytest.raises(Exception, match="no partition or no offset"):
        rows_of([(0, None)], "p int, o long", pos)


def test_rows_that_share_a_position_stay_rows(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("a", 0, 1), ("a", 9, 2), ("b", 5, 3)], "key string, seconds long, pos long")
    for flags in (dedup.flag_repeats(rows, "key"), dedup.ttl_flags(rows, "key", "seconds", ttl=100)):
        assert sorted((r["pos"], r["is_duplicate"]) for r in flags.collect()) == [(1, False), (1, True), (2, True), (3, False)]


def test_rows_without_a_time_touch_no_others(spark):
    data = [("a", s, i) for i, s in enumerate([None, 0, 50, None, 101, 150])] + [("b", None, 90), ("b", 7, 91), ("b", 8, 92)]
    rows = spark.createDataFrame(data, "key string, seconds long, pos long")
    assert sorted(r["pos"] for r in dedup.ttl_first(rows, "key", "seconds", ttl=100).collect()) == [0, 1, 3, 4, 90, 91]
