from newsloom.operators import outcomes as O
from newsloom.sources import tables

SCHEMA = "url string, published_ts long, pos long"


def test_two_cycles(spark):
    cycle = spark.createDataFrame([("https://old", 50, 1), ("https://no-ts", None, 2), ("https://new", 150, 3)], SCHEMA)
    first = O.realtime_outcomes(cycle, 100)
    assert tuple(O.realtime_counters(first).first()) == (1, 1, 1, 0)
    seen = O.registered_urls(cycle)
    assert seen.count() == 3
    assert tuple(O.realtime_counters(O.realtime_outcomes(cycle, 100, seen)).first()) == (0, 0, 0, 3)


def test_order_of_checks(spark):
    rows = spark.createDataFrame([("u", None, 1), (" U ", 500, 2), ("at-start", 100, 3), ("before", 99, 4)], SCHEMA)
    got = {r["pos"]: r["outcome"] for r in O.realtime_outcomes(rows, 100).collect()}
    assert got == {1: "skip_no_ts", 2: "skip_dedup", 3: "published", 4: "skip_old"}


def test_latest_urls(spark):
    seen = spark.createDataFrame([(f"h{i}", i) for i in range(20)], "url_hash string, seq long")
    assert {r["url_hash"] for r in O.latest_urls(seen, 3).collect()} == {"h19", "h18", "h17"}


def test_saved_urls(spark, tmp_path):
    path = str(tmp_path / "seen")
    assert tables.load_seen(spark, path, 5).count() == 0
    tables.save_seen(spark.createDataFrame([("a", 1), ("b", 2)], "url_hash string, seq long"), path)
    tables.save_seen(spark.createDataFrame([("a", 9), ("c", 3)], "url_hash string, seq long"), path)
    assert {r["url_hash"] for r in tables.load_seen(spark, path, 2).collect()} == {"b", "c"}
    (tmp_path / "seen" / "part-broken.parquet").write_bytes(b"not parquet")
    assert tables.load_seen(spark, path, 5).count() == 3
